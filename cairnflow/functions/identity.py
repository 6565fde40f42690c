"""Rules on labels of institutions, actors and families: what is generic, what is the same, what is shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lookup_key

#: How labels start that stand for unnamed or several institutions (fixed values).
UNNAMED = ("unnamed", "unknown", "undisclosed", "anonymous", "unidentified", "unspecified", "a", "an", "several", "multiple", "various", "few", "many", "some")
#: Quantities, and the institutions that labels count with them.
QUANTITIES = ("few", "several", "multiple", "various", "many", "some")
INSTITUTIONS = tuple(w for one, more in (("school", "schools"), ("college", "colleges"), ("university", "universities"), ("district", "districts")) for w in (one, more))
#: Versions of one family by what its key holds (fixed values).
LOCKBIT = (("LockBit 3.0", ("3_0", "lockbit3", "lockbit_3", "black")), ("LockBit 2.0", ("2_0", "lockbit2", "lockbit_2", "green")), ("LockBit 1.0", ("1_0", "lockbit1", "lockbit_1", "red")))
#: Words of categories that concern education (fixed values).
EDUCATION = ("education", "university", "school", "college", "academic")


def lockbit_family(c: Column) -> Column:
    """The version that a key starting with `lockbit` names; null for other families."""
    key = lookup_key(c)
    out = F.lit("LockBit")
    for name, signs in reversed(LOCKBIT):
        held = F.lit(False)
        for sign in signs:
            held = held | F.contains(key, F.lit(sign))
        out = F.when(held, name).otherwise(out)
    return F.when(key.startswith("lockbit"), out)


def is_wrapper_url(c: Column) -> Column:
    """Urls of a news aggregator's own pages, which are no articles."""
    host = F.regexp_replace(F.lower(F.regexp_extract(F.trim(c), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(F.trim(c), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce((host == "news.google.com") & F.regexp_like(path, F.lit("^/(rss/articles|articles|read)/")), F.lit(False))


def is_generic_label(c: Column, places: tuple[str, ...] = ()) -> Column:
    """Labels that name no one institution: unnamed or several ones, web sites of something, or one of ``places`` alone."""
    low = F.lower(F.trim(c))
    words = F.filter(F.split(F.regexp_replace(low, "[^a-z]+", " "), " "), lambda w: w != "")
    # Two words in a row: a quantity and institutions, or web sites and `of`.
    several = F.exists(F.sequence(F.lit(0), F.greatest(F.size(words), F.lit(0))), lambda k: (F.get(words, k).isin(*QUANTITIES) & F.get(words, k + 1).isin(*INSTITUTIONS)) | (F.get(words, k).isin("website", "websites") & (F.get(words, k + 1) == "of")))
    return F.coalesce((F.get(words, F.lit(0)).isin(*UNNAMED) & (F.size(words) > 1)) | several | low.isin([p.lower() for p in places]), F.lit(False))


def better_name(a: Column, b: Column, places: tuple[str, ...] = ()) -> Column:
    """The name that is not generic where one is, else the longer, the first on a tie."""
    x, y = F.nullif(F.trim(a), F.lit("")), F.nullif(F.trim(b), F.lit(""))
    gx, gy = is_generic_label(x, places), is_generic_label(y, places)
    return F.when(x.isNull(), y).when(y.isNull(), x).when(gx & ~gy, y).when(gy & ~gx, x).when(F.length(y) > F.length(x), y).otherwise(x)


def person_name(c: Column) -> Column:
    """A name of three words or more without single letters inside."""
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    inner = F.filter(F.slice(words, F.lit(2), F.greatest(F.lit(0), F.size(words) - 2)), lambda w: ~F.regexp_like(w, F.lit(r"^[A-Za-z]\.?$")))
    return F.when(F.size(words) < 3, c).otherwise(F.array_join(F.concat(F.slice(words, 1, 1), inner, F.slice(words, -1, 1)), " "))


def is_generic_actor(c: Column, known: tuple[str, ...], generic: tuple[str, ...], unknown: tuple[str, ...] = ("unknown",)) -> Column:
    """Labels that attribute nothing: empty, ``unknown``, or made of ``generic`` words alone; ``known`` keys never are."""
    key = lookup_key(c)
    core = F.filter(F.split(key, "_"), lambda w: (w != "") & ~w.isin(list(generic)))
    return F.when(key.isNull(), True).when(key.isin(list(known)) | key.startswith("lockbit"), False).otherwise(key.isin(list(unknown)) | (F.size(core) == 0) | F.array_join(core, "_").isin(list(unknown)))


def has_education_category(categories: Column) -> Column:
    return F.coalesce(F.exists(categories, lambda x: F.regexp_like(F.lower(x), F.lit("|".join(EDUCATION)))), F.lit(False))


def source_prefix(c: Column) -> Column:
    return F.split(c, "_")[0]


def merged_notes(*notes: Column) -> Column:
    """Distinct notes in their order, ` | ` between; null without any."""
    kept = F.array_distinct(F.filter(F.array(*[F.trim(n) for n in notes]), lambda x: x.isNotNull() & (x != "")))
    return F.nullif(F.array_join(kept, " | "), F.lit(""))
