"""Column expressions for names, keys, urls, dates, numbers and indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Descriptors that actor and family names end in (fixed values).
SUFFIXES = ("ransomware", "gang", "group", "team", "crew")
#: Query parameters that only track (fixed values).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "ref", "source", "via", "fbclid", "gclid", "mc_cid", "mc_eid", "_ga", "_gl", "ncid", "ocid", "sr_share", "social")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def lookup_key(c: Column) -> Column:
    """Trimmed and lower, `/`, `-` and space as `_`, repeats collapsed, none at the ends; empty is null."""
    parts = F.filter(F.split(F.translate(F.lower(F.trim(c)), "/- ", "___"), "_"), lambda x: x != "")
    return F.nullif(F.array_join(parts, "_"), F.lit(""))


def bare_key(c: Column) -> Column:
    """The lookup key without descriptors at its end."""
    return F.regexp_replace(lookup_key(c), f"(_({'|'.join(SUFFIXES)}))+$", "")


def tight_key(c: Column) -> Column:
    """Letters and digits alone."""
    return F.nullif(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), F.lit(""))


def match_text(c: Column) -> Column:
    """Lower case, one space between runs of letters and digits."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def slug(c: Column, most: int = 48) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(most))


def humanise(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def core_tokens(c: Column, stop: tuple[str, ...] = ()) -> Column:
    """Distinct words of over one letter that are no stop words, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(match_text(c), " "), lambda w: (F.length(w) > 1) & ~w.isin(list(stop)))))


def acronym(c: Column) -> Column:
    """First letters of three content words or more; else null."""
    words = F.filter(F.split(match_text(c), " "), lambda w: (w != "") & ~w.isin("of", "the", "and", "for"))
    return F.when(F.size(words) >= 3, F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ""))


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def normal_url(c: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Scheme and host lower, no `www.`, no fragment, no tracking parameters, no slash at the end; the path keeps its case."""
    plain = F.regexp_replace(F.trim(c), "#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    names = "|".join(tracking)
    asked = F.array_join(F.filter(F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(f"^(?i:{names})(=|$)"))), "&")
    url = F.concat(scheme, F.lit("://"), host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""))
    return F.when(scheme != "", url)


def lenient_date(c: Column) -> Column:
    """A date of the first form that fits: ISO, day/month/year, month name, year and month, year."""
    plain = F.regexp_replace(F.trim(c), r"(\d{1,2})(st|nd|rd|th)\b", "$1")
    forms = ((r"^\d{4}-\d{2}-\d{2}", "yyyy-MM-dd", 10), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy", 10), (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy", 11), (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy", 12), (r"^\d{4}-\d{2}$", "yyyy-MM", 7), (r"^\d{4}$", "yyyy", 4))
    return F.coalesce(*[F.when(F.regexp_like(plain, F.lit(shape)), F.try_to_date(F.left(plain, F.lit(size)), form)) for shape, form, size in forms])


def date_precision(c: Column) -> Column:
    """day, month or year: what the text names; null if it is no date."""
    plain = F.trim(c)
    known = lenient_date(c).isNotNull()
    return F.when(known & F.regexp_like(plain, F.lit(r"^\d{4}$")), "year").when(known & F.regexp_like(plain, F.lit(r"^\d{4}-\d{2}$")), "month").when(known, "day")


def lenient_number(c: Column) -> Column:
    """Digits of a text as a number, at most one point among them; else null."""
    digits = F.regexp_replace(c, "[^0-9.]", "")
    return F.when((F.length(F.regexp_replace(digits, "[^.]", "")) <= 1) & F.regexp_like(digits, F.lit("[0-9]")), digits.try_cast("double"))


def lenient_bool(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "yes", "1", "t", "y"), True).when(low.isin("false", "no", "0", "f", "n"), False)


def indicator_kind(c: Column) -> Column:
    """What an indicator is; the order of the tests matters."""
    shapes = (
        ("ipv4", r"^\d{1,3}(\.\d{1,3}){3}$"),
        ("email", r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),
        ("md5", r"^[0-9a-fA-F]{32}$"),
        ("sha1", r"^[0-9a-fA-F]{40}$"),
        ("sha256", r"^[0-9a-fA-F]{64}$"),
        ("sha512", r"^[0-9a-fA-F]{128}$"),
        ("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://"),
        ("ipv6", r"^[0-9a-fA-F]*:[0-9a-fA-F:]+$"),
        ("domain", r"^([a-zA-Z0-9-]+\.)+[a-zA-Z]{2,}$"),
    )
    return F.coalesce(*[F.when(F.regexp_like(F.trim(c), F.lit(shape)), kind) for kind, shape in shapes])


def indicator_words(c: Column) -> Column:
    """The runs without white space that may hold an indicator, one space between them: a search of these finds what one of the text does.

    Searching all words for the start of every shape costs the square of their lengths.
    """
    may = lambda w: F.contains(w, F.lit("@")) | F.contains(w, F.lit("://")) | (F.contains(w, F.lit(".")) & F.regexp_like(w, F.lit(r"[0-9]\.[0-9]"))) | ((F.length(w) >= 32) & F.regexp_like(w, F.lit("[0-9a-fA-F]{32}")))
    return F.array_join(F.filter(F.split(c, r"\s+"), may), " ")


def cves(c: Column) -> Column:
    """Distinct CVE ids of a text, upper case, of years from 1999 on, sorted."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(?i)\b(CVE-\d{4}-\d{4,7})\b"), F.lit(1)), F.upper)
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: F.substring(x, 5, 4).cast("int") >= 1999)))


def sentences(c: Column) -> Column:
    return F.filter(F.split(c, r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def quotes(c: Column, term: str, most: int = 3, length: int = 360) -> Column:
    """The first sentences that hold a term, cut to a length."""
    return F.transform(F.slice(F.filter(sentences(c), lambda s: F.contains(F.lower(s), F.lit(term))), 1, most), lambda s: F.left(s, F.lit(length)))


def volume_gb(c: Column) -> Column:
    """The first data volume that a text names, in GB: gigabytes before terabytes before 100 megabytes and more."""
    of = lambda unit, word: F.replace(F.regexp_extract(c, rf"(?i)(\d+(?:[.,]\d+)?)\s*(?:{unit}|{word})", 1), F.lit(","), F.lit(".")).try_cast("double")
    small = of("MB", "megabyte")
    return F.coalesce(of("GB", "gigabyte"), of("TB", "terabyte") * 1024, F.when(small >= 100, small / 1024))


def short_hash(prefix: Column, *parts: Column, size: int = 16) -> Column:
    """`prefix_` and the start of the parts' SHA-256."""
    return F.concat_ws("_", prefix, F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(size)))
