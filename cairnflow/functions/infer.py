"""Labels inferred from what a text or a name says. What is looked for are the caller's tables of phrases."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.phrases import every_label, first_label, has_label, with_phrases

#: Letters of a name from which on it is a sentence.
LONG_NAME = 70


def said(*parts: Column) -> Column:
    """The parts that are there, lower-cased, one space between."""
    return F.lower(F.concat_ws(" ", *parts))


def inferred(df: DataFrame, text: str, table: DataFrame, first: tuple[str, ...] = (), every: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a column for each kind of ``table`` named: its first label, its labels joined by `|`, or whether it is said.

    One reading of the text serves all kinds.
    """
    found = with_phrases(df.drop(*first, *every, *flags), text, table, out="__hits")
    hits = F.col("__hits")
    columns = {k: first_label(hits, k) for k in first} | {k: F.array_join(every_label(hits, k), "|") for k in every} | {k: has_label(hits, k) for k in flags}
    return found.withColumns(columns).drop("__hits")


def institution_kind(known: Column, hits: Column, kind: str = "institution") -> Column:
    """``known`` where it says something, else the label of the first phrase of ``kind`` in the name."""
    found = first_label(hits, kind)
    return F.when(known.isNotNull() & (known != "unknown"), known).otherwise(F.coalesce(found, known))


def is_headline(name: Column, title: Column) -> Column:
    """A sentence and no name: long, the title itself, or a few words after a last dash between spaces."""
    dashed = F.split(F.translate(name, "–—", "--"), " - ")
    source = F.when(F.size(dashed) > 1, F.size(F.split(F.trim(F.element_at(dashed, -1)), " +"))).otherwise(0)
    same = F.coalesce(F.lower(F.trim(name)) == F.lower(F.trim(title)), F.lit(False))
    return F.coalesce((F.length(name) > LONG_NAME) | source.between(1, 4) | same, F.lit(False))


def living_families(df: DataFrame, family: str, day: str, ends: DataFrame) -> DataFrame:
    """``df`` whose ``family`` is null where, by ``ends`` (family, last_day), it no longer acted on that day."""
    over = ends.groupBy(F.col("family").alias("__family")).agg(F.max("last_day").alias("__over"))
    met = df.join(over, F.col(family) == F.col("__family"), "left")
    return met.withColumn(family, F.when(F.coalesce(F.col(day) <= F.col("__over"), F.lit(True)), F.col(family))).drop("__family", "__over")


def technique_base(technique: Column) -> Column:
    """`T1566.001` as `T1566`."""
    return F.nullif(F.upper(F.trim(F.split(technique, r"\.")[0])), F.lit(""))


def place_keys(name: Column) -> Column:
    """The places that a name may hold, lower-cased: neighbouring pairs of its capitalised words from the end, then single ones."""
    words = F.filter(F.split(F.regexp_replace(name, r"[^\p{L}\p{M}\-]+", " "), " "), lambda w: w != "")
    capital = F.filter(F.transform(words, lambda w, k: F.struct(k.alias("k"), w.alias("w"))), lambda x: F.substring(x["w"], 1, 1) != F.lower(F.substring(x["w"], 1, 1)))
    single = F.transform(capital, lambda x: F.lower(x["w"]))
    pairs = F.filter(F.transform(capital, lambda x, n: F.when(F.get(capital, n + 1)["k"] == x["k"] + 1, F.concat_ws(" ", F.lower(x["w"]), F.lower(F.get(capital, n + 1)["w"])))), lambda p: p.isNotNull())
    return F.concat(F.reverse(pairs), F.reverse(single))


def ascii_fold(text: Column) -> Column:
    """Latin letters without their marks; others stay."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b != a and b.isascii()]
    return F.translate(text, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
