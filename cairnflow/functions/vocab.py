"""Controlled vocabularies as small tables: aliases, enums, countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .infer import place_keys, technique_base
from .text import bare_key, humanise, lookup_key, tight_key

UNKNOWN = ("unknown", "n_a", "na", "none", "null", "unspecified", "not_specified", "undisclosed")


def canonical(df: DataFrame, column: str, aliases: DataFrame, out: str, keep_unknown: bool = True) -> DataFrame:
    """``df`` with ``out``: the canonical name of ``column`` by the first key that ``aliases`` (alias, name) knows.

    Keys are tried whole, without descriptors at the end, and with letters and digits alone.
    Names that mean `unknown` are null; others that no alias knows stay as they are, trimmed.
    """
    dim = aliases.select(lookup_key(F.col("alias")).alias("alias_key"), F.col("name").alias("canon")).dropDuplicates(["alias_key"])
    tight = aliases.select(tight_key(F.col("alias")).alias("alias_key"), F.col("name").alias("canon")).dropDuplicates(["alias_key"])
    distinct = df.select(F.col(column).alias("raw")).where("raw IS NOT NULL").distinct()
    hits = [distinct.select("raw", key(F.col("raw")).alias("alias_key")).join(table, "alias_key").select("raw", F.col("canon").alias(f"c{k}")) for k, (key, table) in enumerate(((lookup_key, dim), (bare_key, dim), (tight_key, tight)))]
    found = distinct
    for h in hits:
        found = found.join(h, "raw", "left")
    raw = F.trim("raw") if keep_unknown else F.lit(None)
    name = F.when(lookup_key(F.col("raw")).isin(*UNKNOWN) | lookup_key(F.col("raw")).isNull(), None).otherwise(F.coalesce("c0", "c1", "c2", raw))
    named = found.select(F.col("raw").alias("__raw"), name.alias(out))
    return df.drop(out).join(named, F.col(column) == F.col("__raw"), "left").drop("__raw")


def enum_value(c: Column, values: list[str], mapping: dict[str, str] | None = None, fallback: str | None = None) -> Column:
    """The vocabulary's value: the slug itself, what it maps to, the first value it contains, or the fallback."""
    key = lookup_key(c)
    out = F.when(key.isin(values), key)
    if mapping:
        table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        out = F.coalesce(out, F.try_element_at(table, key))
    for v in values:
        out = F.coalesce(out, F.when(F.contains(key, F.lit(v)), v))
    return F.coalesce(out, F.when(key.isNotNull(), F.lit(fallback)))


def enum_list(c: Column, values: list[str], mapping: dict[str, str] | None = None) -> Column:
    """An array of vocabulary values, unknown ones left out, the first of equals kept."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: enum_value(x, values, mapping)), lambda x: x.isNotNull()))


def category_label(c: Column, labels: dict[str, str]) -> Column:
    """The label of a slug; unknown is null, others are written as words."""
    key = lookup_key(c)
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.when(key.isNull() | key.isin(*UNKNOWN), None).otherwise(F.coalesce(F.try_element_at(table, key), humanise(key)))


def prefix_family(c: Column, families: dict[str, str], other: str = "other") -> Column:
    """The family of the first prefix that a slug starts with."""
    key, out = lookup_key(c), F.lit(other)
    for prefix, family in reversed(families.items()):
        out = F.when(key.startswith(prefix), family).otherwise(out)
    return F.when(key.isNotNull(), out)


def flag(code: Column) -> Column:
    """The flag of a two-letter code: its letters as regional indicators."""
    letter = lambda k: F.decode(F.unhex(F.concat(F.lit("F09F87"), F.hex(F.ascii(F.substring(F.upper(code), k, 1)) - 65 + 0xA6))), "UTF-8")
    return F.when(F.regexp_like(code, F.lit("^[A-Za-z]{2}$")), F.concat(letter(1), letter(2)))


def with_country(df: DataFrame, column: str, countries: DataFrame) -> DataFrame:
    """``df`` with country, country_code and region, from ``countries`` (code, name, region, aliases array).

    A name, an alias or a code is known in any case; what is not known passes through, without a code.
    """
    keys = countries.select("code", "name", "region", F.explode(F.array_distinct(F.concat(F.array("code", "name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("k"))
    dim = keys.select(F.lower(F.trim("k")).alias("__k"), F.col("code").alias("country_code"), F.col("name").alias("__name"), F.col("region")).dropDuplicates(["__k"])
    out = df.drop("country_code", "region").withColumn("__in", F.lower(F.trim(F.col(column)))).join(dim, F.col("__in") == F.col("__k"), "left")
    return out.withColumn("country", F.coalesce("__name", F.trim(F.col(column)))).drop("__in", "__k", "__name")


def mentioned_country(text: Column, names: list[str]) -> Column:
    """The one country that a text names; null where it names none or several."""
    hits = F.array_compact(F.array(*[F.when(F.regexp_like(text, F.lit(rf"(?i)\b{n}\b")), F.lit(n)) for n in names]))
    return F.when(F.size(hits) == 1, hits[0])


def with_tactics(df: DataFrame, technique: str, tactics: DataFrame) -> DataFrame:
    """A row for each tactic of each row's technique by ``tactics`` (technique, tactic); sub-techniques take their technique's."""
    known = tactics.select(technique_base(F.col("technique")).alias("__base"), "tactic").distinct()
    return df.drop("tactic").withColumn("__base", technique_base(F.col(technique))).join(known, "__base").drop("__base")


def with_region(df: DataFrame, name: str, cities: DataFrame, country: str | None = None) -> DataFrame:
    """``df`` with ``region``: that of the first place in a name that ``cities`` (city, country_code, region) knows.

    With ``country``, a column of codes, only its own cities count.
    """
    named = df.select(F.col(name).alias("__name"), (F.col(country) if country else F.lit(None).cast("string")).alias("__code")).distinct()
    tries = named.select("__name", "__code", F.posexplode(place_keys(F.col("__name"))).alias("nth", "city"))
    met = tries.join(cities.select(F.lower(F.trim("city")).alias("city"), "country_code", F.col("region").alias("__region")), "city")
    if country:
        met = met.where(F.col("__code") == F.col("country_code"))
    found = met.groupBy("__name", "__code").agg(F.min_by("__region", F.struct("nth", "country_code")).alias("region"))
    keyed = df.drop("region").withColumn("__name", F.col(name)).withColumn("__code", F.col(country) if country else F.lit(None).cast("string"))
    return keyed.alias("l").join(found.alias("r"), F.col("l.__name").eqNullSafe(F.col("r.__name")) & F.col("l.__code").eqNullSafe(F.col("r.__code")), "left").select("l.*", "r.region").drop("__name", "__code")
