"""Vendors as they are written: several in one text, with brackets that name products or companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import match_text


def split_entities(c: Column) -> Column:
    """The parts of a text between commas that stand in no bracket, trimmed, without empty ones; null gives null.

    One fold over its characters with the depth of brackets; a closing one without an opening counts for nothing,
    and one never closed holds the rest.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, ch: Column) -> Column:
        parts = (ch == ",") & (s["depth"] == 0)
        depth = F.when(ch == "(", s["depth"] + 1).when(ch == ")", F.greatest(F.lit(0), s["depth"] - 1)).otherwise(s["depth"])
        return F.struct(depth.alias("depth"), F.when(parts, "").otherwise(F.concat(s["held"], ch)).alias("held"), F.when(parts, F.concat(s["parts"], F.array(s["held"]))).otherwise(s["parts"]).alias("parts"))

    whole = F.aggregate(F.split(c, ""), start, step, lambda s: F.concat(s["parts"], F.array(s["held"])))
    return F.filter(F.transform(whole, lambda x: F.trim(x)), lambda x: x != "")


def last_bracket(c: Column) -> Column:
    """What stands in a bracket at the end of a text, if no bracket is in it; else null."""
    return F.nullif(F.regexp_extract(c, r"\(([^()]*)\)\s*$", 1), F.lit(""))


def before_bracket(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s*\([^()]*\)\s*$", ""))


def canonical_vendors(df: DataFrame, key: str, vendors: str, registry: DataFrame) -> DataFrame:
    """Rows (key, vendors, platforms): the vendors of an array column as the companies and products that ``registry`` knows.

    ``registry``: alias, vendor, platform, rank. Each entry of the array is split into entities; one is known by
    its whole name, its name before a bracket, or what the bracket says, in this order, and of aliases that are the
    same the lowest rank claims it. What is not known keeps its name without a describing bracket.
    The first of equal results stays in place; ``key`` tells rows apart and null arrays give empty ones.
    """
    known = registry.select(match_text(F.col("alias")).alias("__k"), "vendor", "platform", "rank").where("__k <> ''").groupBy("__k").agg(F.min(F.struct("rank", "vendor", "platform")).alias("__r"))
    empty = F.array().cast("array<string>")
    # One row or more a key, so that keys without entities stay; what grows with the rows is merged by key.
    parts = df.select(key, F.posexplode_outer(F.flatten(F.transform(F.col(vendors), lambda v: F.coalesce(split_entities(v), empty)))).alias("__nth", "__entity"))
    tries = parts.select(key, "__nth", "__entity", F.posexplode(F.array(match_text(F.col("__entity")), match_text(before_bracket(F.col("__entity"))), match_text(last_bracket(F.col("__entity"))))).alias("__try", "__k"))
    met = tries.join(known, "__k", "left").groupBy(key, "__nth").agg(F.min_by("__r", F.when(F.col("__r").isNotNull(), F.col("__try"))).alias("__r"), F.first("__entity").alias("__entity"))
    named = met.select(key, "__nth", F.coalesce("__r.vendor", F.nullif(before_bracket(F.col("__entity")), F.lit("")), "__entity").alias("vendor"), F.col("__r.platform").alias("platform"))
    listed = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("__nth", F.col(c).alias("v"))))), lambda x: x["v"]))
    return named.groupBy(key).agg(listed("vendor").alias("vendors"), listed("platform").alias("platforms"))
