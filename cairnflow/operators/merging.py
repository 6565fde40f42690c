"""Record merging: survivors, field-wise choice by preference, provenance, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_fields(df: DataFrame, key: list[str], fields: list[str], preference: list[Column]) -> DataFrame:
    """One row per key: every field from the most preferred row that has it (not null, not blank).

    ``preference`` is a list of columns, larger ones first to count; make them a total order.
    """
    order = F.struct(*[c.alias(f"p{k}") for k, c in enumerate(preference)])
    out = []
    for f in fields:
        has = F.col(f).isNotNull() & (F.trim(F.col(f).cast("string")) != "")
        out.append(F.max_by(F.when(has, F.col(f)), F.when(has, order)).alias(f))
    return df.groupBy(*key).agg(*out, F.count("*").alias("merged_rows"))


def provenance(df: DataFrame, key: list[str], fields: list[str], source: str) -> DataFrame:
    """Rows (key, field, n_sources, sources): who disclosed each field of a record."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    rows = df.select(*key, F.col(source).alias("source"), pairs.alias("x")).where(F.col("x.value").isNotNull() & (F.trim("x.value") != ""))
    return rows.groupBy(*key, F.col("x.field").alias("field")).agg(F.count_distinct("source").alias("n_sources"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))


def completeness(fields: list[str], digits: int = 2) -> Column:
    """Percent of the fields that are present."""
    present = reduce(Column.__add__, [F.when(F.col(f).isNotNull() & (F.trim(F.col(f).cast("string")) != ""), 1).otherwise(0) for f in fields])
    return F.round(present * 100.0 / len(fields), digits)


def upsert(current: DataFrame, new: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """``current`` with the rows of ``new``: unknown keys are added, null fields filled, set ones kept."""
    own = current.select(*key, *[F.col(f).alias(f"old_{f}") for f in fields], F.lit(True).alias("known"))
    more = new.groupBy(*key).agg(*[F.min(f).alias(f"new_{f}") for f in fields])
    both = own.join(more, key, "full")
    return both.select(*key, *[F.coalesce(f"old_{f}", f"new_{f}").alias(f) for f in fields], F.when(F.col("known"), "kept").otherwise("added").alias("change"))


def differences(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """Names of the fields in which two records differ, case and spaces aside, joined by `|`."""
    fold = lambda c: F.trim(F.regexp_replace(F.lower(c.cast("string")), r"\s+", " "))
    found = [F.when(~fold(left[f]).eqNullSafe(fold(right[f])), F.lit(f)) for f in left]
    return F.array_join(F.array_compact(F.array(*found)), "|")
