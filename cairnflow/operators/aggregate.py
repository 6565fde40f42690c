"""Grouped reports: counts with shares, top lists, conditional rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import grows, keep


def breakdown(df: DataFrame, key: str | Column, weight: str | None = None, limit: int | None = None, digits: int = 4) -> DataFrame:
    """Rows (label, n, pct) by ``key``; ``weight`` holds counts made earlier.

    The share is of all rows, those beyond ``limit`` included: the labels, counted first,
    are divided by their own total.
    """
    label = F.col(key) if isinstance(key, str) else key
    n = F.count("*") if weight is None else F.sum(weight)
    groups = df.groupBy(label.alias("label")).agg(n.cast("long").alias("n"))
    total = groups.agg(F.sum("n"))
    out = groups.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total.scalar(), digits))
    return out if limit is None else out.orderBy(F.desc("n"), F.asc_nulls_last("label")).limit(limit)


def rates(df: DataFrame, by: list[str], flags: dict[str, Column], digits: int = 4) -> DataFrame:
    """Counts n_<flag> and shares <flag>_rate of rows by group, in one pass."""
    counts = [F.count_if(condition).alias(f"n_{name}") for name, condition in flags.items()]
    out = df.groupBy(*by).agg(F.count("*").alias("n"), *counts)
    for name in flags:
        out = out.withColumn(f"{name}_rate", F.round(F.try_divide(F.col(f"n_{name}"), F.col("n")), digits))
    return out


def unpivot_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows (label, n) of how many rows hold each flag, flags that none holds left out."""
    one = df.agg(*[F.count_if(condition).alias(name) for name, condition in flags.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in flags)
    return one.select(F.expr(f"stack({len(flags)}, {pairs}) AS (label, n)")).where("n > 0")


def facets(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (facet, value, n): the counts by each key alone, from one scan."""
    grouped = df.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(F.grouping_id().alias("gid"), F.count("*").alias("n"))
    facet, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for place, key in enumerate(keys):
        own = F.col("gid") == F.lit((1 << len(keys)) - 1 - (1 << (len(keys) - 1 - place)))
        facet, value = F.when(own, key).otherwise(facet), F.when(own, F.col(key).cast("string")).otherwise(value)
    return grouped.select(facet.alias("facet"), value.alias("value"), "n")


def profile(df: DataFrame, key: str, day: str, sets: list[str]) -> DataFrame:
    """Per key: rows, first and last day, and each named column's distinct values, sorted and joined by `|`."""
    joined = [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "|").alias(f"{c}_set") for c in sets]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), *joined)


#: Groups up to which their bounds are broadcast; more are merged by key.
FEW_GROUPS = 100_000


def same_keys(keys: list[str], left: str, right: str) -> Column:
    """Equal keys on both sides, nulls included."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Per group exact interpolated percentiles, a column for each of ``shares``; groups without values are left out.

    A sketch of fixed size bounds each percentile to a narrow window of values. One more pass
    counts what lies below it and each distinct value inside, so no task holds a group.
    """
    own = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    slack = 2.0 / accuracy
    ends = [F.lit(min(1.0, max(0.0, p + d))) for p in shares.values() for d in (-slack, slack)]
    every = F.array(*[F.lit(float(x)) for _ in shares for x in ("-inf", "inf")])  # of groups so small that a window spans no two ranks
    bounds = own.groupBy(*by).agg(F.count("*").alias("__n"), F.percentile_approx("__v", F.array(*ends), F.lit(accuracy)).alias("__w"))
    bounds = keep(bounds.withColumn("__w", F.when(F.col("__n") <= accuracy, every).otherwise(F.col("__w"))), "bounds")
    side = F.broadcast(bounds) if bounds.count() <= FEW_GROUPS else grows(bounds)
    at = own.alias("l").join(side.alias("r"), same_keys(by, "l", "r")).select(*[F.col(f"l.{c}").alias(c) for c in by], "__v", "__n", "__w")
    cells = F.array(*[F.when(F.col("__v") <= F.col("__w")[2 * k + 1], F.struct(F.lit(k).alias("__k"), F.when(F.col("__v") >= F.col("__w")[2 * k], F.col("__v")).alias("__v"))) for k in range(len(shares))])
    counted = at.select(*by, "__n", F.explode(F.array_compact(cells)).alias("__c")).groupBy(*by, "__n", F.col("__c.__k").alias("__k"), F.col("__c.__v").alias("__v")).agg(F.count("*").alias("__rows"))
    end = F.sum("__rows").over(Window.partitionBy(*by, "__k").orderBy(F.asc_nulls_first("__v")).rowsBetween(Window.unboundedPreceding, 0))
    share = F.element_at(F.array(*[F.lit(p) for p in shares.values()]), F.col("__k") + 1)
    placed = counted.withColumn("__end", end).withColumn("__place", share * (F.col("__n") - 1))
    at_rank = lambda rank: F.max(F.when((F.col("__end") - F.col("__rows") <= rank) & (rank < F.col("__end")), F.col("__v")))
    found = placed.groupBy(*by, "__k").agg(at_rank(F.floor("__place")).alias("__low"), at_rank(F.ceil("__place")).alias("__high"), F.max(F.col("__place") - F.floor("__place")).alias("__part"))
    exact = found.withColumn("__value", F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__part"))
    return exact.groupBy(*by).agg(*[F.max(F.when(F.col("__k") == k, F.col("__value"))).alias(name) for k, name in enumerate(shares)])


def summary(df: DataFrame, by: list[str], value: str, digits: int = 6) -> DataFrame:
    """count, mean, p50, p90, p95, p99, min and max of a value, zeros where a group has none."""
    shares = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    both = out.alias("a").join(grows(percentiles(df, by, value, shares)).alias("b"), same_keys(by, "a", "b"), "left").select("a.*", *shares)
    zero = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), digits).alias(c)
    return both.select(*by, "n", zero("mean"), *[zero(c) for c in shares], zero("low"), zero("high"))


def matrix(df: DataFrame, row: str, column: str, rows: int, columns: int) -> DataFrame:
    """Sparse cells (row, column, n) of the top rows and columns by count, ties by name."""
    counted = df.groupBy(F.col(row).alias("row"), F.col(column).alias("column")).agg(F.count("*").alias("n"))
    top = lambda c, n: counted.groupBy(c).agg(F.sum("n").alias("total")).orderBy(F.desc("total"), c).limit(n).select(c)
    return counted.join(top("row", rows), "row", "left_semi").join(top("column", columns), "column", "left_semi").select("row", "column", "n")
