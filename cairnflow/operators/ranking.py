"""Order-based reports: pages, top lists per group, running shares, trends and their changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import keep


def page(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """One page under a total order; Spark keeps offset + limit rows of each task."""
    return df.orderBy(*order).offset(offset).limit(limit)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their place. Spark cuts groups before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)


def latest_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return top_per_group(df, key, order, 1, "__nth").drop("__nth")


def trend(df: DataFrame, day: Column, bucket: str, flags: dict[str, Column]) -> DataFrame:
    """Rows (bucket, n, n_<flag>...) by month, week, quarter or year."""
    return df.where(day.isNotNull()).groupBy(F.to_date(F.date_trunc(bucket, day)).alias("bucket")).agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"n_{k}") for k, c in flags.items()])


def with_change(series: DataFrame, order: str, value: str, digits: int = 4) -> DataFrame:
    """A series (a row per bucket) with the previous value and the change in percent."""
    w = Window.partitionBy().orderBy(order)
    before = F.lag(value).over(w)
    return series.withColumn("previous", before).withColumn("change_pct", F.round(F.try_divide((F.col(value) - F.col("previous")) * 100.0, F.col("previous")), digits))


def half_window_change(series: DataFrame, order: str, value: str, digits: int = 4) -> DataFrame:
    """(earlier, later, change_pct) of a series' halves, its last and maybe partial bucket left out."""
    w = Window.partitionBy().orderBy(order)
    placed = series.withColumn("nth", F.row_number().over(w)).withColumn("all", F.count("*").over(Window.partitionBy()))
    whole = placed.where(F.col("nth") < F.col("all")).withColumn("late", F.col("nth") > F.floor((F.col("all") - 1) / 2))
    sums = whole.agg(F.sum(F.when(~F.col("late"), F.col(value)).otherwise(0)).alias("earlier"), F.sum(F.when(F.col("late"), F.col(value)).otherwise(0)).alias("later"))
    return sums.withColumn("change_pct", F.round(F.try_divide((F.col("later") - F.col("earlier")) * 100.0, F.col("earlier")), digits))


def running_share(groups: DataFrame, by: list[str], order: list[Column], value: str, digits: int = 6) -> DataFrame:
    """Counted groups with their running sum and its share of the whole, within ``by``.

    Without ``by`` the groups are parted by ranges of their order: each part runs its own sum, from
    what the parts before it add up to, so that no task holds all. ``order`` tells all groups apart.
    """
    if by:
        w = Window.partitionBy(*by)
        run = F.sum(value).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        return groups.withColumn("running", run).withColumn("share", F.round(F.col("running") / F.sum(value).over(w), digits))
    placed = keep(groups.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    each = placed.groupBy("__part").agg(F.sum(value).alias("__own"))  # a row for each part
    so_far = Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = each.select("__part", F.coalesce(F.sum("__own").over(so_far), F.lit(0)).alias("__start"), F.sum("__own").over(Window.partitionBy()).alias("__all"))
    run = F.col("__start") + F.sum(value).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.join(starts, "__part").withColumn("running", run).withColumn("share", F.round(F.col("running") / F.col("__all"), digits)).drop("__part", "__start", "__all")


def knee(groups: DataFrame, by: list[str], order: list[Column], value: str, share: float = 0.95) -> DataFrame:
    """The first group of each ``by`` at which the running share reaches ``share``."""
    reached = running_share(groups, by, order, value).where(F.col("share") >= share)
    return top_per_group(reached, by, order, 1, "__nth").drop("__nth")


def round_robin(df: DataFrame, group: str, order: list[Column], size: int) -> DataFrame:
    """A sample that takes each group's first rows, then their second ones, up to ``size``."""
    placed = df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("turn") <= size)
    return placed.orderBy("turn", group).limit(size)


def upper_median(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """The row in the middle of each group by (value, tie), the upper of two; rows without a group or a value take no part.

    A sketch bounds where it must lie (its error is a ten-thousandth of the rows); rows below are counted and
    only those between the bounds, some thousandths, are put in order.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    bounds = rows.groupBy(F.col(group).alias("__g")).agg(F.percentile_approx(value, [0.4995, 0.5005], 10000).alias("b"), F.count("*").alias("__n")).select("__g", F.col("b")[0].alias("__low"), F.col("b")[1].alias("__high"), "__n")
    met = rows.join(bounds, F.col(group) == F.col("__g"))
    below = met.where(F.col(value) < F.col("__low")).groupBy(F.col("__g").alias("__h")).agg(F.count("*").alias("__below"))
    near = met.where(F.col(value).between(F.col("__low"), F.col("__high"))).join(below, F.col("__g") == F.col("__h"), "left")
    nth = F.row_number().over(Window.partitionBy("__g").orderBy(value, tie)) + F.coalesce("__below", F.lit(0))
    return near.withColumn("__nth", nth).where(F.col("__nth") == F.floor(F.col("__n") / 2) + 1).select(*df.columns)
