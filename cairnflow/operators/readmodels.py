"""Read models: technique analytics, four-vertex scores, several trends at once, page yield, stage funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import grows
from .aggregate import percentiles, same_keys
from .ranking import top_per_group


def technique_analytics(rows: DataFrame, incident: str, tactic: str, technique: str, per_tactic: int) -> DataFrame:
    """Per tactic its first techniques: incidents, rows, share of the tactic's rows, rank, and the tactic's incidents.

    Rows are made distinct by incident once; no count distinct is left.
    """
    own = rows.select(F.col(incident).alias("i"), F.col(tactic).alias("tactic"), F.col(technique).alias("technique")).where("tactic IS NOT NULL AND technique IS NOT NULL")
    pairs = own.groupBy("i", "tactic", "technique").agg(F.count("*").alias("c"))
    techniques = pairs.groupBy("tactic", "technique").agg(F.count("*").alias("incidents"), F.sum("c").alias("rows"))
    tactics = pairs.groupBy("tactic", "i").agg(F.sum("c").alias("c")).groupBy("tactic").agg(F.count("*").alias("tactic_incidents"), F.sum("c").alias("tactic_rows"))
    ranked = top_per_group(techniques, ["tactic"], [F.desc("incidents"), F.desc("rows"), F.col("technique")], per_tactic)
    return ranked.join(tactics, "tactic").select("tactic", "technique", "incidents", "rows", F.round(F.col("rows") * 100.0 / F.col("tactic_rows"), 4).alias("pct"), "rank", "tactic_incidents")


def vertices(parts: dict[str, list[Column]]) -> list[Column]:
    """Per vertex its score (how many signs are present) and confidence: none, low, medium, high."""
    out = []
    for name, signs in parts.items():
        score = sum((F.when(F.coalesce(s, F.lit(False)), 1).otherwise(0) for s in signs[1:]), F.when(F.coalesce(signs[0], F.lit(False)), 1).otherwise(0))
        out += [score.cast("long").alias(f"{name}_score"), F.when(score == 0, "none").when(score == 1, "low").when(score == 2, "medium").otherwise("high").alias(f"{name}_confidence")]
    return out


def kpi_trends(df: DataFrame, day: Column, bucket: str, metrics: dict[str, Column]) -> DataFrame:
    """Rows (metric, bucket, n) of several conditions by time, counted in one pass and laid out long."""
    wide = df.where(day.isNotNull()).groupBy(F.to_date(F.date_trunc(bucket, day)).alias("bucket")).agg(*[F.count_if(c).alias(k) for k, c in metrics.items()])
    pairs = ", ".join(f"'{k}', `{k}`" for k in metrics)
    return wide.select("bucket", F.expr(f"stack({len(metrics)}, {pairs}) AS (metric, n)"))


def page_yield(df: DataFrame, source: str, page: Column, useful: Column) -> DataFrame:
    """Per source and page: items, useful ones, their running share, and whether the 95 % knee is reached."""
    pages = df.where(page.isNotNull()).groupBy(source, page.alias("page")).agg(F.count("*").alias("items"), F.count_if(useful).alias("useful"))
    w = Window.partitionBy(source)
    run = F.sum("useful").over(w.orderBy("page").rowsBetween(Window.unboundedPreceding, 0))
    share = F.round(F.coalesce(F.try_divide(run, F.sum("useful").over(w)), F.lit(0.0)), 6)
    return pages.withColumn("share", share).withColumn("past_knee", F.col("share") >= 0.95)


def funnel(df: DataFrame, stages: dict[str, Column], digits: int = 4) -> DataFrame:
    """Rows (stage, n, pct_of_first, pct_of_previous): rows that pass each stage and all before it."""
    passed, columns = F.lit(True), []
    for name, test in stages.items():
        passed = passed & F.coalesce(test, F.lit(False))
        columns.append(F.count_if(passed).alias(name))
    one, names = df.agg(*columns), list(stages)
    rows = [F.struct(F.lit(n).alias("stage"), F.col(n).alias("n"), F.round(F.coalesce(F.try_divide(F.col(n) * 100.0, F.col(names[0])), F.lit(0.0)), digits).alias("pct_of_first"), F.round(F.coalesce(F.try_divide(F.col(n) * 100.0, F.col(names[max(0, k - 1)])), F.lit(0.0)), digits).alias("pct_of_previous")) for k, n in enumerate(names)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def lead_times(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Seconds from start to end by group: count, mean, median, 90th and 95th percentile; open ones left out."""
    seconds = (F.col(end).cast("timestamp").cast("double") - F.col(start).cast("timestamp").cast("double")).alias("s")
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*by, seconds)
    means = rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("s"), 4).alias("mean_s"))
    found = percentiles(rows, by, "s", {"p50_s": 0.5, "p90_s": 0.9, "p95_s": 0.95})
    both = means.alias("a").join(grows(found).alias("b"), same_keys(by, "a", "b"))
    return both.select(*[F.col(f"a.{c}").alias(c) for c in by], "n", "mean_s", *[F.round(c, 4).alias(c) for c in ("p50_s", "p90_s", "p95_s")])


def detail(parent: DataFrame, children: dict[str, tuple[DataFrame, list[str]]], key: str) -> DataFrame:
    """Each parent with its children as ordered arrays, one join a child table; a parent without has empty ones."""
    out = parent
    for name, (rows, order) in children.items():
        fields = [*order, *[c for c in rows.columns if c not in (*order, key)]]
        lists = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        out = out.join(lists, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(lists.schema[name].dataType)))
    return out


def unselected(documents: DataFrame, key: str, order: list[Column], *taken: DataFrame) -> DataFrame:
    """The newest document of each key that none of the given tables has: what was forgotten."""
    rest = documents
    for t in taken:
        rest = rest.join(t.select(key), key, "left_anti")
    return top_per_group(rest, [key], order, 1, "__nth").drop("__nth")
