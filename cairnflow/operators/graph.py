"""Graph reports: components, co-occurrence networks, flow links, matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, grows, keep


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) for the nodes of edges (a, b): label is the smallest node reachable.

    Each round points every node to its smallest neighbour, then keeps only the edges
    between different targets; tables shrink from round to round and are written to the
    shared folder. Nulls and loops are left out; no edges give no rows.
    """
    now = keep(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    labels = None
    while not now.isEmpty():
        both = now.select("a", "b").union(now.select("b", "a"))
        down = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("target")), "contract")
        ends = now.join(grows(down.select(F.col("node").alias("a"), F.col("target").alias("x"))), "a").join(grows(down.select(F.col("node").alias("b"), F.col("target").alias("y"))), "b")
        left = keep(ends.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        if labels is None:
            labels = keep(down.select("node", F.col("target").alias("label")), "labels")
        else:
            moved = down.select(F.col("node").alias("label"), "target")
            renamed = keep(labels.join(grows(moved), "label", "left").select("node", F.coalesce("target", "label").alias("label")), "labels")
            discard(labels)
            labels = renamed
        discard(now, down)
        now = left
    discard(now)
    if labels is None:
        return edges.sparkSession.createDataFrame([], "node long, label long")
    return labels


def chain_edges(df: DataFrame, node: str, key: str) -> DataFrame:
    """Edges (a, b) that tie all nodes of one key together: each to the key's smallest, never all pairs."""
    lowest = df.groupBy(key).agg(F.min(node).alias("b"))
    return df.select(F.col(node).alias("a"), key).join(lowest, key).where("a <> b").select("a", "b")


def co_occurrence(df: DataFrame, node: str, signal: str, least: int = 1) -> DataFrame:
    """Rows (a, b, weight) of nodes a < b by the number of signals they share, at least ``least``.

    Meant for a low-cardinality node (an actor, a nation): (node, signal) is made distinct
    first, so a signal pairs its nodes once however many rows it has.
    """
    own = df.select(F.col(node).alias("node"), F.col(signal).alias("signal")).where("node IS NOT NULL AND signal IS NOT NULL").distinct()
    left, right = own.withColumnRenamed("node", "a"), own.withColumnRenamed("node", "b")
    pairs = left.join(right, "signal").where(F.col("a") < F.col("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("weight")).where(F.col("weight") >= least)


def flow_links(df: DataFrame, stages: list[str], least: int = 2) -> DataFrame:
    """Links (source, target, value) between neighbouring stages; names carry their stage, so no cycle arises."""
    sets = [(a, b) for a, b in zip(stages, stages[1:], strict=False)]
    counted = df.groupBy(*stages).agg(F.count("*").alias("n"))
    links = None
    for k, (a, b) in enumerate(sets):
        own = counted.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.concat(F.lit(f"{k}:"), F.col(a)).alias("source"), F.concat(F.lit(f"{k + 1}:"), F.col(b)).alias("target")).agg(F.sum("n").alias("value")).where(F.col("value") >= least)
        links = own if links is None else links.unionByName(own)
    return links


def symmetric_matrix(df: DataFrame, row: str, column: str, rows: int, columns: int) -> DataFrame:
    """Cells (x, y, n) of the top rows and columns by count, each cell mirrored."""
    counted = df.groupBy(F.col(row).alias("r"), F.col(column).alias("c")).agg(F.count("*").alias("n"))
    top = lambda c, n: counted.groupBy(c).agg(F.sum("n").alias("t")).orderBy(F.desc("t"), c).limit(n).select(c)
    cells = counted.join(top("r", rows), "r", "left_semi").join(top("c", columns), "c", "left_semi")
    return cells.select(F.col("r").alias("x"), F.col("c").alias("y"), "n").unionByName(cells.select(F.col("c").alias("x"), F.col("r").alias("y"), "n"))


def trim_to_median(df: DataFrame, group: str, node: str, day: str, window: int, least: int = 3) -> DataFrame:
    """Members within ``window`` days of their group's upper median day; groups with fewer than ``least`` dated members stay whole."""
    dated = df.where(F.col(day).isNotNull())
    order = Window.partitionBy(group).orderBy(day, node)
    middle = dated.withColumn("nth", F.row_number().over(order)).withColumn("n", F.count("*").over(Window.partitionBy(group))).where(F.col("nth") == F.floor(F.col("n") / 2) + 1).where(F.col("n") >= least).select(F.col(group).alias("__group"), F.col(day).alias("middle"))
    joined = df.join(middle, F.col(group) == F.col("__group"), "left")
    return joined.where(F.col("middle").isNull() | F.col(day).isNull() | (F.abs(F.datediff(day, "middle")) <= window)).select(df.columns)
