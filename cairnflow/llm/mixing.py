"""Mixing sources to target word counts by subset-sum budget fitting.

Documents are counted by source and exact length. Whole rounds of a source come first
(each document once, at most three times); what is left of the target is fitted over the
length counts: an equal part of every length, then the longest that still fit, then a
bounded-knapsack table over what remains, at most DP_WORDS. The documents that a length
count stands for are chosen in the order of a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import grows, keep, session_of, table
from .registry import query

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Words that the knapsack table spans, and hash buckets a (source, length) is parted into.
DP_WORDS = 20_000
BUCKETS = 1024


def words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Each source's target: its weight's share of all sizes, none above ``most`` times its own.

    Sources take the weights in the order of their names' code points, null last. What a
    capped source can't take is shared among the others by weight until none is above.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(ordered)}
    size = dict(ordered)
    found: dict[str | None, float] = {}
    free, budget = set(size), float(sum(size.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if budget * weight[s] / total > most * size[s]}
        if not over:
            return found | {s: budget * weight[s] / total for s in free}
        found |= {s: float(most * size[s]) for s in over}
        budget -= sum(most * size[s] for s in over)
        free -= over
    return found


def fit(lengths: np.ndarray, counts: np.ndarray, budget: float, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many of each length to take so that their sum comes near ``budget``, never above by choice.

    ``lengths`` are distinct and positive. The result takes no more of a length than ``counts``.
    The sum falls short by less than the shortest document that is left: beyond ``dp_words``
    the longest documents that fit are taken first; within them the table is exact, and where
    more than ``dp_words`` are left over, every document that is not taken is longer than that.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    goal = int(min(round(budget), total))
    if goal <= 0 or not len(lengths):
        return take
    if goal == total:
        return counts.astype(np.int64)
    share = goal - min(goal // 4, dp_words)  # the rest is the table's to fit
    take = np.array([int(c) * share // total for c in counts], dtype=np.int64)
    left = goal - int((take * lengths).sum())
    for k in np.argsort(-lengths, kind="stable"):
        if left <= dp_words:
            break
        more = min(int(counts[k] - take[k]), (left - dp_words) // int(lengths[k]) + 1, left // int(lengths[k]))
        take[k] += more
        left -= more * int(lengths[k])
    left = min(left, dp_words)  # more is left only where no document fits
    # The table: reach[w] names the last length on a way to w words; used[w] counts it there.
    reach = np.full(left + 1, -1, dtype=np.int64)
    reach[0] = len(lengths)
    used = np.zeros(left + 1, dtype=np.int64)
    for k in np.argsort(lengths, kind="stable"):
        size, spare = int(lengths[k]), int(counts[k] - take[k])
        if size > left or reach[left] >= 0:
            break
        if spare <= 0:
            continue
        own = np.where(reach >= 0, 0, -1)  # how many of this length reach w, -1: no way yet
        for step in range(1, min(spare, left // size) + 1):
            new = np.flatnonzero((own[:-size] == step - 1) & (own[size:] < 0)) + size
            if not len(new):
                break
            own[new] = step
        first = own > 0
        reach[first], used[first] = k, own[first]
    at = int(np.flatnonzero(reach >= 0)[-1])
    while at:
        k = int(reach[at])
        take[k] += used[at]
        at -= int(used[at]) * int(lengths[k])
    return take


def _plan(by_length: pd.DataFrame) -> pd.DataFrame:
    """The whole rounds and the part of one source's length counts."""
    target, size = by_length["target"].iloc[0], by_length["source_size"].iloc[0]
    rounds = min(int(target // size), MOST_REPEATS) if size else 0
    lengths, counts = by_length["size"].to_numpy(), by_length["n"].to_numpy()
    extra = fit(lengths, counts, target - rounds * size) if rounds < MOST_REPEATS else np.zeros(len(lengths), dtype=np.int64)
    return by_length.assign(rounds=rounds, extra=extra)


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", row_id: str | None = None, seed: int = 17) -> DataFrame:
    """One row per row of ``df``: row_id, doc_id, size, source_size, target, taken.

    ``taken`` is a whole multiple (0 to 3) of the document's size. Documents without words
    take nothing; a source without words has target 0. Repeated rows are chosen each by
    itself, ties by row_id: a unique long column of ``df``, made here when none is named.
    Null sources form one source, null ids are kept; an empty table gives an empty result.
    """
    spark = session_of(df)
    key = F.col(row_id) if row_id else F.monotonically_increasing_id()
    docs = keep(
        df.select(key.alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size"), F.xxhash64(F.lit(seed), F.col(doc_id).cast("long"), F.col(text)).alias("draw")).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)).cast("int")),
        "mix-sizes",
    )
    lengths = keep(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-lengths")
    sizes = [(r.source, int(r.words)) for r in lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()]
    goal = targets(sizes)
    by_source = spark.createDataFrame([(s, n, goal[s]) for s, n in sizes], "source string, source_size long, target double")
    plan = keep(
        lengths.where("size > 0").alias("l").join(by_source.alias("s"), F.col("l.source").eqNullSafe(F.col("s.source"))).select("l.source", "size", "n", "source_size", "target")
        .groupBy("source").applyInPandas(_plan, "source string, size long, n long, source_size long, target double, rounds int, extra long"),
        "mix-plan",
    )
    # Of each (source, length), the first `extra` documents by (bucket, draw): whole buckets by their
    # counts, and row numbers only inside the one bucket where the count runs out.
    same = lambda a, b, *cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    part = plan.where("extra > 0").select("source", "size", "extra")
    in_bucket = docs.groupBy("source", "size", "bucket").agg(F.count("*").alias("here")).alias("b").join(grows(part.alias("p")), same("b", "p", "source", "size")).select("b.source", "b.size", "bucket", "here", "extra")
    order = Window.partitionBy("source", "size").orderBy("bucket")
    cut = in_bucket.withColumn("before", F.sum("here").over(order) - F.col("here")).withColumn("quota", F.least("here", F.greatest(F.lit(0), F.col("extra") - F.col("before"))))
    quota = keep(cut.where("quota > 0").select("source", "size", "bucket", "here", "quota"), "mix-quota")
    full = quota.where("quota = here").select("source", "size", "bucket").withColumn("full", F.lit(1))
    edge = quota.where("quota < here").select("source", "size", "bucket", "quota")
    drawn = docs.alias("d").join(grows(edge.alias("e")), same("d", "e", "source", "size", "bucket")).select("d.row_id", "d.source", "d.size", "d.bucket", "draw", "doc_id", "quota")
    first = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw", "doc_id", "row_id"))).where("nth <= quota").select("row_id").withColumn("drawn", F.lit(1))
    by_source = spark.createDataFrame([(s, n, goal[s], min(int(goal[s] // n), MOST_REPEATS) if n else 0) for s, n in sizes], "source string, source_size long, target double, rounds int")
    out = (
        docs.alias("d").join(by_source.alias("r"), same("d", "r", "source"), "left").select("d.*", "rounds", "source_size", "target").alias("d")
        .join(grows(full.alias("f")), same("d", "f", "source", "size", "bucket"), "left").select("d.*", "full")
        .join(grows(first), "row_id", "left")
    )
    times = F.col("rounds") + F.coalesce("full", "drawn", F.lit(0))
    return out.select("row_id", "doc_id", "size", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"), (F.col("size") * times).cast("long").alias("taken"))


@query("op9_mix")
def op9_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("row_id")
