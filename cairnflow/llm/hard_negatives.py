"""Hard negatives by a search of norm buckets.

Rows of one label are sorted by norm, longest first, and cut into buckets; anchors likewise
into blocks. By Cauchy-Schwarz no row of a bucket scores more than its longest norm times the
anchor's. So a block meets a bucket only where that bound reaches what one of its anchors
still asks for: the lowest score of its windows, or the running k-th best score inside them.
Buckets are taken in waves of falling norm, and every wave renews the k-th scores. First come
the positives, in buckets of the anchor's label; their scores make the windows; then the
negatives, in the buckets of other labels. A block and a bucket meet in one task of bounded
size, as two matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, grows, keep, session_of, table
from .registry import query

POSITIVES, NEGATIVES = 5, 10
#: A window in percent of the positive's score.
LOW, HIGH = 30, 90
SCALE = 256
#: Rows of a bucket and of a block.
BUCKET, BLOCK = 8192, 2048
#: The waves: buckets down to the norms that these shares of all rows exceed, then the rest.
WAVES = (0.02, 0.2)
#: Scores are kept within a long.
_LONG = (1 << 63) - 1
#: Room for rounding in a bound that is a product of two norms.
_SLACK = 1 + 1e-9
_HIT = "anchor long, wish int, found long, found_id long, score long"


def _whole(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows of whole numbers, floor(SCALE * x)."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return np.floor(SCALE * flat.to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, size)


def _scores(anchors: np.ndarray, rows: np.ndarray, norm: float) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles while all sums stay below 2^53, else as Python numbers kept within a long."""
    if norm < 1 << 52:
        return (anchors @ rows.T).astype(np.int64)
    left, right = ([[int(x) for x in v] for v in m.tolist()] for m in (anchors, rows))
    return np.array([[max(-_LONG, min(_LONG, sum(a * b for a, b in zip(x, y, strict=True)))) for y in right] for x in left], np.int64).reshape(len(left), len(right))


def _search(rows: pa.Table, anchors: pa.Table, count: int) -> pa.Table:
    """The ``count`` best rows of a bucket for each wish (anchor, lowest, highest score), ties to the lower id."""
    out: list[list] = [[], [], [], [], []]
    if rows.num_rows and anchors.num_rows:
        size = len(rows.column("vector")[0])
        v, a = _whole(rows.column("vector"), size), _whole(anchors.column("vector"), size)
        ids, row = np.array(rows.column("vec_id")), np.array(rows.column("row"))
        first = np.lexsort((row, ids))  # ties to the lower id
        v, ids, row = v[first], ids[first], row[first]
        longest = np.sqrt((v**2).sum(axis=1).max())
        wishes = anchors.column("wishes").to_pylist()
        norms = np.array(anchors.column("norm"))
        asked = [k for k in range(len(a)) if wishes[k] and min(w["low"] for w in wishes[k]) <= norms[k] * longest * _SLACK]
        keys, own = np.array(anchors.column("anchor")), np.array(anchors.column("vec_id"))
        for at in range(0, len(asked), 512):
            some = asked[at : at + 512]
            for k, score in zip(some, _scores(a[some], v, float(norms[some].max() * longest)), strict=True):
                low, high = min(w["low"] for w in wishes[k]), max(w["high"] for w in wishes[k])
                near = np.flatnonzero((score >= low) & (score <= high) & (ids != own[k]))
                near = near[np.argsort(-score[near], kind="stable")]
                falling = -score[near]
                for w in wishes[k]:
                    start, end = np.searchsorted(falling, -w["high"], "left"), np.searchsorted(falling, -w["low"], "right")
                    hits = near[start : min(end, start + count)]
                    for column, values in zip(out, ([int(keys[k])] * len(hits), [w["wish"]] * len(hits), row[hits].tolist(), ids[hits].tolist(), score[hits].tolist()), strict=True):
                        column += values
    return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["anchor", "wish", "found", "found_id", "score"])


def _cut(rows: DataFrame, most: int, name: str) -> DataFrame:
    """``rows`` with the name of a bucket: one label and size, neighbours in norm, ``most`` rows or, at the end, fewer.

    Sorted by ranges, so that no task holds a label; equal norms are told apart by hash.
    """
    parts = max(1, -(-rows.count() // (16 * most)))
    order = ["label", "size", F.desc("norm"), "mix"]
    spread = rows.withColumn("mix", F.xxhash64("row")).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("mix").withColumn("part", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = 0, None
        for batch in batches:
            places = []
            for kind in zip(batch.column("label").to_pylist(), batch.column("size").to_pylist(), strict=True):
                held, last = held + 1 if kind == last else 0, kind
                places.append(held)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "place"])

    placed = keep(spread.mapInArrow(number, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema), "place long"])), "placed")
    before = Window.partitionBy("label", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part", "label", "size").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    nth = F.floor((F.col("start") + F.col("place")) / most)
    done = keep(placed.join(grows(starts.drop("n")), ["part", "label", "size"]).withColumn(name, F.concat_ws("|", "label", "size", nth)).select(*rows.columns, name), name)
    discard(placed)
    return done


def _best(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` hits of each wish."""
    order = Window.partitionBy("anchor", "wish").orderBy(F.desc("score"), "found_id", "found")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= count)


def _waves(rows: DataFrame, anchors: DataFrame, wishes: DataFrame, same_label: bool, count: int) -> DataFrame:
    """Hits (anchor, wish, found, found_id, score, nth): each wish's ``count`` best, by waves of buckets of falling norm.

    ``wishes``: (anchor, wish, low, high), the scores that a hit may have.
    """
    meta = keep(rows.groupBy("bucket").agg(F.first("label").alias("label"), F.first("size").alias("size"), F.max("norm").alias("longest")), "buckets")
    cuts = meta.agg(*(F.percentile_approx("longest", 1 - share).alias(f"c{k}") for k, share in enumerate(WAVES))).first()
    bounds = [float("inf"), *(c for c in cuts if c is not None), -1.0]
    kind = dict(rows.dtypes)["vector"]
    # The blocks' own keys are dealt over so many numbers that a join on them spreads out.
    spread = max(1, anchors.select("block").distinct().count() // 8)
    best = None
    for above, down in zip(bounds, bounds[1:], strict=False):
        wave = meta.where((F.col("longest") <= above) & (F.col("longest") > down)) if above < float("inf") else meta.where(F.col("longest") > down)
        if above <= down:
            continue
        asked = wishes
        if best is not None:  # a wish that has all its hits asks for their last score at least
            full = best.where(F.col("nth") == count).select("anchor", "wish", F.col("score").alias("kth"))
            asked = wishes.join(grows(full), ["anchor", "wish"], "left").withColumn("low", F.greatest("low", "kth"))
        lists = asked.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("wish", "low", "high"))).alias("wishes"))
        ready = keep(anchors.join(grows(lists), "anchor"), "wishes")
        least = F.array_min(F.transform("wishes", lambda w: w["low"]))
        blocks = ready.groupBy("block").agg(F.first("label").alias("own"), F.first("size").alias("size"), F.min(F.when((least > 0) & (F.col("norm") > 0), least / F.col("norm")).when(least > 0, F.lit(float("inf"))).otherwise(F.lit(-1.0))).alias("asks"))
        dealt = blocks.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(spread)))
        offered = wave.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
        kinds = F.col("own") == F.col("label") if same_label else F.col("own") != F.col("label")
        pairs = keep(dealt.join(grows(offered), ["size", "deal"]).where(kinds & (F.col("asks") <= F.col("longest") * _SLACK)).select("block", "bucket"), "meetings")
        left = rows.select("bucket", "row", "vec_id", "vector").join(grows(pairs), "bucket")
        right = ready.select("block", "anchor", "vec_id", "norm", "vector", "wishes").join(grows(pairs), "block")
        right = right.select("block", "bucket", "anchor", "vec_id", "norm", F.col("vector").cast(kind).alias("vector"), "wishes")
        hits = left.groupBy("block", "bucket").cogroup(right.groupBy("block", "bucket")).applyInArrow(lambda a, b: _search(a, b, count), _HIT)
        done = hits if best is None else hits.unionByName(best.drop("nth"))
        before, best = best, keep(_best(done, count), "hits")
        discard(ready, pairs, *([before] if before is not None else []))
    discard(meta)
    return best


def hard_negatives(df: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(256 x). An anchor's positives are the ``positives`` rows of its label
    with the highest inner products, ties to the smaller id; for each the first ``negatives`` rows of
    other labels follow whose score s satisfies low * positive <= 100 s <= high * positive.

    Rows whose id, label or vector is null, or whose vector holds a null or non-finite component,
    take no part; rows repeated with id, label and vector count once; a row's own id is never its
    positive. Empty vectors take no part, and those of
    another length have no score with an anchor. Scores
    beyond 64 bits stay at the ends of a long. An empty table or one without anchors gives no rows.
    """
    spark = session_of(df)
    kind = "array<float>" if df.select(vector).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
    wide = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast(kind).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = wide.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    # Rows repeated with id, label and vector meet by id, which few rows share.
    once = rows.groupBy("vec_id", "label", "vector").agg(F.max("is_anchor").alias("is_anchor"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), F.lit(2.0)))
    measured = keep(once.withColumn("size", F.size("vector")).where(F.col("size") > 0).withColumn("norm", F.sqrt(square)).withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = _cut(measured.where("is_anchor").drop("is_anchor").withColumn("anchor", F.col("row")), BLOCK, "block")
    rows = _cut(measured.drop("is_anchor"), BUCKET, "bucket")
    every = anchors.select("anchor", F.lit(0).alias("wish"), F.lit(-_LONG).alias("low"), F.lit(_LONG).alias("high"))
    best = _waves(rows, anchors, every, True, positives)
    tenth = lambda percent: F.col("score").cast("decimal(19,0)") * F.lit(percent).cast("decimal(9,0)") / F.lit(100).cast("decimal(3,0)")
    windows = best.select("anchor", F.col("nth").alias("wish"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"), F.ceil(tenth(low)).cast("long").alias("low"), F.floor(tenth(high)).cast("long").alias("high"))
    windows = keep(windows.where(F.col("low") <= F.col("high")), "windows")
    found = _waves(rows, anchors, windows.select("anchor", "wish", "low", "high"), False, negatives)
    named = windows.join(grows(anchors.select("anchor", F.col("vec_id").alias("anchor_id"))), "anchor").select("anchor", "anchor_id", "wish", "positive_id", "positive_score")
    out = keep(named.join(grows(found), ["anchor", "wish"]).select("anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
    discard(measured, anchors, rows, best, windows, found)
    return out


@query("op12_hard_negatives")
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
