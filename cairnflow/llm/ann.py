"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector of the table is then sent down to its
leaf. A query visits leaves best-bin-first: a priority queue yields the node of the highest
promise, inner nodes put their children in. How many leaves are visited is calibrated: the
true neighbours of a few queries, found by brute force over all rows, must be reached.

Equal vectors are searched once. Of a vector that many rows hold only the TOP + 1 smallest
ids can be among the nearest of anything, so no more are carried, and no result is lost.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, discard, keep, session_of, table
from .registry import query

TOP = 20
#: Rows the tree is fitted on (its leaves are at most a fourth of them), rows a leaf is meant to hold, branches at most.
FIT_ROWS = 60_000
LEAF_ROWS = 150
BRANCHES = 8
#: Queries that calibrate the visits, the recall they must reach, and leaves added to what they need.
CALIBRATE = 120
RECALL = 0.94
MARGIN = 2
#: Rows and queries of one cell of the search, about.
CELL_ROWS, CELL_QUERIES = 8192, 1024


class Tree:
    """Nodes in breadth: centres, spreads, first child (or -1) and number of children; leaves numbered."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        least = max(2, -(-len(sample) // max(1, leaves)))
        centres, spreads, self.child, self.children = [sample.mean(axis=0)], [0.0], [-1], [0]
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop(0)
            own = sample[rows]
            spreads[node] = float(np.sqrt(((own - centres[node]) ** 2).sum(axis=1).mean()))
            k = min(BRANCHES, max(2, len(rows) // least))
            if len(rows) <= least:
                continue
            means, label = self._kmeans(own, k, rng)
            used = np.unique(label)
            if len(used) < 2:
                continue
            self.child[node], self.children[node] = len(centres), len(used)
            for c in used:
                todo.append((len(centres), rows[label == c]))
                centres.append(means[c])
                spreads.append(0.0)
                self.child.append(-1)
                self.children.append(0)
        self.centres, self.spreads = np.array(centres), np.array(spreads)
        self.child, self.children = np.array(self.child), np.array(self.children)
        self.leaf = np.full(len(centres), -1)
        ends = np.flatnonzero(self.child < 0)
        self.leaf[ends] = np.arange(len(ends))
        self.leaves = len(ends)

    @classmethod
    def of(cls, parts: dict) -> Tree:
        """A tree from its arrays; these travel, as tasks need not know the class."""
        tree = cls.__new__(cls)
        tree.__dict__.update(parts)
        return tree

    @staticmethod
    def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        means = rows[rng.choice(len(rows), k, replace=False)]
        label = np.zeros(len(rows), dtype=np.int64)
        for _ in range(8):
            label = ((means**2).sum(axis=1) - 2 * rows @ means.T).argmin(axis=1)
            for c in range(k):
                if (own := label == c).any():
                    means[c] = rows[own].mean(axis=0)
        return means, label

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: down to the nearest child until there is none."""
        at = np.zeros(len(rows), dtype=np.int64)
        going = np.flatnonzero(self.child[at] >= 0)
        while len(going):
            for node in np.unique(at[going]):
                own = going[at[going] == node]
                first, n = self.child[node], self.children[node]
                means = self.centres[first : first + n]
                at[own] = first + ((means**2).sum(axis=1) - 2 * rows[own] @ means.T).argmin(axis=1)
            going = going[self.child[at[going]] >= 0]
        return self.leaf[at]

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, the most promising node opened next."""
        norm = float(np.sqrt(query @ query))
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.child[node] < 0:
                found.append(int(self.leaf[node]))
                continue
            first, n = self.child[node], self.children[node]
            promise = self.centres[first : first + n] @ query + 0.5 * norm * self.spreads[first : first + n]
            for k in range(n):
                heapq.heappush(queue, (-float(promise[k]), first + k))
        return found


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 1)


def _usable(vector: str, size: int | None = None) -> Column:
    v = F.col(vector)
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok if size is None else ok & (F.size(v) == size), F.lit(False))


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, lows: np.ndarray, top: int, scores: np.ndarray | None = None) -> pa.RecordBatch:
    """Each query's ``top`` best rows by the inner product, summed without loss and rounded once, ties to the lower ``lows``.

    ``scores`` are near values of the products, -inf for rows that the query does not visit.
    """
    scores = queries @ rows.T if scores is None else scores
    k = min(top, scores.shape[1])
    # The k-th best near score less what rounding can change: whatever reaches it is compared exactly.
    reach = np.partition(scores, -k, axis=1)[:, -k] if k else np.zeros(len(queries))
    slack = 4e-16 * (queries.shape[1] + 2) * np.sqrt((queries**2).sum(axis=1) * (rows**2).sum(axis=1).max(initial=0.0))
    out: list[list] = [[], [], []]
    for q in range(len(queries)):
        near = np.flatnonzero((scores[q] >= reach[q] - slack[q]) & (scores[q] > -np.inf))
        own = queries[q].tolist()
        exact = [(-math.sumprod(own, x), int(low), int(i)) for x, low, i in zip(rows[near].tolist(), lows[near].tolist(), ids[near].tolist(), strict=True)]
        for score, _, r in heapq.nsmallest(top, exact):
            for column, value in zip(out, (int(query_ids[q]), r, -score), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query", "found", "score"])


_FOUND = "query long, found long, score double"


def _top(found: DataFrame, classes: DataFrame) -> DataFrame:
    """The TOP + 1 best classes of each query."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "low")
    return found.join(classes.select(F.col("class_id").alias("found"), F.col("ids")[0].alias("low")), "found").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= TOP + 1)


def nearest(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the TOP largest inner products of each query row.

    Candidates are all rows but those of the query's own id. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do those of another length than
    most; null ids neither. Rows repeated with id and vector count once; ties go to the
    smaller id. With fewer candidates all are returned; an empty table gives no rows.
    """
    spark = session_of(df)
    kind = "array<float>" if df.select(vector).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
    wide = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where(F.col("vec_id").isNotNull() & _usable("vector"))
    sizes = wide.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = wide.where(F.size("vector") == sizes.size).withColumn("mark", F.xxhash64("vector"))
    lowest = rows.dropDuplicates(["mark", "vector", "vec_id"]).withColumn("nth", F.row_number().over(Window.partitionBy("mark", "vector").orderBy("vec_id"))).where(F.col("nth") <= TOP + 1)
    asked = rows.where("is_query").groupBy("mark", "vector").agg(F.lit(True).alias("asked"))
    classes = lowest.groupBy("mark", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).join(asked, ["mark", "vector"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    classes = keep(classes.withColumn("class_id", F.monotonically_increasing_id()), "vectors")
    count = classes.count()
    leaves = max(1, min(FIT_ROWS // 4, -(-count // LEAF_ROWS)))
    sample = bounded_sample(classes, F.xxhash64(F.lit(3), "vector"), FIT_ROWS).select("vector").orderBy("vector").toPandas()["vector"]
    tree = Tree(np.array(sample.tolist(), dtype=np.float64), leaves)
    parts_of = spark.sparkContext.broadcast(dict(tree.__dict__))

    def send_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.of(parts_of.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("class_id"), batch.column("vector"), batch.column("low"), pa.array(own.assign(_matrix(batch.column("vector"))).astype(np.int32))], names=["class_id", "vector", "low", "leaf"])

    placed = keep(classes.select("class_id", "vector", F.col("ids")[0].alias("low")).mapInArrow(send_down, f"class_id long, vector {kind}, low long, leaf int"), "leaves")

    # Calibrate on a few queries: their true neighbours, by brute force over all rows.
    probes = classes.where("asked").select("class_id", "vector").orderBy(F.xxhash64(F.lit(4), "vector"), "vector").limit(CALIBRATE).toPandas()
    if not len(probes):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    probe_ids, probe_rows = probes["class_id"].to_numpy(), np.array(probes["vector"].tolist(), dtype=np.float64)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _best(probe_ids, probe_rows, np.array(batch.column("class_id")), _matrix(batch.column("vector")), np.array(batch.column("low")), TOP + 1)

    truth = _top(placed.select("class_id", "vector", "low").mapInArrow(brute, _FOUND), classes).join(placed.select(F.col("class_id").alias("found"), "leaf"), "found").select("query", "leaf").collect()
    orders = {int(q): {leaf: k for k, leaf in enumerate(tree.visit(v, tree.leaves))} for q, v in zip(probe_ids, probe_rows, strict=True)}
    needed = np.sort([orders[r.query][r.leaf] + 1 for r in truth])
    visits = min(tree.leaves, int(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))]) + MARGIN)

    # Neighbouring leaves make up cells of about CELL_ROWS rows; a larger leaf is dealt to several cells by hash.
    sizes = np.zeros(tree.leaves, dtype=np.int64)
    for r in placed.groupBy("leaf").count().collect():
        sizes[r.leaf] = r["count"]
    parts = np.maximum(1, -(-sizes // CELL_ROWS))
    first, cell, room = np.zeros(tree.leaves, dtype=np.int64), 0, CELL_ROWS
    for leaf in range(tree.leaves):
        if sizes[leaf] > room and room < CELL_ROWS:
            cell, room = cell + 1, CELL_ROWS
        first[leaf] = cell
        if parts[leaf] > 1:
            cell, room = cell + int(parts[leaf]), CELL_ROWS
        else:
            room -= int(sizes[leaf])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.of(parts_of.value)
        for batch in batches:
            at, cells, leaves = [], [], []
            for k, q in enumerate(_matrix(batch.column("vector"))):
                asked: dict[int, list[int]] = {}
                for leaf in own.visit(q, visits):
                    for c in range(first[leaf], first[leaf] + parts[leaf]):
                        asked.setdefault(int(c), []).append(leaf)
                at += [k] * len(asked)
                cells += list(asked)
                leaves += list(asked.values())
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), batch.column("class_id").take(pa.array(at, pa.int32())), batch.column("vector").take(pa.array(at, pa.int32())), pa.array(leaves, pa.list_(pa.int32()))], names=["cell", "query", "q", "leaves"])

    asks = keep(classes.where("asked").select("class_id", "vector").mapInArrow(choose, f"cell long, query long, q {kind}, leaves array<int>"), "visits")
    blocks = keep(asks.groupBy("cell").agg(F.ceil(F.count("*") / CELL_QUERIES).alias("blocks")), "blocks")
    asks_kept, asks = asks, asks.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("query"), "blocks"))
    split = placed.join(spark.createDataFrame([(k, int(first[k]), int(parts[k])) for k in range(tree.leaves)], "leaf int, first long, parts long"), "leaf").withColumn("cell", F.col("first") + F.pmod(F.xxhash64("class_id"), "parts"))
    cells = split.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "found": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, v, leaf = _matrix(queries.column("q")), _matrix(rows.column("vector")), np.array(rows.column("leaf"))
        scores = np.full((len(q), len(v)), -np.inf)
        by_leaf: dict[int, list[int]] = {}
        for k, leaves in enumerate(queries.column("leaves").to_pylist()):
            for x in leaves:
                by_leaf.setdefault(x, []).append(k)
        for x, who in by_leaf.items():
            which = np.flatnonzero(leaf == x)
            scores[np.ix_(who, which)] = q[who] @ v[which].T
        return pa.Table.from_batches([_best(np.array(queries.column("query")), q, np.array(rows.column("class_id")), v, np.array(rows.column("low")), TOP + 1, scores)])

    found = cells.select("cell", "block", "class_id", "vector", "low", "leaf").groupBy("cell", "block").cogroup(asks.select("cell", "block", "query", "q", "leaves").groupBy("cell", "block")).applyInArrow(search, _FOUND)
    # From classes to ids: the TOP + 1 best rows of each distinct query vector, then each query row's own list.
    listed = _top(found, classes).join(classes.select(F.col("class_id").alias("found"), "ids"), "found").select("query", "score", F.explode("ids").alias("vec_id"))
    ranked = listed.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= TOP + 1)
    lists = ranked.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("list"))
    by_vector = keep(classes.where("asked").join(lists, F.col("class_id") == F.col("query")).select("mark", "vector", "list"), "lists")
    discard(asks_kept, placed, blocks, classes)
    own = rows.where("is_query").select("mark", "vector", F.col("vec_id").alias("query_id")).join(by_vector, ["mark", "vector"]).dropDuplicates(["query_id", "mark", "vector"])
    rest = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, TOP)
    return own.select("query_id", F.posexplode(rest).alias("pos", "hit")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


@query("op7_ann")
def op7_ann(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
