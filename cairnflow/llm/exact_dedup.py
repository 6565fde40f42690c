"""Exact dedup by deterministic block naming.

A text, freed of white space, is cut into blocks of a fixed number of bytes. Equal
blocks get one integer name, by sorting; then adjacent pairs of names are sorted and
named in turn, level by level, until each document holds one name. Two documents have
the same level and name only if their texts are equal: no hash decides anything.

Blocks are first told apart inside each task, so a block that a third of all documents
share moves once per task, not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, discard, grows, keep, session_of, table, worker_store
from .registry import query

#: Bytes of a block, and bytes of distinct blocks that a task remembers before it starts afresh.
BLOCK_BYTES = 4096
REMEMBER_BYTES = 64 << 20

_CUT = "row_id long, doc_id long, n_points long, text_sha256 string, names array<long>, local_id long, block binary"
_CUT_ARROW = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_points", pa.int64()), ("text_sha256", pa.string()), ("names", pa.list_(pa.int64())), ("local_id", pa.int64()), ("block", pa.binary())])


def _cutter(block_bytes: int, remember: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("exact_dedup")  # what an operator before remembered is not needed here
        first = TaskContext.get().partitionId() << 40
        known: dict[bytes, int] = {}
        held = used = 0
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            points = pc.utf8_length(texts)
            shas, names, new_ids, new_blocks = [], [], [], []
            for raw in texts.cast(pa.binary()).to_pylist():
                text = raw.translate(None, SPACES)
                shas.append(hashlib.sha256(text).hexdigest())
                own = []
                for at in range(0, len(text) or 1, block_bytes):
                    block = text[at : at + block_bytes]
                    name = known.get(block)
                    if name is None:
                        name = known[block] = first + used
                        used += 1
                        held += len(block)
                        new_ids.append(name)
                        new_blocks.append(block)
                    own.append(name)
                names.append(own)
                if held > remember:
                    known, held = {}, 0
            n, m = batch.num_rows, len(new_ids)
            pad = lambda col, kind: pa.concat_arrays([pa.array(col, kind), pa.nulls(m, kind)])
            yield pa.RecordBatch.from_arrays(
                [
                    pad(batch.column("row_id"), pa.int64()),
                    pad(batch.column("doc_id").cast(pa.int64()), pa.int64()),
                    pad(points.cast(pa.int64()), pa.int64()),
                    pad(shas, pa.string()),
                    pad(names, pa.list_(pa.int64())),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(new_ids, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(new_blocks, pa.binary())]),
                ],
                schema=_CUT_ARROW,
            )

    return cut


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer names in sorted order; equal blocks stand side by side in one task."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for batch in batches:
        names = []
        for block in batch.column("block").to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays([batch.column("local_id"), pa.array(names, pa.int64())], names=["local_id", "name"])


def identities(cut: DataFrame) -> DataFrame:
    """Rows (row_id, level, name): equal texts, and only those, share level and name."""
    blocks = cut.where(F.col("block").isNotNull()).select("local_id", "block")
    named = keep(blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_name_sorted, "local_id long, name long"), "block-names")
    at = cut.where(F.col("names").isNotNull()).select("row_id", F.size("names").alias("n"), F.posexplode("names").alias("pos", "local_id"))
    level, done = 0, []
    now = keep(at.join(grows(named), "local_id").select("row_id", "n", "pos", "name"), "block-level")
    while True:
        done.append(now.where("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        more = now.where("n > 1")
        if more.isEmpty():
            break
        half = F.col("pos") % 2
        pairs = more.groupBy("row_id", "n", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("right")
        )
        distinct = pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
        pair_names = keep(distinct.withColumn("name", F.monotonically_increasing_id()), "pair-names")
        now = keep(pairs.join(grows(pair_names), ["left", "right"]).select("row_id", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), "block-level")
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row_id: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``df``: row_id, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty, and empty
    texts form one group. Of a group the row with the most code points stays, then the
    smallest doc_id (nulls last), then the smallest ``row_id``: a unique long column of
    ``df``, made here when none is named. An empty table gives an empty result; other
    columns of ``df`` are not looked at.
    """
    session_of(df)
    key = F.col(row_id) if row_id else F.monotonically_increasing_id()
    rows = df.select(key.alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = keep(rows.mapInArrow(_cutter(block_bytes, REMEMBER_BYTES), _CUT), "cut")
    docs = cut.where(F.col("names").isNotNull()).select("row_id", "doc_id", "n_points", "text_sha256")
    named = keep(docs.join(grows(identities(cut)), "row_id"), "identities")
    discard(cut)
    best = F.min(F.struct((-F.col("n_points")).alias("short"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    groups = keep(named.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size")).where("group_size > 1").select("level", "name", "group_size", F.col("best.doc_id").alias("best_id"), F.col("best.row_id").alias("best_row")), "copy-groups")
    many = F.col("group_size").isNotNull()
    return named.join(grows(groups), ["level", "name"], "left").select(
        "row_id",
        "doc_id",
        F.when(many, F.col("best_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best_row") == F.col("row_id"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(raw) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row_id")
