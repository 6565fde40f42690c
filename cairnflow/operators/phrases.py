"""Dictionary phrases in texts: all entries of a table found in one reading of each text.

Texts and phrases are lower-cased and parted into words (letters, digits and whatever is not
ASCII); a phrase is found where its words follow one another, so word bounds are kept. A table
of at most MOST entries is compiled into a word trie that each task walks; a larger one is met
by joining the texts' word n-grams with it, hashed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import grows

#: Entries of a table that is small enough to be sent to every task.
MOST = 50_000
#: Bits of the bitmap of a larger table's phrases (fixed, 8 MB), and of one of its rows; rows of a batch of texts.
BITS, ROW_BITS, BATCH_ROWS = 1 << 26, 1 << 15, 1000
WORD = r"[0-9a-z\x80-\U0010ffff]+"
HIT = T.StructType().add("kind", T.StringType()).add("label", T.StringType()).add("rank", T.IntegerType()).add("at", T.IntegerType())


def _words(text: str) -> list[str]:
    return re.findall(WORD, text)


def _trie(entries: list[tuple[str, str, int, str]]) -> dict:
    """Words to nodes; under None what ends there: (kind, label, rank)."""
    root: dict = {}
    for kind, label, rank, phrase in entries:
        node = root
        for word in _words(phrase):
            node = node.setdefault(word, {})
        if node is not root:
            node.setdefault(None, []).append((kind, label, rank))
    return root


def find_phrases(words: list[str], root: dict) -> list[tuple[str, str, int, int]]:
    """(kind, label, rank, at) of every entry found, in order of place, then rank."""
    out = []
    get = root.get
    for at, word in enumerate(words):
        node, k = get(word), at + 1
        while node is not None:
            out += [(*end, at) for end in node.get(None, ())]
            node = node.get(words[k]) if k < len(words) else None
            k += 1
    return sorted(out, key=lambda h: (h[3], h[2], h[0] or "", h[1] or ""))


def with_phrases(df: DataFrame, text: str, table: DataFrame, out: str = "hits", key: str | None = None, most: int = MOST) -> DataFrame:
    """``df`` with ``out``: array of (kind, label, rank, at) of the entries of ``table`` found in ``text``, by place and rank.

    ``table`` has kind, label, rank (int) and phrase; overlapping entries are all found, and
    repeated ones as often as they are there. A null text or one without an entry has an empty
    array; entries without a word are never found. A table of over ``most`` entries needs ``key``,
    a column of ``df`` without nulls that tells its rows apart. A column named like ``out`` is replaced.
    """
    entries = table.select("kind", "label", F.col("rank").cast("int").alias("rank"), F.lower("phrase").alias("phrase")).where("phrase IS NOT NULL")
    rows = df.drop(out)
    first = entries.limit(most + 1).collect()
    if len(first) > most:
        return _joined(rows, text, entries, out, key)
    listed = sorted(((r.kind, r.label, r["rank"], r.phrase) for r in first), key=repr)
    names = rows.columns
    low = "__low" + "_" * max(map(len, names))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = _trie(listed)
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("rank", pa.int32()), ("at", pa.int32())]))
        for batch in batches:
            hits = [[dict(zip(("kind", "label", "rank", "at"), h, strict=True)) for h in find_phrases(_words(t), root)] if t else [] for t in batch.column(low).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(hits, kinds)], names=[*names, out])

    # A text that is only read for its phrases need not come back.
    return rows.withColumn(low, F.lower(F.col(text))).mapInArrow(match, T.StructType(list(rows.schema)).add(out, T.ArrayType(HIT)))


def _place(n: Column, gram: Column) -> Column:
    """The bitmap's place of an n-gram."""
    return F.pmod(F.xxhash64(n, gram), F.lit(BITS)).cast("int")


def _bitmap(places: DataFrame) -> bytes:
    """BITS bits, on at the places given (bit); as many bytes whatever the number of places."""
    rows = places.groupBy(F.shiftright("bit", 15).alias("row")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(ROW_BITS - 1).cast("long")).alias("bits"))
    out = bytearray(BITS // 8)
    for r in rows.toLocalIterator():
        out[r.row * ROW_BITS // 8 : (r.row + 1) * ROW_BITS // 8] = r.bits
    return bytes(out)


def _joined(rows: DataFrame, text: str, entries: DataFrame, out: str, key: str | None) -> DataFrame:
    """The same by hash: n-grams of the lengths that the table has, met with its entries; a bitmap of fixed size tells in the tasks which may be met."""
    if key is None:
        raise ValueError("a large table of phrases needs a key column")
    conf = rows.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:  # texts are long
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    words = lambda c: F.regexp_extract_all(c, F.lit(r"[0-9a-z\x{80}-\x{10FFFF}]+"), F.lit(0))
    keyed = entries.withColumn("w", words(F.col("phrase"))).where(F.size("w") > 0).select("kind", "label", "rank", F.size("w").alias("n"), F.array_join("w", " ").alias("gram"))
    sizes = F.array(*[F.lit(r.n) for r in keyed.select("n").distinct().orderBy("n").collect()])  # a row for each length
    bits = rows.sparkSession.sparkContext.broadcast(_bitmap(keyed.select(_place(F.col("n"), F.col("gram")).alias("bit"))))

    @F.pandas_udf("array<int>")
    def marked(places: pd.Series) -> pd.Series:
        on = np.frombuffer(bits.value, np.uint8)
        return places.map(lambda p: np.flatnonzero(on[(at := np.asarray(p, np.int64)) >> 3] >> (at & 7).astype(np.uint8) & 1).astype(np.int32))

    # Grams stay with their text until the bitmap has dropped nearly all that no entry is equal to.
    gram = lambda s: F.array_join(F.slice("w", s["at"] + 1, s["n"]), " ")
    spots = F.flatten(F.transform(sizes, lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda at: F.struct(at.alias("at"), n.alias("n")))).otherwise(F.array().cast("array<struct<at:int,n:int>>"))))
    placed = rows.select(F.col(key).alias("__key"), words(F.lower(F.col(text))).alias("w")).where(F.size("w") > 0).withColumn("spots", spots)
    few = placed.withColumn("on", marked(F.transform("spots", lambda s: _place(s["n"], gram(s)))))
    grams = few.select("__key", F.explode(F.transform("on", lambda k: F.struct(F.get("spots", k)["at"].alias("at"), F.get("spots", k)["n"].alias("n"), gram(F.get("spots", k)).alias("gram")))).alias("g")).select("__key", "g.*")
    met = grams.join(grows(keyed), ["n", "gram"])
    order = F.array_sort(F.collect_list(F.struct("at", "rank", "kind", "label")))
    lists = met.groupBy("__key").agg(F.transform(order, lambda h: F.struct(h["kind"].alias("kind"), h["label"].alias("label"), h["rank"].alias("rank"), h["at"].alias("at"))).alias(out))
    joined = rows.join(grows(lists), F.col(key) == F.col("__key"), "left").drop("__key")
    return joined.withColumn(out, F.coalesce(out, F.array().cast(T.ArrayType(HIT))))


def first_label(hits: Column, kind: str) -> Column:
    """The label of the found entry of ``kind`` with the lowest rank; null without one."""
    own = F.filter(hits, lambda h: h["kind"] == kind)
    return F.array_min(F.transform(own, lambda h: F.struct(h["rank"].alias("rank"), h["label"].alias("label"))))["label"]


def every_label(hits: Column, kind: str) -> Column:
    """The distinct labels of ``kind`` found, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(hits, lambda h: h["kind"] == kind), lambda h: h["label"])))


def has_label(hits: Column, kind: str) -> Column:
    """Whether an entry of ``kind`` was found."""
    return F.exists(hits, lambda h: h["kind"] == kind)
