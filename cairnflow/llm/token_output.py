"""Binary token output: every text's ids in segments of Simple-8b words.

Documents are dealt to tasks by ranges of doc_id, so the segments, read by (part, seq),
hold them in ascending order. A segment is a row of a table in the shared folder:
Spark's writer commits it, and a lost executor leaves no half-written file behind.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, session_of, table, worker_store
from .registry import query
from .simple8b import read_segment, write_segment

#: Ids after which a segment is closed, and chunks of text that a worker remembers.
SEGMENT_IDS = 1 << 20
REMEMBER = 700_000
#: Up to here (Latin, Greek, Cyrillic) all Unicode versions agree on what a letter is.
LAST_STABLE = "\u052f"
#: Bytes that a byte-level vocabulary spells as themselves (fixed values).
_PRINTABLE = ((33, 126), (161, 172), (174, 255))
#: White space that a text cut at single spaces and line ends does not hold; the cut of all others.
_ODD_SPACES = ("  ", "\n\n", " \n", "\n ", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\0")
_WIDE_SPACE = re.compile(r"[^\S\x00-\x7f]").search
_BEFORE_WORD = re.compile(r"(?= \S)").split

_SEGMENT = "part int, seq int, n_docs long, n_ids long, segment binary"
_SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("segment", pa.binary())])


class _Ids(dict):
    """The library's ids of whole texts, remembering those of chunks in two generations.

    The vocabulary's pre-tokenizer always parts a text before a space that a non-space
    follows, on both sides of a line end between non-spaces, and between a word and the
    marks after it. Chunks cut there are encoded alone: single words by the library's model,
    which skips its work on whole texts, all others by the library as a whole.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        shown = [b for low, high in _PRINTABLE for b in range(low, high + 1)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelled = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.space = self.spelled[32]
        self.remember = remember
        self.older: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, key: str) -> bytes:
        """The ids of a chunk: ``key`` after a space, or if it starts with a zero byte, the rest alone."""
        ids = self.older.get(key)
        if ids is None:
            word = key.rstrip(punctuation)
            letters = word[1:] if key[:1] == "\0" else word
            if letters.isalpha() and (letters.isascii() or max(letters) <= LAST_STABLE):
                if len(word) < len(key):  # marks are parted from the word before them
                    ids = self[word] + self["\0" + key[len(word) :]]
                else:
                    spelled = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.spelled)
                    ids = array("I", [t.id for t in self.merge(spelled if letters is not word else self.space + spelled)]).tobytes()
            else:
                ids = self.direct(key[1:] if key[:1] == "\0" else " " + key)
        self[key] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """A text's ids, as little-endian u32."""
        if any(s in text for s in self.special):
            return self.direct(text)  # the library looks for these in whole texts
        if any(s in text for s in _ODD_SPACES) or text[-1:] == " " or (not text.isascii() and _WIDE_SPACE(text)):
            own = [c[1:] if c[:1] == " " and c[1:2].strip() and c[1] != "\0" else "\0" + c for c in _BEFORE_WORD(text)]
        else:
            own = ("\0" + text.replace("\n", " \0\n \0")).split(" ")
            if own[0] == "\0":
                own = own[1:]  # the text starts with a space
        if len(self) > self.remember:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, own))


def _encoder(path: str, end_id: int, segment_ids: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("token_output")
        ids_of = store.get(path)
        if ids_of is None:
            ids_of = store[path] = _Ids(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        counts: list[int] = []
        held: list[bytes] = []
        total = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            values = [[part], [seq], [len(docs)], [len(ids)], [write_segment(docs, counts, ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _SEGMENT_ARROW, strict=True)], schema=_SEGMENT_ARROW)

        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = ids_of.encode(text) + end
                docs.append(doc)
                counts.append(len(ids) // 4)
                held.append(ids)
                total += counts[-1]
                if total >= segment_ids:
                    yield close()
                    docs, counts, held, total, seq = [], [], [], 0, seq + 1
        if docs:
            yield close()

    return encode


def write_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """A table of segments (part, seq, n_docs, n_ids, segment) with the ids of every whole text.

    Each document's ids end with ``end_id``. Null texts count as empty and hold only that
    id; a null doc_id sorts first; equal doc_ids are ordered by their texts. An empty table
    gives no segments; other columns are not looked at.
    """
    session_of(df)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"))
    return keep(rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text").mapInArrow(_encoder(path, end_id, segment_ids), _SEGMENT), "segments")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, data in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("segment").to_pylist(), strict=True):
            docs, counts, ids = read_segment(data)
            ends = np.cumsum(counts, dtype=np.int64)
            raw, n = ids.astype("<u4").tobytes(), len(docs)
            sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(ends - counts, pa.int64()), pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64())],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_tokens(segments: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), decoded from a table of segments.

    ``start`` counts the ids of all documents before. The ids of the parts before are added
    from one row for each part; parts are as many as the writer's shuffle partitions.
    """
    spark = session_of(segments)
    base, bases = 0, []
    for part, n in sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids")).collect()):
        bases.append((part, base))
        base += n
    by_part = spark.createDataFrame(bases, "part int, part_start long")
    earlier = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    starts = segments.select("part", "seq", "n_ids").join(by_part, "part").select("part", "seq", (F.col("part_start") + F.coalesce(earlier, F.lit(0))).alias("before"))
    docs = segments.select("part", "seq", "segment").mapInArrow(_reader, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


@query("op2_token_output")
def op2_token_output(spark, sf_dir):
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
