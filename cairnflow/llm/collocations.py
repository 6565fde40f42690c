"""Phrase collocations: n-grams as rows, counted exactly by language, scored by their weakest cut.

Two passes over the texts. The first makes rows of all single words and word pairs, summed
inside tasks and then by hash. The second makes rows of the longer n-grams. As no phrase is
more frequent than a pair inside it, a bitmap of the frequent pairs, of one fixed size, keeps
phrases with a rare pair from being rows at all; it may let some pass that are rare, never
the reverse, and what passes is counted exactly. Parts of a candidate are as frequent as it
is, so the counts that scores need are all among those kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, grows, keep, session_of, table
from .registry import query

MAX_WORDS, LEAST, TOP, INSIDE = 4, 30, 2000, 80
UNKNOWN = "und"
#: Words a task gathers before it sums their n-grams, and rows of a batch of these.
GATHER, BATCH = 1_500_000, 100_000
#: Bits of the bitmap of frequent pairs (fixed, 8 MB), and of one of its rows.
BITS, ROW_BITS = 1 << 26, 1 << 15
#: A-Z to a-z, tabs to spaces, what ends a piece to line feeds.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_COUNTS = "lang string, phrase string, words int, n long"


def _bit(lang: bytes, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bitmap's place of word pairs, of the words' own hashes."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(zlib.crc32(lang))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(38)).astype(np.int64)


def _hash(word: bytes) -> int:
    return zlib.crc32(word) << 32 | zlib.crc32(word[::-1])


class _Gatherer:
    """Word numbers of one task's texts, and the n-grams among them summed."""

    def __init__(self, sizes: range, bitmap: bytes | None):
        self.sizes, self.bitmap = sizes, None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.of: dict[bytes, int] = {b"\n": 0, b"": -1}  # a piece's end; what is between two spaces
        self.by_lang: dict[str, list[np.ndarray]] = {}
        self.held = 0

    def add(self, lang: str, text: bytes) -> None:
        words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        of = self.of
        for w in set(words).difference(of):
            of[w] = len(of)
        ids = np.fromiter(map(of.__getitem__, words), np.int64, len(words))
        self.by_lang.setdefault(lang, []).extend((ids[ids >= 0], np.zeros(1, np.int64)))
        self.held += len(words)

    def flush(self) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, words, n) of the n-grams; with no phrase, the number of words."""
        words = [b""] * len(self.of)
        for w, k in self.of.items():
            words[k] = w
        words[0] = b""
        marks = None if self.bitmap is None else np.array([_hash(w) for w in words], np.uint64)
        for lang, parts in self.by_lang.items():
            ids = np.concatenate(parts)
            alive = ids > 0  # n-grams that start here and stay in their piece
            if self.sizes[0] == 1:
                yield _batch(lang, [None], 0, np.array([np.count_nonzero(alive)]))
                count = np.bincount(ids, minlength=len(words))
                count[0] = 0
                seen = np.flatnonzero(count)
                yield from _batches(lang, [words[k] for k in seen.tolist()], 1, count[seen])
            if marks is not None:
                at = _bit(lang.encode(), marks[ids[:-1]], marks[ids[1:]])
                frequent = (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            names, key = words, ids  # the n-gram that starts at each place, by number, and what the numbers stand for
            for size in range(2, min(self.sizes[-1], len(ids)) + 1):
                n = len(ids) - size + 1
                alive = alive[:n] & (ids[size - 1 :] > 0)
                if marks is not None:
                    alive &= frequent[size - 2 :]
                seen, number, count = np.unique((key[:n] << 32 | ids[size - 1 :])[alive], return_inverse=True, return_counts=True)
                names = [b"%b %b" % (names[a], words[b]) for a, b in zip((seen >> 32).tolist(), (seen & 0xFFFFFFFF).tolist(), strict=True)]
                key = np.zeros(n, np.int64)
                key[alive] = number
                if size in self.sizes:
                    yield from _batches(lang, names, size, count)
        self.clear()


def _batches(lang: str, phrases: list, size: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(phrases), BATCH):
        yield _batch(lang, phrases[k : k + BATCH], size, counts[k : k + BATCH])


def _batch(lang: str, phrases: list, size: int, counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(np.full(n, size, np.int32)), pa.array(counts, pa.int64())], names=["lang", "phrase", "words", "n"])


def _exploded(docs: DataFrame, sizes: range, bitmap=None) -> DataFrame:
    """A row for each n-gram of these sizes, summed within a task's gatherings."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Gatherer(sizes, None if bitmap is None else bitmap.value)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), pc.cast(batch.column("text"), pa.binary()).to_pylist(), strict=True):
                own.add(lang, text)
                if own.held >= GATHER:
                    yield from own.flush()
        yield from own.flush()

    return docs.mapInArrow(explode, _COUNTS)


def _bitmap(pairs: DataFrame) -> bytes:
    """BITS bits, on where a frequent pair hashes to; as many bytes whatever the number of pairs."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_bit(lang.encode(), *(np.array([_hash(w)], np.uint64) for w in phrase.encode().split(b" ")))[0] for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, np.int64))], names=["bit"])

    rows = pairs.mapInArrow(places, "bit long").groupBy(F.shiftright("bit", 15).alias("row")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(ROW_BITS - 1)).alias("bits"))
    out = bytearray(BITS // 8)
    for r in rows.toLocalIterator():
        out[r.row * ROW_BITS // 8 : (r.row + 1) * ROW_BITS // 8] = r.bits
    return bytes(out)


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Tables (lang, phrase, words, n) of all phrases of 1 to ``max_words`` words found ``least`` times or more, and (lang, total)."""
    spark = session_of(df)
    docs = df.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    summed = lambda rows: rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    short = keep(summed(_exploded(docs, range(1, min(max_words, 2) + 1))).where((F.col("n") >= least) | F.col("phrase").isNull()), "short-phrases")
    found, totals = short.where(F.col("phrase").isNotNull()), short.where(F.col("phrase").isNull()).select("lang", F.col("n").alias("total"))
    if max_words > 2:
        bitmap = spark.sparkContext.broadcast(_bitmap(found.where("words = 2")))
        long = keep(summed(_exploded(docs, range(3, max_words + 1), bitmap)).where(F.col("n") >= least), "long-phrases")
        found = found.unionByName(long)
    return found, totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``max_words`` words.

    Texts are lower-cased (A-Z), parted at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at spaces and
    tabs into words. A candidate occurs a >= ``least`` times; cut after its first k words, whose
    counts are l and r, it scores floor(2000000 a / (l + r)); the lowest cut counts, the first of
    equal ones. Candidates inside a longer one that has ``inside`` percent of their count or more
    go. Best first by score, a, then phrase (in UTF-8 order).

    A null language is ``und``, a null text empty; repeated rows count as often as they come;
    other columns, whatever their names, are not read. An empty table gives no rows.
    """
    found, totals = frequent_phrases(df, text, lang, max_words, least)
    parts = found.select("lang", "phrase", "n")
    longer = found.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = lambda first, size: F.array_join(F.slice("w", first, size), " ")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select("lang", "phrase", F.col("n").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cuts = cuts.join(grows(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))), ["lang", "left"])
    cuts = cuts.join(grows(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumn("sum", exact("l") + exact("r")).withColumn("twice", exact("a") * F.lit(2_000_000)).withColumn("score", F.expr("twice div sum"))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # One word longer is enough: what lies between a phrase and a longer one around it is as frequent as the longer.
    wider = longer.where("words > 2").select("lang", F.explode(F.array_distinct(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1)))).alias("phrase"), exact("n").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    covered = longer.join(grows(wider), ["lang", "phrase"]).where(F.col("f") * 100 >= exact("n") * inside).select("lang", "phrase")
    ranked = worst.join(grows(covered), ["lang", "phrase"], "left_anti").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
parted AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM parted WHERE len(w) > 0),
counted AS MATERIALIZED (
  SELECT lang, m AS words, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n
  FROM placed, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM counted WHERE words = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT * FROM counted WHERE n >= 30),
cands AS MATERIALIZED (SELECT lang, phrase, words, n AS a, string_split(phrase, ' ') AS w FROM frequent WHERE words > 1),
places AS (SELECT *, unnest(range(1, words)) AS k FROM cands),
parts AS (SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:words], ' ') AS rest FROM places),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r, (2000000::HUGEINT * c.a) // (l.n::HUGEINT + r.n) AS score
  FROM parts c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.first JOIN frequent r ON r.lang = c.lang AND r.phrase = c.rest),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, c.a AS f
  FROM cands c, (VALUES (1), (2), (3)) AS starts(i), (VALUES (2), (3)) AS sizes(m) WHERE m < c.words AND i + m - 1 <= c.words),
kept AS (SELECT * FROM worst w WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.lang = w.lang AND s.phrase = w.phrase AND 100 * s.f >= 80 * w.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, rank, phrase, a, l, r, t.n, score::BIGINT AS score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
"""


@query("op13_collocations", SQL13)
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
