"""N-gram Jaccard join: a grouped prefix join over word shingles.

1. Shingles are ordered by how many documents hold them, estimated by a sketch of fixed
   size over the whole corpus: rare ones first. Any order gives right results; this one
   keeps common passages out of the prefixes.
2. Equal word sequences are one class; classes of one size and prefix are one group. Only
   groups are indexed by their prefix tokens, and tokens of a single group go at once.
3. Group pairs that share a token are filtered: their sizes fit, the first common token
   stands early enough in both, and the prefixes share as many tokens as the threshold
   implies. Only pairs that pass are expanded to their classes.
4. Classes are verified on the words themselves, never on hashes. Groups first meet one
   pivot of each token; pivots are drawn again as long as that ties buckets together.
   Then all pairs of groups that no chain of links joins yet are filtered, expanded and
   verified. What is found are links; a component is what links reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import discard, grows, keep, numbered, session_of, table, worker_store
from .registry import query

SHINGLE = 5
#: The threshold as a fraction: 80 / 100.
PART, WHOLE = 80, 100
#: Counters of the sketch that orders tokens, counters a merged row holds, and rows merged at once.
SKETCH = 1 << 21
CHUNK = 1 << 14
FAN_IN = 512
#: Rows of a token beyond which its bucket is split, and members verified against one copy of a pivot.
SPLIT_FROM = 4096
MEMBERS = 256
#: Pivots are drawn again while a draw closes at least this part of the open rows.
WORTH = 0.4
#: Classes whose texts are picked in the scan by a broadcast of their ids; more are merged by key.
FEW = 1_000_000
#: Groups that a task remembers.
REMEMBER = 250_000

_STEP = 0xC2B2AE3D27D4EB4F
#: Words hashed side by side, and a word whose hash shows that two workers hash alike.
AT_ONCE = 200_000
_PROBE = b"shingle words"


def _mixed(words: np.ndarray, n: int) -> np.ndarray:
    """The hashes of all runs of n words."""
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(_STEP)
        out += words[k : len(words) - n + 1 + k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def shingle_hashes(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text the sorted distinct hashes of its shingles, too few words making one, and a digest of its words.

    Words are hashed by Python's keyed SipHash, whose key Spark gives all its workers alike.
    """
    held: list[np.ndarray] = []
    digests: list[bytes] = []

    def give() -> Iterator[tuple[np.ndarray, bytes]]:
        flat = np.concatenate(held).view(np.uint64)
        runs = _mixed(flat, SHINGLE) if len(flat) >= SHINGLE else flat
        at = 0
        for own, digest in zip(held, digests, strict=True):
            n = len(own)
            yield _distinct(runs[at : at + n - SHINGLE + 1] if n >= SHINGLE else _mixed(flat[at : at + n], n) if n else flat[:0]), digest
            at += n

    total = 0
    for raw in texts:
        words = split_words(raw)
        held.append(np.fromiter(map(hash, words), np.int64, len(words)))
        digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
        total += len(words)
        if total >= AT_ONCE:
            yield from give()
            held.clear()
            digests.clear()
            total = 0
    if held:
        yield from give()


def split_words(raw: bytes | None) -> list[bytes]:
    """`[^\\x20\\x09-\\x0D]+` of a text whose A-Z are lower-cased."""
    return (raw or b"").lower().split()


def shingle_set(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """The distinct shingles themselves."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(_STEP)) >> np.uint64(65 - SKETCH.bit_length())).astype(np.int64)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a task hold each slot's shingles, in chunks of counters."""
    worker_store("jaccard_join")  # drops what an operator before remembered
    counts, seen = np.zeros(SKETCH, dtype=np.uint32), False
    for batch in batches:
        for own, _ in shingle_hashes(batch.column("text").cast(pa.binary()).to_pylist()):
            np.add.at(counts, _slots(own), 1)
            seen = seen or len(own) > 0
    if seen:
        own = np.minimum(counts, 65535).astype("<u2")  # an order needs no exact count
        chunks = [own[k : k + CHUNK].tobytes() for k in range(0, SKETCH, CHUNK)]
        n = len(chunks)
        yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([hash(_PROBE)] * n, pa.int64()), pa.array([2] * n, pa.int32()), pa.array(chunks, pa.binary())], names=["chunk", "probe", "bytes", "counts"])


def _add_chunks(group: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, dtype=np.uint64)
    for size, raw in zip(group.column("bytes").to_pylist(), group.column("counts").to_pylist(), strict=True):
        total += np.frombuffer(raw, dtype=f"<u{size}")
    return pa.table({"chunk": group.column("chunk").slice(0, 1).cast(pa.int32()), "probe": group.column("probe").slice(0, 1), "bytes": pa.array([4], pa.int32()), "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})


def token_sketch(rows: DataFrame) -> tuple[np.ndarray, int]:
    """SKETCH counters of documents by token, of that size whatever the corpus holds; and the probe's hash."""
    schema = "chunk int, probe long, bytes int, counts binary"
    chunks = rows.select("text").mapInArrow(_count_tokens, schema).withColumn("part", F.spark_partition_id() % FAN_IN)
    for keys in (["chunk", "probe", "part"], ["chunk", "probe"]):
        chunks = chunks.groupBy(*keys).applyInArrow(_add_chunks, schema)
    sketch, probes = np.zeros(SKETCH, dtype=np.uint32), {0: 0}
    for row in chunks.collect():
        sketch[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, dtype="<u4")
        probes[row.chunk] = row.probe
    if len(set(probes.values())) > 1:
        raise RuntimeError("Python workers hash words differently: give all executors one PYTHONHASHSEED")
    return sketch, probes[0]


_MARKED = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("gid", pa.int64()), ("prefix", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32()))])


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else [], kind))


def _marker(sketch, probe: int, split_from: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("jaccard_join")  # drops what an operator before remembered
        often, seen = sketch.value, set()
        noise = float(often.mean())  # what the other tokens of a slot add to a count
        noise += 6 * noise**0.5
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        for batch in batches:
            sizes, digests, gids, prefixes, parts = [], [], [], [], []
            for own, digest in shingle_hashes(batch.column("text").cast(pa.binary()).to_pylist()):
                n, gid = len(own), None
                prefix, part = none
                if n:
                    if hash(_PROBE) != probe:
                        raise RuntimeError("Python workers hash words differently: give all executors one PYTHONHASHSEED")
                    est = often[_slots(own)]
                    first = np.argsort(est, kind="stable")[: n - -(-PART * n // WHOLE) + 1]
                    tokens = own[first]
                    gid = int.from_bytes(hashlib.blake2b(n.to_bytes(8, "little") + tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if gid not in seen:
                        if len(seen) >= REMEMBER:
                            seen.clear()
                        seen.add(gid)
                        prefix, part = tokens.view(np.int64), (np.maximum(0, est[first] - noise) // split_from).astype(np.int32)
                for column, value in ((sizes, n), (digests, digest if n else None), (gids, gid), (prefixes, prefix), (parts, part)):
                    column.append(value)
            values = [batch.column("row_id"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(gids, pa.int64()), _lists(prefixes, pa.int64()), _lists(parts, pa.int32())]
            yield pa.RecordBatch.from_arrays(values, schema=_MARKED)

    return mark


def _overlap(a: str, b: str) -> Column:
    """Shingles that two linked sets share at least."""
    return F.ceil((F.col(a) + F.col(b)) * PART / F.lit(WHOLE + PART))


def _may_link(n: str, pos: str, other_n: str, other_pos: str) -> Column:
    """The sizes fit, and a token at these places can be the first that both hold."""
    return (F.least(n, other_n) * WHOLE >= F.greatest(n, other_n) * PART) & (F.col(pos) <= F.col(n) - _overlap(n, other_n)) & (F.col(other_pos) <= F.col(other_n) - _overlap(n, other_n))


def _apart(comp: str, other: str) -> Column:
    """Two groups that are not of one component; a group of several components has none."""
    return ~F.coalesce(F.col(comp) == F.col(other), F.lit(False))


def shared_tokens(marked: DataFrame) -> DataFrame:
    """Rows (token, gid, n, pos) of the prefix tokens of two groups or more.

    Tokens that the sketch shows in many documents are dealt in parts and all stay.
    """
    rows = marked.select("gid", "n", F.posexplode(F.arrays_zip("prefix", "parts")).alias("pos", "t")).select(F.col("t.prefix").alias("token"), F.when(F.col("t.parts") > 0, F.pmod("gid", F.col("t.parts") + 1)).alias("part"), "gid", "n", "pos")
    whole = Window.partitionBy("token", "part")
    rows = rows.withColumn("before", F.lag("gid").over(whole.orderBy("gid"))).withColumn("low", F.min("gid").over(whole)).withColumn("high", F.max("gid").over(whole))
    return rows.where("(before IS NULL OR before <> gid) AND (low <> high OR part IS NOT NULL)").select("token", "gid", "n", "pos")


def with_pivots(entries: DataFrame, ends: DataFrame, draw: Column) -> DataFrame:
    """The rows of open tokens, those of two components or more, each with its token's pivot.

    ``alone`` tells that all groups of a token are single classes: what its pivot is compared
    with is settled.
    """
    at = keep(entries.join(grows(ends.select("gid", "comp", "single")), "gid"), "at")
    buckets = at.groupBy("token").agg(F.min(F.struct(draw.alias("draw"), "gid", "n", "pos", "comp")).alias("p"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("comp").alias("known"), F.count("*").alias("k"), F.min("single").alias("alone"))
    pivots = buckets.where("k > 1 AND (known < k OR lo <> hi)").select("token", "alone", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("gid", "n", "pos", "comp")))
    joined = keep(at.join(grows(pivots), "token").drop("single"), "still")
    discard(at)
    return joined


def pivot_pairs(still: DataFrame) -> DataFrame:
    """Pairs (x, y) of groups: each token's pivot and the rows of its bucket that it may link with."""
    met = still.where((F.col("gid") != F.col("p_gid")) & _apart("comp", "p_comp") & _may_link("n", "pos", "p_n", "p_pos"))
    return met.select(F.col("p_gid").alias("x"), F.col("gid").alias("y"), F.col("p_n").alias("x_n"), F.col("n").alias("y_n")).distinct()


def open_pairs(still: DataFrame, split_from: int) -> DataFrame:
    """All pairs (x, y) of groups that may link by a common token.

    A token at a given place admits partners up to some size; both sides name the classes of
    sizes they admit, and only rows that admit each other's meet. The left rows of a large
    bucket are dealt over parts, the right ones stand in each part.
    """
    size_class = lambda c: F.floor(F.log(F.greatest(F.lit(1), c)) * 20).cast("int")
    least = F.ceil(F.col("n") * PART / F.lit(WHOLE))
    most = F.least(F.floor(F.col("n") * WHOLE / F.lit(PART)), F.floor((F.col("n") - F.col("pos")) * (WHOLE + PART) / F.lit(PART)) - F.col("n"))
    sized = still.withColumn("most", most).where(F.col("most") >= least).withColumn("wants", F.explode(F.sequence(size_class(least), size_class(F.col("most"))))).withColumn("own", size_class(F.col("n")))
    place = F.shiftleft("n", 24) + F.least("pos", F.lit((1 << 24) - 1))  # places only rule out
    met_at = lambda x, y: F.xxhash64("token", x, y)
    sized = keep(sized.select(met_at("own", "wants").alias("bucket"), met_at("wants", "own").alias("facing"), "gid", "comp", place.alias("place")), "open")
    counted = sized.groupBy("bucket").agg(F.count("*").alias("k"))
    parts = keep(counted.where(F.col("k") > split_from).select("bucket", F.ceil(F.col("k") / split_from).cast("int").alias("parts")), "open-parts")
    left = sized.select("bucket", F.col("gid").alias("x"), F.col("comp").alias("x_comp"), F.col("place").alias("x_place"))
    right = sized.select(F.col("facing").alias("bucket"), F.col("gid").alias("y"), F.col("comp").alias("y_comp"), F.col("place").alias("y_place"))
    if not parts.isEmpty():
        left = left.join(grows(parts), "bucket", "left").withColumn("bucket", F.xxhash64("bucket", F.pmod("x", F.coalesce("parts", F.lit(1))).cast("int"))).drop("parts")
        right = right.join(grows(parts), "bucket", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).withColumn("bucket", F.xxhash64("bucket", "part")).drop("parts", "part")
    met = left.join(grows(right), "bucket").where((F.col("x") < F.col("y")) & _apart("x_comp", "y_comp"))
    for side in ("x", "y"):
        met = met.withColumn(f"{side}_n", F.shiftright(f"{side}_place", 24)).withColumn(f"{side}_pos", F.col(f"{side}_place").bitwiseAND((1 << 24) - 1))
    pairs = keep(met.where(_may_link("x_n", "x_pos", "y_n", "y_pos")).select("x", "y", "x_n", "y_n").distinct(), "met")
    discard(sized, parts)
    return pairs


def filtered(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The group pairs whose prefixes share as many tokens as those of linked sets must."""
    own = lambda side: grows(prefixes.select(F.col("gid").alias(side), F.col("tokens").alias(f"{side}_tokens")))
    least = F.greatest(F.lit(1), _overlap("x_n", "y_n") + 1 - F.ceil(F.greatest("x_n", "y_n") * PART / F.lit(WHOLE)))
    return pairs.join(own("y"), "y").join(own("x"), "x").where(F.size(F.array_intersect("x_tokens", "y_tokens")) >= least).select("x", "y")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that a pivot (member null) stands before its members; the shingles compared are words."""
    worker_store("jaccard_join")  # drops what an operator before remembered
    pivot, own = None, set()
    for batch in batches:
        a, b = [], []
        for p, member, raw in zip(batch.column("pivot").to_pylist(), batch.column("member").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            other = shingle_set(split_words(raw))
            if member is None:
                pivot, own = p, other
                continue
            assert pivot == p
            both = len(own & other)
            if WHOLE * both >= PART * (len(own) + len(other) - both):
                a.append(p)
                b.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(pairs: DataFrame, rows: DataFrame, members: int) -> DataFrame:
    """The links among pairs (pivot, member) of row ids, by the texts' whole sets.

    Texts of few rows are picked in the scan by a broadcast of at most FEW ids; of more, by a
    merge. A pivot's text is repeated for each ``members`` members, so no task gathers all.
    """
    pairs = keep(pairs, "pairs")
    wanted = keep(pairs.select(F.explode(F.array("pivot", "member")).alias("row_id")).distinct(), "wanted")
    ids = F.broadcast(wanted) if wanted.count() <= FEW else grows(wanted)
    texts = keep(rows.select("row_id", "text").join(ids, "row_id", "left_semi"), "texts")
    copies = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / members).cast("int").alias("copies"))
    dealt = pairs.join(grows(copies), "pivot").withColumn("copy", F.pmod(F.xxhash64("member"), F.col("copies")).cast("int"))
    others = dealt.join(grows(texts.withColumnRenamed("row_id", "member")), "member").select("pivot", "copy", "member", "text")
    pivots = copies.join(grows(texts.withColumnRenamed("row_id", "pivot")), "pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long").alias("member"), "text")
    ordered = others.unionByName(pivots).repartition("pivot", "copy").sortWithinPartitions("pivot", "copy", F.asc_nulls_first("member"))
    links = keep(ordered.select("pivot", "member", "text").mapInArrow(_verify, "a long, b long"), "links")
    discard(pairs, wanted, texts)
    return links


def jaccard_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row_id: str | None = None, split_from: int = SPLIT_FROM, members: int = MEMBERS, worth: float = WORTH) -> DataFrame:
    """One row per row of ``df``: row_id, doc_id, n_shingles, component_id, class_size, component.

    Two documents link when the Jaccard similarity of their shingle sets is at least 0.8;
    component_id is the smallest doc_id that links reach. A null or blank text has no
    shingles, links with nothing and has a null ``component``, which else numbers the
    components; null ids never name a component unless all its ids are null. Repeated rows
    are one class. ``row_id`` is a unique long column that two reads of ``df`` number alike;
    without one, ``df`` is written to the shared folder first. Buckets beyond ``split_from``
    rows are split; pivots are drawn again while a draw closes ``worth`` of the open rows.
    """
    spark = session_of(df)
    rows = df.select(*([F.col(row_id).alias("row_id")] if row_id else []), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    written = []
    if not row_id:
        rows = keep(rows.withColumn("row_id", F.monotonically_increasing_id()), "rows")
        written.append(rows)
    counters, probe = token_sketch(rows)
    sketch = spark.sparkContext.broadcast(counters)
    marked = keep(rows.select("row_id", "doc_id", "text").mapInArrow(_marker(sketch, probe, split_from), "row_id long, doc_id long, n long, digest binary, gid long, prefix array<long>, parts array<int>"), "marked")
    entries = keep(shared_tokens(marked), "entries")
    ids = keep(marked.select("row_id", "doc_id", "n", "digest", "gid"), "ids")
    discard(marked)
    sketch.destroy()
    classes = keep(ids.where("n > 0").groupBy("digest").agg(F.min("row_id").alias("cid"), F.min("gid").alias("gid"), F.min("doc_id").alias("class_doc"), F.count("*").alias("class_size")), "classes")
    prefixes = keep(entries.groupBy("gid").agg(F.collect_list("token").alias("tokens")), "prefixes")  # at most a document's prefix
    written += [ids, classes, prefixes]

    links: list[DataFrame] = []
    comp, before, step, last = None, None, 0, False
    while not last:
        labelled = classes.select("cid", "gid", F.col("cid").alias("comp")) if comp is None else classes.select("cid", "gid").join(grows(comp.withColumnRenamed("node", "cid")), "cid", "left").select("cid", "gid", F.coalesce("label", "cid").alias("comp"))
        state = keep(labelled, "state")
        lead = F.col("cid") if step == 0 else F.xxhash64(F.lit(step), "cid")
        ends = state.groupBy("gid").agg(F.min(F.struct(lead.alias("draw"), "cid", "comp")).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), (F.count("*") == 1).alias("single"))
        ends = keep(ends.select("gid", F.col("lead.cid").alias("lead"), F.col("lead.comp").alias("lead_comp"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("comp"), "single"), "ends")
        # First the row with the fewest rarer tokens of its own: of near copies, the one nearest to what they share.
        still = with_pivots(entries, ends, F.col("pos").cast("long") if step == 0 else F.xxhash64(F.lit(step), "gid"))
        discard(entries)
        open_rows = still.count()
        last = before is not None and open_rows >= (1 - worth) * before
        several = ends.where("comp IS NULL").select("gid", "lead", "lead_comp")
        if last:
            met = open_pairs(still, split_from)
            sides = [grows(state.select(F.col("gid").alias(g), F.col("cid").alias(c), F.col("comp").alias(f"{g}_comp"))) for g, c in (("x", "pivot"), ("y", "member"))]
            across = filtered(met, prefixes).join(sides[0], "x").join(sides[1], "y").where("x_comp <> y_comp").select("pivot", "member")
            own = state.join(grows(several.select("gid")), "gid", "left_semi")
            inner = own.select("gid", F.col("cid").alias("pivot"), F.col("comp").alias("x_comp")).join(grows(own.withColumnRenamed("cid", "member")), "gid").where("pivot < member AND x_comp <> comp").select("pivot", "member")
        else:
            met = keep(pivot_pairs(still), "met")
            across = filtered(met, prefixes).join(grows(ends.select(F.col("gid").alias("x"), F.col("lead").alias("pivot"))), "x").join(grows(ends.select(F.col("gid").alias("y"), F.col("lead").alias("member"))), "y").select("pivot", "member")
            inner = state.drop("comp").join(grows(several), "gid").join(grows(state.select("cid", "comp")), "cid").where("comp <> lead_comp").select(F.col("lead").alias("pivot"), F.col("cid").alias("member"))
        links.append(verified(across.unionByName(inner), rows, members))
        discard(met, state, ends, *([] if comp is None else [comp]))
        comp = connected_components(reduce(DataFrame.unionByName, links))
        entries = still.where("gid <> p_gid OR NOT alone").select("token", "gid", "n", "pos")
        step, before = step + 1, open_rows
    # Ids again: each class's smallest doc_id, then each component's.
    labels = classes.join(grows(comp.withColumnRenamed("node", "cid")), "cid", "left").select("digest", "class_doc", "class_size", F.coalesce("label", "cid").alias("component"))
    named = labels.join(grows(labels.groupBy("component").agg(F.min("class_doc").alias("component_id"))), "component")
    out = keep(
        ids.select("row_id", "doc_id", "n", "digest")
        .join(grows(named.select("digest", "component_id", "class_size", "component")), "digest", "left")
        .select("row_id", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), "component"),
        "components",
    )
    discard(entries, comp, *links, *written)
    return out


@query("op3_jaccard_join")
def op3_jaccard_join(spark, sf_dir):
    docs = numbered(table(spark, sf_dir, "documents"), "row_id")
    return jaccard_components(docs, row_id="row_id").select("doc_id", "n_shingles", "component_id", "class_size")
