"""Toxicity by a classifier chain.

Linear models predict the categories in a fixed order; each sees, besides the words of the
text, the probabilities that the models before it give. While fitting, those probabilities
come from folds that did not see the row, so later models learn how far to trust them. The
last category is the label `toxic` itself.

The models are fitted on about PER_CLASS labelled rows of either label at most, taken by a
seeded hash; whole texts are read, and all documents are scored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, session_of, table, worker_store
from .registry import query

#: The chain: each category's seed words mark it among rows labelled toxic; `coded` is toxic without any seed word.
SEEDS = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser", "fool", "dumb", "imbecile", "dimwit", "jerk", "coward", "liar", "bastard", "dunce", "halfwit"),
    "contempt": ("pathetic", "worthless", "trash", "scum", "disgusting", "garbage", "filth", "vermin", "useless", "hopeless", "ugly", "despicable", "vile", "revolting", "subhuman"),
    "threat": ("kill", "hurt", "beat", "destroy", "die", "burn", "punch", "strangle", "stab", "shoot", "crush", "suffer", "bleed", "regret", "hunt"),
}
CHAIN = (*SEEDS, "coded", "toxic")
PER_CLASS = 2000
FOLDS = 3
#: Parameters of the models: hash buckets of features, the most telling ones that a model keeps (a linear model of
#: at most KEEP + 1 + 4 weights), documents of the sample that a kept one is in at least, and the ridge.
BUCKETS = 1 << 20
KEEP = 400
SEEN_IN = 3
RIDGE = 0.05
REMEMBER = 250_000
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[int, ...]:
    """Buckets of the word and of its first 4, 5 and 6 letters."""
    parts = [f"w:{word}", *(f"{n}:{word[:n]}" for n in (4, 5, 6) if len(word) > n)]
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts)


class _Reader:
    """Distinct feature buckets of whole texts; words are remembered."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> set[int]:
        if len(self.known) > REMEMBER:
            self.known.clear()
        out: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            found = self.known.get(word)
            if found is None:
                found = self.known[word] = features_of(word)
            out.update(found)
        return out


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = _Reader()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        words = [set(_WORD.findall(t.lower())) for t in texts]
        seeds = [[k for k, own in SEEDS.items() if any(w in has for w in own)] for has in words]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(seeds, pa.list_(pa.string())), pa.array([sorted(reader.of(t)) for t in texts], pa.list_(pa.int32()))], names=["toxic", "seeds", "features"])


class Linear:
    """Ridge logistic regression on the features that tell the classes apart best, and extra columns."""

    def __init__(self, rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray):
        size = np.array([len(r) for r in rows])
        flat = np.concatenate(rows) if len(rows) else np.zeros(0, dtype=np.int64)
        positive = np.repeat(y, size)
        has, hits = np.bincount(flat, minlength=BUCKETS), np.bincount(flat, positive, minlength=BUCKETS)
        rate = y.mean()
        spread = np.abs(hits - has * rate) / np.sqrt(np.maximum(has * rate * (1 - rate), 1e-9) + 1)
        order = np.argsort(-np.where(has >= SEEN_IN, spread, -1.0), kind="stable")[:KEEP]
        self.kept = np.sort(order[has[order] >= SEEN_IN])
        x = np.column_stack([self.columns(rows), extra, np.ones(len(rows))])
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), RIDGE)
        ridge[-1] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-4:
                break
        self.weights, self.more, self.bias = w[: len(self.kept)], w[len(self.kept) : -1], w[-1]

    def columns(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(self.kept)))
        for k, row in enumerate(rows):
            own = np.intersect1d(self.kept, row, assume_unique=True)
            out[k, np.searchsorted(self.kept, own)] = 1
        return out

    def probability(self, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
        z = self.columns(rows) @ self.weights + extra @ self.more + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_chain(rows: list[np.ndarray], labels: dict[str, np.ndarray], seed: int = 3) -> dict:
    """The chain's models; earlier categories reach later models as out-of-fold probabilities."""
    fold = np.random.default_rng(seed).permutation(len(rows)) % FOLDS
    models, extra = [], np.zeros((len(rows), 0))
    for name in CHAIN:
        y = labels[name].astype(float)
        if y.min(initial=1) == y.max(initial=0):  # one class alone: its rate is all there is to learn
            models.append({"kept": np.zeros(0, np.int64), "weights": np.zeros(0), "more": np.zeros(extra.shape[1]), "bias": 30.0 if len(y) and y[0] else -30.0})
            own = y
        else:
            own = np.zeros(len(rows))
            for f in range(FOLDS):
                a, b = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                own[b] = Linear([rows[k] for k in a], extra[a], y[a]).probability([rows[k] for k in b], extra[b]) if 0 < y[a].sum() < len(a) else y[a].mean()
            whole = Linear(rows, extra, y)
            models.append({"kept": whole.kept, "weights": whole.weights, "more": whole.more, "bias": whole.bias})
        extra = np.column_stack([extra, own])
    return {"models": models, "id": uuid.uuid4().hex}


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The chain from labelled documents; None without any. Rows with a null label or text are not learned from."""
    session_of(docs)
    known = labels.select("doc_id", "toxic").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    draw = F.xxhash64(F.lit(21), "doc_id")
    some = [bounded_sample(known.where(F.col("toxic") == t), draw, PER_CLASS) for t in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # about 2 * PER_CLASS rows at most
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id")
    first = texts.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "text"), F.struct(F.xxhash64("text"), "text")).alias("row"))  # a doc_id counts once, on however many rows it stands
    sample = first.select("row.toxic", "row.text").mapInArrow(_collect, "toxic int, seeds array<string>, features array<int>").collect()
    if not sample:
        return None
    sample = sorted(((r.toxic, tuple(r.seeds), tuple(r.features)) for r in sample))
    toxic = np.array([s[0] for s in sample])
    marks = {k: toxic * np.array([k in s[1] for s in sample]) for k in SEEDS}
    marks["coded"] = toxic * np.array([not s[1] for s in sample])
    return train_chain([np.array(s[2], dtype=np.int64) for s in sample], marks | {"toxic": toxic})


class _Scorer:
    """Word -> rows of the kept features' weight table."""

    def __init__(self, model: dict):
        self.models = model["models"]
        every = sorted({int(f) for m in self.models for f in m["kept"]})
        self.place = {f: k for k, f in enumerate(every)}
        self.table = np.zeros((len(every), len(self.models)))
        for c, m in enumerate(self.models):
            self.table[[self.place[int(f)] for f in m["kept"]], c] = m["weights"]
        self.known: dict[str, tuple[int, ...]] = {}

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBER:
            self.known.clear()
        words = [set(_WORD.findall(t.lower())) for t in texts]
        for w in set().union(*words) - self.known.keys() if words else ():
            self.known[w] = tuple(self.place[f] for f in features_of(w) if f in self.place)
        get, z = self.known.__getitem__, np.zeros((len(texts), len(self.models)))
        for k, own in enumerate(words):
            hit = {f for found in map(get, own) if found for f in found}
            if hit:
                z[k] = self.table[list(hit)].sum(axis=0)
        p = np.zeros_like(z)
        for c, m in enumerate(self.models):
            p[:, c] = 1 / (1 + np.exp(-np.clip(z[:, c] + p[:, :c] @ m["more"] + m["bias"], -30, 30)))
        return p


def score_toxicity(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``df`` with a probability p_<category> for each link of the chain and `toxic`: p_toxic over 0.5.

    Null and empty texts score 0, as does every text when ``model`` is None. Columns of
    these names are replaced; all others and repeated rows pass as they are.
    """
    session_of(df)
    names = [f"p_{c}" for c in CHAIN]
    rows = df.drop(*names, "toxic")
    schema = T.StructType(list(rows.schema))
    for n in names:
        schema = schema.add(n, T.DoubleType())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("toxicity")
        if model and model["id"] not in store:
            store.clear()
            store[model["id"]] = _Scorer(model)
        for batch in batches:
            texts = pc.fill_null(batch.column(text), "").to_pylist()
            p = store[model["id"]].score(texts) if model else np.zeros((len(texts), len(names)))
            p[[k for k, t in enumerate(texts) if not t]] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, c], pa.float64()) for c in range(len(names)))], names=[*batch.schema.names, *names])

    return rows.mapInArrow(score, schema).withColumn("toxic", F.col("p_toxic") > 0.5)


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select("doc_id", "text"), model).drop("text")
