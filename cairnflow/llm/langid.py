"""Language ID by a linear-chain conditional random field over words.

Each word's state is a language. Its scores come from affixes, character n-grams and a
lexicon, all hashed into one weight table; learned transitions tie neighbours, so words of
code-switched text are labelled by forward-backward. A document's language is the one of
the largest mean marginal.

The field is fitted on a bounded sample: spans of SPAN_WORDS words from SPANS places of about
DOCS_PER_LANG documents of each language at most. Spans of different languages are laid end
to end, so the transitions see switches. All documents are labelled whole.
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

from .common import grows, session_of, table, worker_store
from .registry import query

DOCS_PER_LANG = 400
SPANS = 6
SPAN_WORDS = 16
SEQUENCES, SEQUENCE_WORDS, EPOCHS, BATCH = 1600, 48, 6, 80
#: Hash buckets of n-gram and word features; the lexicon's come after them.
BUCKETS = 1 << 16
#: Languages up to which the sample's edges are broadcast, and words that a worker remembers.
FEW_LANGS = 10_000
REMEMBER = 250_000
#: Texts whose words are labelled side by side.
AT_ONCE = 200
UNKNOWN = "und"
_WORD = r"[^\W\d_]+"
_RUNS = T.ArrayType(T.StructType().add("lang", T.StringType()).add("words", T.IntegerType()))


def split_words(text: str) -> list[str]:
    """The lower-cased runs of letters of a text."""
    return [w for w in re.findall(_WORD, text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def word_features(words: list[str], lexicon: dict[str, int], langs: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids of all words one after another, each word's first place).

    A word between marks gives its n-grams of 1 to 3 letters and, at the marks, its prefixes
    and suffixes of 1 to 4; then the word itself, and the language that the lexicon gives it.
    """
    marked = [f"\x02{w}\x03" for w in words]
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    word_of = np.repeat(np.arange(len(words)), sizes)
    room = ends[word_of] - np.arange(len(letters))
    found, owner = [], []
    code = np.zeros(len(letters), dtype=np.uint64)
    for n in range(1, 6):
        shifted = np.zeros_like(letters)
        shifted[: len(letters) - n + 1] = letters[n - 1 :]
        code = code * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(n)
        ok = room >= n
        if n > 3:
            ok &= (letters == 2) | (room == n)
        at = np.flatnonzero(ok)
        found.append(((code[at] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owner.append(word_of[at])
    found.append(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words), np.int64, len(words)))
    found.append(np.fromiter((BUCKETS + lexicon.get(w, langs) for w in words), np.int64, len(words)))
    owner += [np.arange(len(words))] * 2
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owners[order], np.arange(len(words)))


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Marginals of sequences laid end to end: ``scores`` (words, states), ``lengths`` the words of each.

    All sequences advance together, the longest first, so that those still going stand in front.
    """
    n, k = scores.shape
    order = np.argsort(-lengths, kind="stable")
    first, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, init = np.exp(moves - moves.max()), np.exp(start - start.max())
    ahead = np.empty((n, k))
    now = None
    for t, m in enumerate(active.tolist()):
        at = first[:m] + t
        now = local[at] * (init if now is None else now[:m] @ step)
        now /= now.sum(axis=1, keepdims=True)
        ahead[at] = now
    back = np.ones((len(size), k))
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        gamma = ahead[at] * back[:m]
        ahead[at] = gamma / gamma.sum(axis=1, keepdims=True)
        before = (local[at] * back[:m]) @ step.T
        back[:m] = before / before.sum(axis=1, keepdims=True)
    return ahead


def train(spans: list[tuple[int, list[str]]], langs: int, seed: int = 5) -> dict:
    """Weights, start and transition scores and lexicon from spans of (language number, words)."""
    rng = np.random.default_rng(seed)
    halves: tuple[list, list] = ([], [])
    for k, span in enumerate(spans):
        halves[k % 2].append(span)
    seen: dict[str, np.ndarray] = {}
    for lang, words in halves[0]:
        for w in words:
            seen.setdefault(w, np.zeros(langs))[lang] += 1
    lexicon = {w: int(c.argmax()) for w, c in seen.items() if c.max() >= 0.8 * c.sum()}
    fit_on = halves[1] or halves[0]
    by_lang = [[s for s in fit_on if s[0] == k] for k in range(langs)]
    present = [k for k in range(langs) if by_lang[k]]
    ids: dict[str, int] = {}
    tokens = np.zeros((SEQUENCES, SEQUENCE_WORDS), dtype=np.int64)
    labels = np.zeros_like(tokens)
    for s in range(SEQUENCES):
        row: list[int] = []
        tags: list[int] = []
        while len(row) < SEQUENCE_WORDS:
            own = by_lang[present[rng.integers(len(present))]]
            lang, words = own[rng.integers(len(own))]
            row += [ids.setdefault(w, len(ids)) for w in words]
            tags += [lang] * len(words)
        tokens[s], labels[s] = row[:SEQUENCE_WORDS], tags[:SEQUENCE_WORDS]
    features, begin = word_features(list(ids), lexicon, langs)
    count = np.diff(np.append(begin, len(features)))
    weights, moves, start = np.zeros((BUCKETS + langs + 1, langs)), np.zeros((langs, langs)), np.zeros(langs)
    sums = [np.full_like(x, 1e-6) for x in (weights, moves, start)]
    one = np.eye(langs)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(SEQUENCES), SEQUENCES // BATCH):
            words, place = np.unique(tokens[at].ravel(), return_inverse=True)
            own = np.repeat(begin[words], count[words]) + np.arange(count[words].sum()) - np.repeat(np.cumsum(count[words]) - count[words], count[words])
            cells = features[own]
            score = np.add.reduceat(weights[cells], np.cumsum(count[words]) - count[words])[place].reshape(len(at), SEQUENCE_WORDS, langs)
            local, step = np.exp(score - score.max(axis=2, keepdims=True)), np.exp(moves)
            alpha, beta = np.empty_like(local), np.ones_like(local)
            for t in range(SEQUENCE_WORDS):
                alpha[:, t] = local[:, t] * (np.exp(start) if t == 0 else alpha[:, t - 1] @ step)
                alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
            for t in range(SEQUENCE_WORDS - 2, -1, -1):
                beta[:, t] = (local[:, t + 1] * beta[:, t + 1]) @ step.T
                beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
            gamma = alpha * beta
            gamma /= gamma.sum(axis=2, keepdims=True)
            truth = one[labels[at]]
            pair = alpha[:, :-1, :, None] * step * (local * beta)[:, 1:, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            by_word = np.zeros((len(words), langs))
            np.add.at(by_word, place, (truth - gamma).reshape(-1, langs))
            grad = np.stack([np.bincount(cells, np.repeat(by_word[:, k], count[words]), len(weights)) for k in range(langs)], axis=1)
            seen_pairs = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
            for value, total, g in ((weights, sums[0], grad), (moves, sums[1], seen_pairs - pair.sum(axis=(0, 1))), (start, sums[2], (truth[:, 0] - gamma[:, 0]).sum(axis=0))):
                g = g / len(at) - 1e-4 * value
                total += g * g
                value += 0.15 * g / np.sqrt(total)
    return {"weights": weights.astype(np.float32), "moves": moves, "start": start, "lexicon": lexicon}


def _spans(seed: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, spans = [], []
            for lang, draw, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "draw", "text")), strict=True):
                words = split_words(text)
                rng = np.random.default_rng([seed, draw & 0xFFFFFFFF])
                for at in rng.integers(0, max(1, len(words) - SPAN_WORDS + 1), SPANS):
                    if own := words[at : at + SPAN_WORDS]:
                        langs.append(lang)
                        spans.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(spans, pa.list_(pa.string()))], names=["lang", "words"])

    return cut


def fit_language_model(df: DataFrame, text: str = "text", lang: str = "lang", seed: int = 5) -> dict | None:
    """The field's weights from labelled rows, about DOCS_PER_LANG of a language by a hash of their texts; None where no row has both a language and a letter."""
    session_of(df)
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(text)).alias("draw"))
    counts = rows.groupBy("lang").count().collect()  # a row for each language
    edges = [(r.lang, -(1 << 63) + min((1 << 64) - 1, (1 << 64) * DOCS_PER_LANG // r["count"])) for r in counts]
    by_lang = df.sparkSession.createDataFrame(edges, "lang string, edge long")
    # The scan itself picks the sample: no other text is moved.
    chosen = rows.join(F.broadcast(by_lang) if len(edges) <= FEW_LANGS else grows(by_lang), "lang").where(F.col("draw") <= F.col("edge"))
    first = chosen.groupBy("lang", "draw").agg(F.min("text").alias("text"))  # equal texts once
    sample = sorted((r.lang, list(r.words)) for r in first.mapInArrow(_spans(seed), "lang string, words array<string>").collect())
    names = sorted({s[0] for s in sample})
    if not names:
        return None
    number = {name: k for k, name in enumerate(names)}
    return train([(number[s], w) for s, w in sample], len(names), seed) | {"langs": names, "id": uuid.uuid4().hex}


class _Scores:
    """The words a worker has met and their scores; place 0 is for runs without a letter."""

    def __init__(self, model: dict):
        self.model, self.langs = model, len(model["langs"])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1, self.langs))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places of all words that hold a letter, how many each text has)."""
        if len(self.place) > REMEMBER:
            self.clear()
        find = re.compile(_WORD).findall
        parts = [find(t.lower()) for t in texts]
        met: set[str] = set()
        met.update(*parts)
        new = [w for w in met if w not in self.place]
        if new:
            at = len(self.table)
            words = [w for w in new if w.isalpha() or any(map(str.isalpha, w))]
            self.place.update(dict.fromkeys(new, 0))
            self.place.update(zip(words, range(at, at + len(words)), strict=True))
            rows = [self.table]
            for begin in range(0, len(words), 20_000):
                features, first = word_features(words[begin : begin + 20_000], self.model["lexicon"], self.langs)
                rows.append(np.add.reduceat(self.model["weights"][features], first).astype(np.float64))
            self.table = np.concatenate(rows)
        get = self.place.__getitem__
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        places = np.fromiter((get(w) for p in parts for w in p), np.int64, int(counts.sum()))
        if (places == 0).any():
            owner = np.repeat(np.arange(len(parts)), counts)[places > 0]
            counts, places = np.bincount(owner, minlength=len(parts)), places[places > 0]
        return places, counts


def label_languages(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (0 to 1) and runs (array of (lang, words) in order).

    A text that is null or has no letters gets `und`, score 0 and no runs, and so does every
    text when ``model`` is None. Columns of these names are replaced; all others and repeated
    rows pass as they are.
    """
    session_of(df)
    rows = df.drop("lang_pred", "score", "runs")
    schema = T.StructType(list(rows.schema)).add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("runs", _RUNS)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("langid")
        if model and model["id"] not in store:
            store.clear()
            store[model["id"]] = _Scores(model)
        for batch in (b.slice(k, AT_ONCE) for b in batches for k in range(0, b.num_rows, AT_ONCE)):
            n = batch.num_rows
            pred, score, runs = [UNKNOWN] * n, np.zeros(n), pa.array([[]] * n, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())])))
            if model and n:
                scores = store[model["id"]]
                places, counts = scores.of(pc.fill_null(batch.column(text), "").to_pylist())
                marginals = forward_backward(scores.table[places], counts, model["start"], model["moves"]) if len(places) else np.zeros((0, scores.langs))
                owner = np.repeat(np.arange(n), counts)
                mean = np.stack([np.bincount(owner, marginals[:, k], n) for k in range(scores.langs)], axis=1) / np.maximum(counts, 1)[:, None]
                has, best = counts > 0, mean.argmax(axis=1)
                pred = [model["langs"][b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
                score = np.where(has, np.clip(mean.max(axis=1), 0, 1), 0.0)
                state = marginals.argmax(axis=1)
                cut = np.flatnonzero(np.append(True, (state[1:] != state[:-1]) | (owner[1:] != owner[:-1]))[: len(state)])
                size = np.diff(np.append(cut, len(state)))
                offsets = np.searchsorted(owner[cut], np.arange(n + 1))
                names = pa.DictionaryArray.from_arrays(pa.array(state[cut].astype(np.int32)), pa.array(model["langs"])).dictionary_decode()
                runs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([names, pa.array(size.astype(np.int32))], names=["lang", "words"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), runs], names=[*batch.schema.names, "lang_pred", "score", "runs"])

    return rows.mapInArrow(label, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows whose crc32(doc_id as text) mod 4 is 2 are not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows with a doc_id that are not held out."""
    return docs.where(F.col(doc_id).isNotNull() & ~held_out(doc_id))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred, score and runs; learned from the rows not held out."""
    model = fit_language_model(learnable(docs))
    return label_languages(docs.withColumn("held_out", held_out()), model)


@query("op10_langid")
def op10_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(learnable(docs))
    return label_languages(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
