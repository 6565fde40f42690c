"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Every pre-token is a row of symbols; the leaves of its tree hold the merge ranks of
adjacent pairs, joined with their places, so the root is the leftmost pair of the lowest
rank. Applying it changes three leaves, and their paths are renewed in logarithmic time,
until no pair can be merged. Trees of one size are worked side by side in numpy, and each
worker remembers the words it has met.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import session_of, table, worker_store
from .registry import query

#: Words that a worker remembers, and symbols of the trees worked at once.
REMEMBER = 200_000
TREE_CELLS = 1 << 18
#: Up to here (Latin, Greek, Cyrillic) all Unicode versions agree on what a letter is.
LAST_STABLE = "\u052f"
_NONE = np.iinfo(np.int64).max


class Merges:
    """The merge table: (left id, right id) -> rank and merged id."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        # Tables of hashed keys: what finds its place taken goes to the next one.
        self.bits, self.tables, rest = max(4, 2 + len(keys).bit_length()), [], np.arange(len(keys))
        while len(rest):
            key, rank = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, _NONE, dtype=np.int64)
            place = self._place(keys[rest], len(self.tables))
            _, first = np.unique(place, return_index=True)
            key[place[first]], rank[place[first]] = keys[rest[first]], rest[first]
            self.tables.append((key, rank))
            rest = np.delete(rest, first)

    def _place(self, key: np.ndarray, nth: int) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64((0x9E3779B97F4A7C15 + 2 * nth * 0x632BE59BD9B4E019) % (1 << 64))) >> np.uint64(64 - self.bits)).view(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pairs' ranks; _NONE where a pair can't be merged."""
        key = (left << 32) | right  # negative where a symbol is missing
        out = np.full(key.shape, _NONE, dtype=np.int64)
        for nth, (keys, ranks) in enumerate(self.tables):
            place = self._place(key, nth)
            hit = keys[place] == key
            out[hit] = ranks[place[hit]]
        out[key < 0] = _NONE
        return out

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge rows of symbols, each padded with -1 to one power of two; the merged away become -1."""
        rows, leaves = symbols.shape
        sym = np.full((rows, leaves + 1), -1, dtype=np.int64)
        sym[:, :leaves] = symbols
        after = np.tile(np.minimum(np.arange(1, leaves + 2), leaves), (rows, 1))
        before = np.tile(np.arange(-1, leaves), (rows, 1))
        before[:, 0] = leaves
        place = np.arange(leaves)

        def node(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == _NONE, _NONE, rank * leaves + at)

        tree = np.full((rows, 2 * leaves), _NONE, dtype=np.int64)
        tree[:, leaves:] = node(self.ranks(sym[:, :leaves], sym[:, 1:]), place)
        width = leaves
        while width > 1:
            width //= 2
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
        live = np.flatnonzero(tree[:, 1] != _NONE)
        while len(live):
            root = tree[live, 1]
            left = root % leaves
            right = after[live, left]
            beyond = after[live, right]
            sym[live, left] = self.merged[root // leaves]
            sym[live, right] = -1
            after[live, left] = beyond
            before[live, beyond] = left
            ahead = before[live, left]
            tree[live, leaves + right] = _NONE
            tree[live, leaves + left] = node(self.ranks(sym[live, left], sym[live, beyond]), left)
            has = ahead < leaves
            tree[live[has], leaves + ahead[has]] = node(self.ranks(sym[live[has], ahead[has]], sym[live[has], left[has]]), ahead[has])
            for at in (left, right, np.where(has, ahead, left)):
                up = (at + leaves) // 2
                while up[0]:  # all trees here are of one height
                    tree[live, up] = np.minimum(tree[live, 2 * up], tree[live, 2 * up + 1])
                    up //= 2
            live = live[tree[live, 1] != _NONE]
        return sym[:, :leaves]


class WordBPE:
    """A vocabulary with word ends: NFC, white space collapsed, lower case, then merges."""

    #: The pre-tokenizer's pattern, the white space of its `\\s`, and the printable bytes that stand for themselves (fixed values).
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    SPACES = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
    PRINTABLE = ((33, 126), (161, 172), (174, 255))

    def __init__(self, path: str, remember: int = REMEMBER):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # parts words of scripts whose letters Unicode still adds to
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max(chain(vocab.values(), self.added.values())) + 1)
        for token, i in chain(vocab.items(), self.added.items()):
            self.tokens[i] = token
        self.merges = Merges(vocab, spec["model"]["merges"])
        shown = [b for low, high in self.PRINTABLE for b in range(low, high + 1)]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in shown)}
        self.byte_of = {c: b for b, c in letters.items()}
        self.inner = np.array([vocab[letters[b]] for b in range(256)])
        self.last = np.array([vocab[letters[b] + end] for b in range(256)])
        self.findall = regex.compile(self.PIECES.replace(r"\s", self.SPACES)).findall
        self.spaces = re.compile(f"[{self.SPACES}]+").split
        self.odd = re.compile("[\x1c-\x1f]").search  # white space to str.split alone
        self.specials = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.remember = remember
        self.known: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}

    @staticmethod
    def _normal(word: str) -> str:
        word = unicodedata.normalize("NFC", word)
        return "".join(c.lower() for c in word) if "Σ" in word else word.lower()  # a final sigma stays as others

    def _pieces(self, word: str) -> list[str]:
        if word.isascii():
            word = word.lower()
            core = word.rstrip(".,;:!?")
            if core.isalpha():  # a word, and marks after it
                return [core, word[len(core) :]] if len(core) < len(word) else [word]
            return self.findall(word)
        if max(word) <= LAST_STABLE:
            return self.findall(self._normal(word))
        parted = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return [bytes(self.byte_of[c] for c in piece).decode() for piece, _ in parted]

    def _words(self, text: str) -> list[str]:
        return [w for w in self.spaces(text) if w] if self.odd(text) else text.split()

    def _merge(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each piece's ids, the pieces taken by the size of their trees."""
        coded = [piece.encode() for piece in pieces]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        height = np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
        for h in np.unique(height).tolist():
            leaves, own = 1 << h, np.flatnonzero(height == h)
            step = max(1, TREE_CELLS // leaves)
            for at in range(0, len(own), step):
                some = own[at : at + step]
                size, places = sizes[some], some.tolist()
                raw = np.frombuffer(b"".join([coded[k] for k in places]), dtype=np.uint8)
                symbols = np.full((len(some), leaves), -1, dtype=np.int64)
                symbols[np.arange(leaves) < size[:, None]] = self.inner[raw]
                symbols[np.arange(len(some)), size - 1] = self.last[raw[np.cumsum(size) - 1]]
                merged = self.merges.merge(symbols)
                left = merged >= 0
                flat = merged[left].astype("<u4").tobytes()
                ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
                yield from ((pieces[k], flat[b:e]) for k, b, e in zip(places, [0, *ends[:-1]], ends, strict=True))

    def _learn(self, new: list[str]) -> None:
        """Merge the pieces of new words; a plain word that is known needs no second merge as a piece."""
        known = self.known
        parted = [self._pieces(w) for w in new]
        pieces = dict.fromkeys(chain.from_iterable(parted))
        merged = {p: known[p] for p in pieces if p in known and p.isascii() and p.isalpha()}
        merged.update(self._merge([p for p in pieces if p not in merged]))
        get = merged.__getitem__
        known.update((w, get(own[0]) if len(own) == 1 else b"".join(map(get, own))) for w, own in zip(new, parted, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian u32."""
        if len(self.known) > self.remember:  # two generations: what was met since the last change stays
            self.known, self.older = {}, self.known
        parts: list[list] = []
        words: set[str] = set()
        for text in texts:
            if self.specials and self.specials.search(text):  # found in the text as it is
                own: list = []
                for piece in self.specials.split(text):
                    own += [self.added[piece]] if piece in self.added else self._words(piece)
                words.update(w for w in own if isinstance(w, str))
            else:
                own = self._words(text)
                words.update(own)
            parts.append(own)
        known, older = self.known, self.older
        new = words.difference(known)
        known.update((w, older[w]) for w in new.intersection(older))
        self._learn(list(new.difference(known)))
        for i in self.added.values():
            known[i] = np.array([i], dtype="<u4").tobytes()
        get = known.__getitem__
        return [b"".join(map(get, own)) for own in parts]

    def decode(self, ids: list[int]) -> str:
        """The tokens in order, one space between them: this vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _vocabulary(path: str) -> WordBPE:
    store = worker_store("bpe")
    if path not in store:
        store[path] = WordBPE(path)
    return store[path]


def bpe_encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", drop_text: bool = False, decoded: str | None = None) -> DataFrame:
    """``df`` with ``out``: the ids (array<int>) of each whole text; and ``decoded``, if named: the text they decode to.

    A null or blank text has no ids. Columns that are named like ``out`` or ``decoded`` are
    replaced; all others, and repeated rows, pass as they are.
    """
    session_of(df)
    rows = df.drop(*(n for n in (out, decoded) if n and n != text))
    schema = T.StructType([f for f in rows.schema if not (drop_text and f.name == text)]).add(out, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path)
        for batch in batches:
            coded = bpe.encode(pc.fill_null(batch.column(text), "").to_pylist())
            offsets = np.zeros(len(coded) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32)))]
            if decoded:
                made.append(pa.array([bpe.decode(np.frombuffer(c, dtype="<u4").tolist()) for c in coded], pa.string()))
            names = [n for n in batch.schema.names if not (drop_text and n == text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, out, *([decoded] if decoded else [])])

    return rows.mapInArrow(encode, schema)


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text that the ids decode to, special tokens kept.

    Null ids give null, no ids an empty text; a column named like ``out`` is replaced.
    """
    session_of(df)
    rows = df.drop(out)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path)
        for batch in batches:
            texts = [None if i is None else bpe.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(decode, T.StructType(list(rows.schema)).add(out, T.StringType()))


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop_text=True, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
