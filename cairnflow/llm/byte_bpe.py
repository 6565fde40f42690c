"""Byte-level BPE as a finite-state transducer that is made deterministic while it reads.

A row of tokens is what the merges make of its bytes exactly if it is so for every two
neighbours (the merges inside a pair never see past it). So the merges compile into a
transducer whose states are (token before, place in the trie of tokens): it reads a byte down
the trie, and where a token ends that is compatible with the one before, it may write it and
start anew. Reading all ways at once makes it deterministic: a state is the set of ways still
open with what each has yet to write; what all have in common is written. A way stays open
for at most the longest token, which bounds the lookahead. States and steps are made when
a text first needs them, and are forgotten together when they fill their room.

Decoding is a transducer over ids: its states are the bytes of a character not yet complete.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import session_of, table, worker_store
from .registry import query

#: Bytes of the pieces a worker remembers (two generations of these) and of one such piece; states and pair checks kept at once.
REMEMBER, LONGEST = 48 << 20, 64
STATES, CHECKS = 200_000, 1_000_000
#: What a remembered piece takes besides its bytes, about.
OBJECTS = 160
_FINAL, _WAYS = -1, -2
_NOTHING = -1  # the token before the first
_NEVER = 1 << 60  # the rank of what is no token


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: base64 and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f.read().splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The merges themselves on a short piece: the leftmost pair of the lowest rank, until there is none."""
    parts, get = [piece[k : k + 1] for k in range(len(piece))], ranks.get
    pairs = [get(piece[k : k + 2], _NEVER) for k in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) < _NEVER:
        at = pairs.index(lowest)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1], _NEVER)
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at], _NEVER)
    return [ranks[p] for p in parts]


class Transducer:
    """Pieces of bytes to ids (little-endian u32)."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.most = ranks, states
        self.token = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}  # (node, byte) -> node
        self.ends: list[int] = [-1]  # the token that ends at a node
        self.leaf: list[bool] = [True]
        for token, i in ranks.items():
            node = 0
            for c in token:
                at = node << 8 | c
                if at not in self.child:
                    self.child[at] = len(self.ends)
                    self.ends.append(-1)
                    self.leaf.append(True)
                    self.leaf[node] = False
                node = self.child[at]
            self.ends[node] = i
        self.checked: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.start = self._state([(_NOTHING, 0, ())])

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens, or the right one alone after nothing, as they are."""
        key = (left + 1) << 32 | right
        if (known := self.checked.get(key)) is None:
            if len(self.checked) >= CHECKS:
                self.checked.clear()
            a, b = self.token.get(left, b""), self.token[right]
            known = not (a and a + b in self.ranks) and merge(a + b, self.ranks) == ([left, right] if a else [right])
            self.checked[key] = known
        return known

    def _state(self, ways: list[tuple[int, int, tuple]]) -> dict:
        """The state of these ways, each (token before, node, ids yet to write)."""
        key = tuple(sorted(ways))
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = {_WAYS: key}
            for _, node, rest in key:
                if node == 0:
                    state[_FINAL] = array("I", rest).tobytes()
        return state

    def step(self, state: dict, c: int) -> tuple[dict, bytes]:
        """The state after a byte, and the ids that are certain then."""
        ways = []
        for before, node, rest in state[_WAYS]:
            down = self.child.get(node << 8 | c)
            if down is None:
                continue
            token = self.ends[down]
            if token >= 0 and self.compatible(before, token):
                ways.append((token, 0, (*rest, token)))
            if not self.leaf[down]:
                ways.append((before, down, rest))
        rests = [rest for _, _, rest in ways]
        first, last, same = min(rests), max(rests), 0  # what these two begin with, all do
        while same < len(first) and first[same] == last[same]:
            same += 1
        if len(self.states) >= self.most:
            self.clear()
        made = self._state([(before, node, rest[same:]) for before, node, rest in ways] if same else ways), array("I", first[:same]).tobytes()
        state[c] = made
        return made

    def encode(self, piece: bytes) -> bytes:
        """The ids of one piece; a piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return array("I", (whole,)).tobytes()
        state, out = self.start, []
        for c in piece:
            hit = state.get(c)
            state, sure = hit if hit is not None else self.step(state, c)
            if sure:
                out.append(sure)
        out.append(state.get(_FINAL, b""))
        return b"".join(out)


class Utf8:
    """Ids to text, one id after another; a state is the bytes of a character not yet complete."""

    #: Lead bytes that narrow what may follow them first (fixed by UTF-8): lowest and highest.
    FIRST = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}

    def __init__(self, token: dict[int, bytes], most: int = STATES):
        self.token, self.most, self.steps = token, most, 0
        self.states: dict[bytes, dict] = {b"": {}}

    def _follows(self, held: bytes, c: int) -> bool:
        low, high = self.FIRST.get(held[0], (0x80, 0xBF)) if len(held) == 1 else (0x80, 0xBF)
        return low <= c <= high

    def feed(self, held: bytes, more: bytes) -> tuple[str, bytes]:
        """The characters complete after ``more``, and what is held then; what can't be completed is U+FFFD."""
        out = []
        for c in more:
            if held and not self._follows(held, c):
                out.append("�")
                held = b""
            held += bytes((c,))
            lead = held[0]
            size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
            if size == len(held) or not size:
                out.append(held.decode() if size else "�")
                held = b""
        return "".join(out), held

    def decode(self, ids: list[int]) -> str:
        """The whole text of ``ids``."""
        out, held, state = [], b"", self.states[b""]
        for i in ids:
            hit = state.get(i)
            if hit is None:
                if self.steps >= self.most:
                    self.states, self.steps = {b"": {}}, 0
                    state = self.states.setdefault(held, {})
                text, then = self.feed(held, self.token[i])
                hit = state[i] = text, then, self.states.setdefault(then, {})
                self.steps += 1
            text, held, state = hit
            out.append(text)
        return "".join(out) + ("�" if held else "")


def _classes(pattern: str) -> str:
    """The pattern with its character classes written out as the library's regular expressions know them."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes((b,)): b for b in range(256)}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        found = bytes(tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
        at = np.array([ord(c) for c in found])
        breaks = np.flatnonzero(np.diff(at) > 1)
        spans = "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in zip(at[[0, *(breaks + 1)]].tolist(), at[[*breaks, -1]].tolist(), strict=True))
        pattern = re.sub(r"\[(\^?)([^\]]*)\]", lambda m: f"[{m[1]}{m[2].replace(name, spans)}]", pattern)  # noqa: B023
        pattern = pattern.replace(r"\S" if name == r"\s" else "\0", f"[^{spans}]")
        pattern = re.sub(rf"(?<!\\){re.escape(name)}(?![^\[]*\])", lambda _: f"[{spans}]", pattern)  # noqa: B023
    return pattern


class ByteBPE:
    """Whole texts to ids and back; remembers pieces by bytes, not by number."""

    def __init__(self, path: str, pattern: str, remember: int = REMEMBER):
        ranks = read_ranks(path)
        self.fst = Transducer(ranks)
        self.utf8 = Utf8(self.fst.token)
        self.pieces = re.compile(pattern).findall
        self.remember, self.held = remember, 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian u32."""
        pieces = self.pieces(text)
        get, encode = self.known.get, self.fst.encode
        out = list(map(get, pieces))
        for k in [k for k, ids in enumerate(out) if ids is None] if None in out else ():
            piece = pieces[k]
            ids = get(piece) or self.older.get(piece) or encode(piece.encode())
            out[k] = ids
            if len(piece) <= LONGEST and piece not in self.known:
                self.held += OBJECTS + 2 * len(piece) + len(ids)
                self.known[piece] = ids
        if self.held >= self.remember:
            self.known, self.older, self.held = {}, self.known, 0
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.utf8.decode(ids)


def _vocabulary(path: str, pattern: str) -> ByteBPE:
    store = worker_store("byte_bpe")
    if (path, pattern) not in store:
        store[path, pattern] = ByteBPE(path, pattern)
    return store[path, pattern]


def byte_bpe_encode(df: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", out: str = "ids", drop_text: bool = False, decoded: str | None = None) -> DataFrame:
    """``df`` with ``out``: the ids (array<int>) of each whole text, every match of ``pattern`` by itself; and ``decoded``, if named: the text they decode to.

    A null or empty text has no ids. Columns that are named like ``out`` or ``decoded`` are
    replaced; all others, and repeated rows, pass as they are. Special tokens' names are ordinary text.
    """
    session_of(df)
    rows = df.drop(*(n for n in (out, decoded) if n and n != text))
    schema = T.StructType([f for f in rows.schema if not (drop_text and f.name == text)]).add(out, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, T.StringType())
    written = _classes(pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path, written)
        for batch in batches:
            coded = [bpe.encode(t) for t in pc.fill_null(batch.column(text), "").to_pylist()]
            offsets = np.zeros(len(coded) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32)))]
            if decoded:
                made.append(pa.array([bpe.decode(np.frombuffer(c, dtype="<u4").tolist()) for c in coded], pa.string()))
            names = [n for n in batch.schema.names if not (drop_text and n == text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, out, *([decoded] if decoded else [])])

    return rows.mapInArrow(encode, schema)


def byte_bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text that the ids decode to, read id by id; bytes that are no UTF-8 become U+FFFD.

    Null ids give null, no ids an empty text; a column named like ``out`` is replaced.
    """
    session_of(df)
    rows = df.drop(out)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("byte_bpe_decode")
        if path not in store:
            store[path] = Utf8({i: t for t, i in read_ranks(path).items()})
        for batch in batches:
            texts = [None if i is None else store[path].decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(decode, T.StructType(list(rows.schema)).add(out, T.StringType()))


@query("op11_byte_bpe")
def op11_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop_text=True, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
