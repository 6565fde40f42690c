"""Token ids as Simple-8b words.

A 64-bit word holds a selector in its high 4 bits and, in the other 60, as many ids as
the selector's width allows. Ids of over 60 bits are escaped: the word then holds a
place in the segment's list of wide ids. A segment is coded in blocks of BLOCK_IDS ids,
each starting on a word of its own, and lists the blocks' first words, so that any block
is decoded alone and all words of one selector are decoded at once.

Segment, little-endian: magic ``CF8B``; u32 documents, ids (u64), blocks, words (u64),
wide ids; then the documents' ids (i64), a byte each that marks a null id, the documents'
id counts (u32), the blocks' first words (u32), the words (u64), the wide ids (u64).
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK_IDS = 4096
#: Selector -> (ids a word, bits an id); selector 0 escapes.
LAYOUTS = ((1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1))
_HEAD = "<4sIQIQI"
_MAGIC = b"CF8B"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, wide ids) of an array of unsigned ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    rows = -(-n // BLOCK_IDS)
    width = np.zeros(rows * BLOCK_IDS, dtype=np.uint8)
    width[:n] = np.frexp(ids.astype(np.float64))[1]  # rounding up at most sends an id of 60 bits to the escapes
    ahead = np.zeros((rows, BLOCK_IDS + 60), dtype=np.uint8)
    ahead[:, :BLOCK_IDS] = width.reshape(rows, BLOCK_IDS)
    most = ahead[:, :BLOCK_IDS].copy()  # the widest of the next ids
    chosen_at = np.zeros((rows, BLOCK_IDS), dtype=np.uint8)
    seen = 1
    for count, bits in LAYOUTS:
        for k in range(seen, count):
            np.maximum(most, ahead[:, k : k + BLOCK_IDS], out=most)
        seen = count
        fits = most <= bits
        if not fits.any():
            break
        chosen_at += fits  # what fits a layout fits those before it
    selector = chosen_at.reshape(-1)[:n]
    at = np.arange(n)
    left = np.minimum(n, (at // BLOCK_IDS + 1) * BLOCK_IDS) - at  # ids to the end of the block
    taken = np.minimum(np.array([1, *(c for c, _ in LAYOUTS)])[selector], left)
    begins = np.zeros(n, dtype=bool)
    now = np.arange(0, n, BLOCK_IDS)
    ends = np.minimum(n, now + BLOCK_IDS)
    while len(now):  # all blocks side by side, a word each
        begins[now] = True
        now = now + taken[now]
        going = now < ends
        if not going.all():
            now, ends = now[going], ends[going]
    starts = np.flatnonzero(begins)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.append(ids, np.zeros(60, dtype=np.uint64))
    for s, (count, bits) in enumerate(LAYOUTS, 1):
        if len(own := np.flatnonzero(chosen == s)):
            first, held = starts[own], taken[starts[own]]
            for k in range(count):
                value = padded[first + k] << np.uint64(k * bits)
                words[own] |= value if k == 0 else np.where(k < held, value, np.uint64(0))
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, np.searchsorted(starts, np.arange(0, n, BLOCK_IDS)), ids[starts[escaped]]


def unpack(words: np.ndarray, blocks: np.ndarray, n: int, wide: np.ndarray) -> np.ndarray:
    """The ``n`` ids that ``pack`` coded."""
    out = np.zeros(n + 60, dtype=np.uint64)
    if not n:
        return out[:0]
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1, *(c for c, _ in LAYOUTS)])[chosen]
    block = np.searchsorted(blocks, np.arange(len(words)), side="right") - 1
    before = np.cumsum(counts) - counts
    start = before - before[blocks][block] + block * BLOCK_IDS
    end = np.minimum(n, (block + 1) * BLOCK_IDS)
    for s, (count, bits) in enumerate(LAYOUTS, 1):
        if len(own := np.flatnonzero(chosen == s)):
            word, first, last = words[own], start[own], end[own]
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                ok = first + k < last
                out[(first + k)[ok]] = ((word >> np.uint64(k * bits)) & mask)[ok]
    escaped = np.flatnonzero(chosen == 0)
    out[start[escaped]] = wide[words[escaped].astype(np.int64)]
    return out[:n]


def write_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One segment of whole documents; ``ids`` holds their ids one after another."""
    words, blocks, wide = pack(ids)
    return b"".join(
        (
            struct.pack(_HEAD, _MAGIC, len(doc_ids), len(ids), len(blocks), len(words), len(wide)),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
            np.array(counts, dtype="<u4").tobytes(),
            blocks.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            wide.astype("<u8").tobytes(),
        )
    )


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their id counts, all ids) of a segment."""
    magic, n_docs, n_ids, n_blocks, n_words, n_wide = struct.unpack_from(_HEAD, data)
    if magic != _MAGIC:
        raise ValueError("not a segment of Simple-8b words")
    at, parts = struct.calcsize(_HEAD), []
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_blocks), ("<u8", n_words), ("<u8", n_wide)):
        parts.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += parts[-1].nbytes
    docs, nulls, counts, blocks, words, wide = parts
    return [None if x else d for d, x in zip(docs.tolist(), nulls.tolist(), strict=True)], counts, unpack(words, blocks.astype(np.int64), n_ids, wide)


def read_block(data: bytes, k: int) -> np.ndarray:
    """The ids of block ``k`` alone."""
    _, n_docs, n_ids, n_blocks, n_words, n_wide = struct.unpack_from(_HEAD, data)
    at = struct.calcsize(_HEAD) + 13 * n_docs
    blocks = np.append(np.frombuffer(data, "<u4", n_blocks, at), n_words)
    words = np.frombuffer(data, "<u8", n_words, at + 4 * n_blocks)[blocks[k] : blocks[k + 1]]
    wide = np.frombuffer(data, "<u8", n_wide, at + 4 * n_blocks + 8 * n_words)
    return unpack(words, np.zeros(1, dtype=np.int64), min(BLOCK_IDS, n_ids - k * BLOCK_IDS), wide)
