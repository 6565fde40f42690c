"""Transducer coding, hard negatives and collocations against the library and brute force, on hard rows too."""

from __future__ import annotations

import base64
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cairnflow.llm import byte_bpe, collocations, hard_negatives

from test_operators import SCHEMA, hard_rows

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = " \t\n\x0b\x1c\x85 　aAé1²Ⅷ'stll٣漢字😀̀_-=.ԯᲉ"


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBPE(RANKS, byte_bpe._classes(public_tokenizers.PATTERN))


def ids(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


def test_transducer_equals_library(library, coder):
    draw = random.Random(3)
    tokens = list(byte_bpe.read_ranks(RANKS))
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 40))) for _ in range(800)]
    texts += [b"".join(draw.choice(tokens) for _ in range(draw.randint(1, 8))).decode("utf-8", "ignore") for _ in range(800)]
    texts += ["".join(draw.choice("aehinorst") for _ in range(draw.randint(1, 60))) for _ in range(400)]
    texts += ["a" * 30_000, "漢字" * 5000, "".join(draw.choice("abcdefghij") for _ in range(20_000)), " " * 3000]
    for text in texts:
        got = ids(coder, text)
        assert got == library.encode_ordinary(text)
        assert coder.decode(got) == text


def test_transducer_forgets(library):
    """Few states and remembered pieces at once: the same ids."""
    small = byte_bpe.ByteBPE(RANKS, byte_bpe._classes(public_tokenizers.PATTERN), remember=2000)
    small.fst.most = small.utf8.most = 40
    for text in ("some words that go on and on, again some words " * 5, "naïve café 漢字 " * 9):
        got = ids(small, text)
        assert got == library.encode_ordinary(text)
        assert small.decode(got) == text
        assert len(small.fst.states) <= 41


def test_lookahead_is_bounded(coder):
    """No way stays open for longer than the longest token."""
    longest = max(map(len, coder.fst.ranks))
    state, waiting = coder.fst.start, 0
    for c in b"internationalisation" * 40:
        state, sent = state.get(c) or coder.fst.step(state, c)
        waiting = 0 if sent else waiting + 1
        assert waiting <= longest
        assert len(state[byte_bpe._WAYS]) <= longest + 1


def test_utf8_machine():
    draw = random.Random(4)
    token = {k: bytes([k]) for k in range(256)} | {256: b"\xe6\xbc", 257: b"\xa2\xe5\xad\x97", 258: b"\xf0\x9f"}
    for _ in range(600):
        some = [draw.choice(list(token)) for _ in range(draw.randint(0, 12))]
        assert byte_bpe.Utf8(token, most=5).decode(some) == b"".join(token[k] for k in some).decode("utf-8", "replace")


def test_byte_bpe_rows(spark, library):
    rows = spark.createDataFrame(hard_rows(), SCHEMA)
    got = byte_bpe.byte_bpe_encode(rows, RANKS, decoded="size").collect()
    assert Counter((r.doc_id, r.text, tuple(r.ids), r["size"]) for r in got) == Counter((r[0], r[1], tuple(library.encode_ordinary(r[1] or "")), r[1] or "") for r in hard_rows())
    back = byte_bpe.byte_bpe_decode(spark.createDataFrame([(1, [72, 257], "x"), (2, [], "y"), (3, None, "z")], "k int, ids array<int>, decoded string"), RANKS).collect()
    assert {r.k: r.decoded for r in back} == {1: library.decode([72, 257]), 2: "", 3: None}
    assert byte_bpe.byte_bpe_encode(rows.limit(0), RANKS).count() == 0


def brute_negatives(rows, positives=5, negatives=10):
    sound = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    seen = {(i, l, tuple(v)) for i, v, l, *_ in rows if i is not None and l is not None and sound(v)}
    items = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in seen]
    clip = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
    out = []
    for i, l, q in items:
        if i % 100:
            continue
        scored = sorted((-clip(sum(a * b for a, b in zip(q, c, strict=True))), j, m) for j, m, c in items if j != i and len(c) == len(q))
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            own = [(-t, k) for t, k, m in scored if m != l and -30 * s <= -100 * t <= -90 * s][:negatives]
            out += [(i, j, n + 1, k, -s, t) for n, (t, k) in enumerate(own)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, score long, wish int"


def mined(spark, rows):
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0, F.col("label"))
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    rng = np.random.default_rng(8)
    length = rng.lognormal(0, 1.2, 900)  # norms far apart, so that waves end the search early
    rows = [(k, (rng.normal(size=6) * length[k]).tolist(), int(k % 4), 0, 0) for k in range(900)]
    rows += [(k, [0.5, 0.5, 0.5, 0.25, 0.0, 0.1], k % 3, 0, 0) for k in range(1000, 1400)]  # ties of one vector
    assert mined(spark, rows) == brute_negatives(rows)


def test_hard_negatives_on_hard_rows(spark):
    rows = [(0, [1.0, 2.0], 1, 5, 5), (0, [1.0, 2.0], 1, 6, 6), (100, [1.0, 1.0, 1.0], 1, 5, 5), (200, [0.0, 0.0], 2, 1, 1), (300, [3e17, 2e17], 1, 1, 1), (400, [1e-9, -1e-9], 1, 1, 1)]
    rows += [(k, [1.0 + k % 3, 1.0], k % 2, None, None) for k in range(1, 40)] + [(k, [0.3, 0.3, 0.3], k % 2, 0, 0) for k in range(41, 60)]
    rows += [(500, None, 1, 0, 0), (600, [1.0, None], 1, 0, 0), (700, [1.0, float("nan")], 1, 0, 0), (800, [1.0, 1.0], None, 0, 0), (None, [1.0, 1.0], 1, 0, 0), (900, [], 1, 0, 0), (61, [float("inf"), 0.0], 0, 0, 0)]
    rows += [(7, [1.5, 1.0], 1, 0, 0), (3, [2.0, 1.0], 0, 0, 0), (62, [0.0, 0.0], 2, 0, 0), (63, [0.0, 0.0], 1, 0, 0)]
    got = mined(spark, rows)
    assert got == brute_negatives(rows) and len(got) > 40
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1, 0, 0)]) == []


def brute_phrases(rows, top=2000, least=30):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(mark, "\n")
        for piece in low.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                for k in range(len(words) - n + 1):
                    key = (lang, tuple(words[k : k + n]))
                    counts[key] = counts.get(key, 0) + 1
    cands = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), f in cands.items():
        for n in range(2, len(words)):
            covered |= {(lang, words[k : k + n]) for k in range(len(words) - n + 1) if 100 * f >= 80 * cands[lang, words[k : k + n]]}
    by_lang = {}
    for (lang, words), a in cands.items():
        if (lang, words) not in covered:
            score, _, l, r = min((2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words)))
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, n + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, own in by_lang.items() for n, (s, a, p, l, r) in enumerate(sorted(own)[:top]))


@pytest.mark.parametrize("gather", [50, 1_500_000])
def test_collocations_equal_brute_force(spark, monkeypatch, gather):
    monkeypatch.setattr(collocations, "GATHER", gather)
    draw = random.Random(6)
    words = ["of", "the", "Rain", "über", "été", "x\x1cy", "in", "Spain"]
    rows = [(k, " ".join(draw.choices(words, [5, 5, 3, 1, 1, 1, 4, 2], k=draw.randint(0, 60))).replace("in Spain", "in\tSpain." if k % 3 else "in  Spain"), ["en", "fr", None, "und"][k % 4], "s", 1, 1, "") for k in range(240)]
    rows += [(900 + k, "New York City Hall", "en", "s", 1, 1, "") for k in range(40)] + [(990, "one two " * 20_000, "en", None, None, None, None), rows[5], *hard_rows()]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted(tuple(r) for r in collocations.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute_phrases(rows) and len(got) > 50
    few = sorted(tuple(r) for r in collocations.collocations(docs, top=7).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert few == brute_phrases(rows, top=7)
    assert collocations.collocations(docs.limit(0)).count() == 0
