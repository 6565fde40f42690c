"""The Spark operators against brute force on small tables, and on hard rows: nulls, blanks, ties, copies, clashing names."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairnflow.llm import langid, toxicity, url_filter
from cairnflow.llm.ann import nearest
from cairnflow.llm.bpe import bpe_decode, bpe_encode
from cairnflow.llm.exact_dedup import exact_dedup
from cairnflow.llm.jaccard_join import jaccard_components
from cairnflow.llm.mixing import fit, mix, targets
from cairnflow.llm.pii import pseudonymise
from cairnflow.llm.token_output import read_tokens, write_tokens
from cairnflow.llm.url_filter import judge, segment

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, ids string"
LONG = " ".join(f"w{k}" for k in range(30_000))


def sentence(seed, n=60):
    return " ".join(np.random.default_rng(seed).choice([f"word{k}" for k in range(4000)], n))


def hard_rows():
    base = sentence(1)
    words = base.split()
    near = [" ".join(words[:k] + [f"new{k}"] + words[k + 1 :]) for k in (5, 30, 59)]
    chain = [" ".join([*words[: 60 - k], *(f"t{j}" for j in range(k))]) for k in range(0, 30, 4)]
    texts = [None, "", "   \n", base, base, base.upper(), base.replace(" ", "\n"), *near, *chain, "one two", "one two", "One\ttwo", LONG, LONG + " end", sentence(2), sentence(2) + " tail", "é", "<|endoftext|> x", "123 456"]
    rows = [(k, t, ["en", "fr", None][k % 3], [f"s{k % 4}", None][k % 5 == 4], k, 1, "x") for k, t in enumerate(texts)]
    return [*rows, rows[3], (None, base, None, None, None, None, None), (None, "", "en", "s1", 0, 0, "y")]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(hard, empty):
    rows = hard.withColumn("row", F.monotonically_increasing_id())
    got = {r.row_id: r for r in exact_dedup(rows, row_id="row", block_bytes=64).collect()}
    plain = [(r.row, r.doc_id, r.text or "") for r in rows.collect()]
    groups = defaultdict(list)
    for row, doc, text in plain:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc is None, doc or 0, row, doc))
    assert len(got) == len(plain)
    for norm, own in groups.items():
        best = min(own)
        for _, _, _, row, doc in own:
            r = got[row]
            assert (r.keep_id, r.group_size, r.kept, r.doc_id) == (best[4], len(own), row == best[3], doc)
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    assert exact_dedup(empty).count() == 0


def shingles(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        low[find(k)].append(doc)
    return sets, [min((d for d in low[find(k)] if d is not None), default=None) if sets[k] else rows[k][0] for k in range(len(rows))]


def test_jaccard_components(hard, empty):
    rows = hard.withColumn("row", F.monotonically_increasing_id())
    plain = [(r.row, r.doc_id, r.text) for r in rows.collect()]
    sets, low = brute_components([(d, t) for _, d, t in plain])
    got = {r.row_id: (r.n_shingles, r.component_id) for r in jaccard_components(rows).collect()}
    by_doc = Counter((d, len(s), c) for (_, d, _), s, c in zip(plain, sets, low, strict=True))
    assert by_doc == Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(hard).collect())
    assert len(got) == len(plain)
    assert jaccard_components(empty).count() == 0


@pytest.mark.parametrize(("split_from", "members", "worth"), [(2, 1, 1.0), (1, 2, 0.0)])
def test_jaccard_components_in_small_parts(spark, split_from, members, worth):
    """Split buckets, one member a pivot copy, few and many draws of pivots: the same links."""
    rng = np.random.default_rng(11)
    bases = [[f"v{rng.integers(300)}" for _ in range(n)] for n in (6, 9, 30, 31, 60)]
    texts = []
    for k in range(90):
        words = list(bases[k % len(bases)])
        for _ in range(rng.integers(0, 4)):
            words[rng.integers(len(words))] = f"v{rng.integers(300)}"
        texts.append(" ".join(words * int(rng.integers(1, 3)) + ["tail"] * int(rng.integers(0, 3))))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, low = brute_components(list(enumerate(texts)))
    got = {r.doc_id: r.component_id for r in jaccard_components(rows, split_from=split_from, members=members, worth=worth).collect()}
    assert got == dict(enumerate(low)) and len(set(low)) < len(low)


def test_jaccard_links_words_and_not_hashes(spark):
    """Thue-Morse words and their complements agree in every polynomial hash modulo 2^64."""
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    texts = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_components(rows).collect()} == {0: 0, 1: 1}


def test_tokens_on_disk(hard, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_id, r.text or "") for r in hard.collect()), key=lambda r: r[:2])
    got = sorted(read_tokens(write_tokens(hard, path, segment_ids=5000)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[2] for r in rows]
    expected = Counter((d, len(ids) + 1, zlib.crc32(np.array([*ids, 0], dtype="<u4").tobytes())) for _, _, d, t in rows for ids in [library.encode(t, add_special_tokens=False).ids])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert read_tokens(write_tokens(empty, path)).count() == 0


def test_bpe_columns(hard, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    out = bpe_decode(bpe_encode(hard, path), path)
    assert out.columns == [*[c for c in hard.columns if c != "ids"], "ids", "decoded"]
    for r in out.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    both = bpe_encode(hard, path, decoded="decoded")
    assert both.columns == out.columns and sorted(map(repr, both.collect())) == sorted(map(repr, out.collect()))
    assert bpe_decode(bpe_encode(empty, path), path).count() == 0


def test_mix(hard, empty):
    rows = mix(hard).collect()
    assert len(rows) == hard.count() and sorted(rows) == sorted(mix(hard).collect())
    texts = Counter((r.doc_id, len(WORDS.findall(r.text or ""))) for r in hard.collect())
    assert Counter((r.doc_id, r.size) for r in rows) == texts
    for r in rows:
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= 3 * r.size
    taken, goal = defaultdict(int), {}
    for r in rows:
        taken[r.source_size, r.target] += r.taken
        goal[r.source_size, r.target] = r.target
    assert sum(goal.values()) <= sum(r.size for r in rows) + 1e-6
    left = {k: min((r.size for r in rows if (r.source_size, r.target) == k and r.size and r.taken == min(3, int(r.target // r.source_size)) * r.size), default=0) for k in goal}
    assert all(taken[k] <= goal[k] + 1 and taken[k] > goal[k] - 1 - left[k] for k in goal)
    assert mix(empty).count() == 0


def test_targets_and_fit():
    assert targets([("b", 1000), ("a", 10), (None, 5)]) == {"a": 30.0, "b": 970.0, None: 15.0}
    assert targets([("a", 0), ("b", 0)]) == {"a": 0.0, "b": 0.0}
    rng, best, reached = np.random.default_rng(2), 0, 0
    for _ in range(200):
        lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 8), replace=False))
        counts = rng.integers(1, 5, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        sums = {0}
        for size, n in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + size * k for s in sums for k in range(n + 1)}
        for dp_words in (5, 20_000):
            take = fit(lengths, counts, budget, dp_words)
            assert (take >= 0).all() and (take <= counts).all() and (take * lengths).sum() <= budget
            short = budget - (take * lengths).sum()
            assert short < min([*lengths[take < counts].tolist(), budget + 1])
        best += max(s for s in sums if s <= budget)
        reached += int((fit(lengths, counts, budget) * lengths).sum())
    assert 0.995 * best <= reached <= best
    assert (fit(np.array([3, 5, 7]), np.array([4, 4, 4]), 41) * np.array([3, 5, 7])).sum() == 41


def test_forward_backward_is_exact():
    import itertools

    rng = np.random.default_rng(0)
    start, moves, k = rng.normal(size=3), rng.normal(size=(3, 3)), 3
    parts = [rng.normal(size=(n, k)) for n in (3, 1, 4)]
    got, at = langid.forward_backward(np.concatenate(parts), np.array([3, 1, 4]), start, moves), 0
    for s in parts:
        m = np.zeros_like(s)
        for way in itertools.product(range(k), repeat=len(s)):
            w = np.exp(start[way[0]] + sum(s[i, way[i]] for i in range(len(s))) + sum(moves[way[i], way[i + 1]] for i in range(len(s) - 1)))
            for i, x in enumerate(way):
                m[i, x] += w
        assert np.allclose(m / m.sum(axis=1, keepdims=True), got[at : at + len(s)])
        at += len(s)


EN, FR = "the and of that with from this have were been", "le les une dans pour avec mais vous elle nous"


def test_language_labels(spark, hard, empty):
    rng = np.random.default_rng(4)
    make = lambda v, n: " ".join(rng.choice(v.split(), n))
    rows = [(k, make(EN if k % 2 else FR, 40), "en" if k % 2 else "fr") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs).collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    model = langid.fit_language_model(docs)
    switched = make(EN, 30) + " " + make(FR, 20)
    found = {r.doc_id: r for r in langid.label_languages(hard.union(spark.createDataFrame([(99, switched, None, None, None, None, None)], hard.schema)), model).collect()}
    assert [x.lang for x in found[99].runs] == ["en", "fr"] and [x.words for x in found[99].runs] == [30, 20]
    for k, t in enumerate(r[1] for r in hard_rows()[:3]):
        assert (found[k].lang_pred, found[k].score, found[k].runs) == ("und", 0.0, [])
    assert langid.label_languages(empty, model).count() == 0
    assert langid.fit_language_model(empty) is None
    assert {r.lang_pred for r in langid.label_languages(hard, None).collect()} == {"und"}


def test_toxicity_chain(spark, hard, empty):
    rng = np.random.default_rng(5)
    plain = [f"word{k}" for k in range(200)]
    bad = ["idiot", "scum", "zorkulent", "zorkular"]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [*rng.choice(plain, 30), *([bad[k // 4 % 4]] if toxic else [])]
        rows.append((k, " ".join(rng.permutation(words))))
        labels.append((k, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, marks.where("doc_id % 8 < 5"))
    found = toxicity.score_toxicity(docs, model).where("doc_id % 8 >= 5 OR doc_id % 8 = 0").collect()
    right = sum(r.toxic == (r.doc_id % 4 == 0) for r in found)
    assert right >= 0.97 * len(found)
    for r in toxicity.score_toxicity(docs.where("doc_id < 12"), model).collect():  # the chain by hand
        has, p = {f for w in set(re.findall(r"[^\W\d_]+", r.text.lower())) for f in toxicity.features_of(w)}, []
        for m in model["models"]:
            z = m["bias"] + sum(float(w) for f, w in zip(m["kept"], m["weights"], strict=True) if int(f) in has) + sum(float(w) * x for w, x in zip(m["more"], p, strict=True))
            p.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        assert np.allclose(p, [r[f"p_{c}"] for c in toxicity.CHAIN])
    assert toxicity.fit_toxicity(docs.unionByName(docs), marks)["models"][-1]["bias"] == toxicity.fit_toxicity(docs, marks)["models"][-1]["bias"]
    assert {r.toxic for r in toxicity.score_toxicity(hard, None).collect()} == {False}
    assert all(r.p_toxic == 0 for r in toxicity.score_toxicity(hard, model).collect() if not r.text)
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.fit_toxicity(empty.select("doc_id", "text"), marks) is None


def test_nearest(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    vectors = [(k, (centres[k % 12] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for k in range(900)]
    vectors += [(k, vectors[20][1]) for k in range(900, 960)]  # many equal ones
    bad = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (None, vectors[0][1]), (2080, [1.0] * 5), vectors[40]]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>")
    rows = nearest(df, F.col("vec_id") % 20 == 0).collect()
    ids, m = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], dtype=np.float32).astype(float)
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = m @ m[list(ids).index(q)]
        order = [int(ids[k]) for k in np.lexsort((ids, -np.round(score, 12))) if ids[k] != q][:20]
        assert len(found) == 20 and q not in [f[0] for f in found]
        assert all(abs(s - score[list(ids).index(v)]) < 1e-9 for v, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len({f[0] for f in found} & set(order))
    assert hits >= 0.9 * 20 * len(got)
    assert nearest(df.where("vec_id < 0"), F.lit(True)).count() == 0
    few = nearest(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_equal_scores_go_to_the_smaller_id(spark):
    """Over a hundred distinct vectors with the same inner product, in double precision."""
    rows = [(0, [1.0, 0.0, 0.0, 1e-9])] + [(1000 - k, [0.5, float(k), float(-k), 0.0]) for k in range(1, 120)] + [(5000, [0.5 + 2**-50, 7.5, 0.0, 0.0]), (5001, [1e39, 0.0, 0.0, 0.0])]
    out = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [5001, 5000, *range(881, 899)]
    assert [r.score for r in out[:3]] == [1e39, 0.5 + 2**-50, 0.5]


def test_segment_is_the_best_of_all_splits():
    import itertools
    import math

    rng = np.random.default_rng(3)
    for _ in range(150):
        name = "".join(rng.choice(list("abc"), rng.integers(1, 9)))
        logs = {"".join(rng.choice(list("abc"), rng.integers(1, 5))): -float(rng.uniform(0.1, 20)) for _ in range(8)} | {"": -9.0}
        cost = lambda w: logs.get(w, logs[""] - math.log(10) * len(w))  # noqa: B023, E731
        best = max(sum(cost(name[a:b]) for a, b in itertools.pairwise([0, *cut, len(name)])) for n in range(len(name)) for cut in itertools.combinations(range(1, len(name)), n))
        assert abs(sum(map(cost, segment(name, logs))) - best) < 1e-9
    assert segment("x" * 5000, {"": -3.0}) == ["x" * 5000]


def test_bayes_odds_are_counted_by_hand():
    import math

    logs = {"spam": -1.0, "calm": -1.0, "": -9.0}
    model = url_filter.fit_bayes([("spamcalm.org", "/a", "block", 2), ("calm.com", "/a", "allow", 1)], logs)
    words = {"block": Counter({"h:spam": 2, "h:calm": 2, "h:org": 2, "p:a": 2, "t:org": 2}), "allow": Counter({"h:calm": 1, "h:com": 1, "p:a": 1, "t:com": 1})}
    every = set(words["block"]) | set(words["allow"])
    total = {k: sum(c.values()) + len(every) for k, c in words.items()}
    assert set(model["odds"]) == every and math.isclose(model["prior"], math.log(3 / 2))
    for w in every:
        assert math.isclose(model["odds"][w], math.log((words["block"][w] + 1) / total["block"] / ((words["allow"][w] + 1) / total["allow"])))


def test_url_verdicts(spark):
    logs = {"data": -1.0, "base": -1.0, "dat": -5.0, "abase": -5.0, "": -10.0}
    assert segment("database", logs) == ["data", "base"] and segment("", logs) == []
    urls = ["http://A.example.COM/en/7x?q#f", "https://b.org/es/1", "http://example.net/de/8#x", "http://example.net/de/9", "http://xcom/en/", "http://com/en/1", "no scheme", None, "", "http://u.net?x=/de/", "ftp://h.org"]
    df = spark.createDataFrame([(k, u, "<p>data base</p>") for k, u in enumerate(urls)] + [(None, urls[1], None)], "page_id long, url string, html string")
    out = {r.page_id: r for r in judge(df).collect()}
    assert (out[0].host, out[0].path, out[0].rule, out[0].verdict) == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert [out[k].rule for k in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == ["org/es/", "example.net/de/8", "net/de/", None, "com/en/", None, None, None, None]
    assert [out[k].verdict for k in (1, 2, 3, 5)] == ["block", "block", "allow", "block"]
    assert (out[6].host, out[7].host, out[9].host, out[9].path) == ("", "", "u.net", "") and len(out) == len(urls) + 1
    assert all(r.verdict in ("allow", "block") for r in out.values())
    assert judge(df.where("page_id < 0")).count() == 0


def test_url_method_holds_out(spark):
    rng = np.random.default_rng(8)
    rows = [(k, f"http://{'spam' if k % 2 else 'calm'}{rng.choice(['site', 'land'])}.example.com/en/{'7' if k % 2 == 0 else '1'}{k}", "spam calm site land") for k in range(200)]
    rows += [(1000 + k, f"http://{'spam' if k % 2 else 'calm'}land.example.com/fr/{k}", None) for k in range(40)]
    out = judge(spark.createDataFrame(rows, "page_id long, url string, html string")).where("page_id >= 1000").collect()
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in out)


def test_pseudonym_columns(hard, empty):
    out = pseudonymise(hard.withColumn("kinds", F.lit(1)).withColumn("text", F.when(F.col("doc_id") == 3, "mail a1@b.co, 4111111111111111").otherwise(F.col("text"))), b"key")
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text is None and rows[1].text == "" and rows[3].n_values == 2 and "4111111111111111" not in rows[3].text
    assert out.columns == [*hard.columns, "n_values", "kinds", "starts", "lengths"] and pseudonymise(empty, b"key").count() == 0
    again = pseudonymise(out, b"key", back=True).collect()
    assert {r.doc_id: r.text for r in again}[3] == "mail a1@b.co, 4111111111111111" and len(again) == len(rows) + 2
