"""Operators on hand-made rows: nulls, ties, empty tables, and what SQL does not cover."""

from __future__ import annotations

import datetime
import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnflow.functions import text as tx
from cairnflow.operators import aggregate, filters, graph, matching, merging, quality, ranking
from cairnflow.sources import export, shared


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "expected"),
    [("https://WWW.A.com/P/?utm_source=x&b=1#f", "https://a.com/P?b=1"), ("http://a.com/", "http://a.com"), ("nonsense", None), (None, None), ("https://a.com?ref=1", "https://a.com")],
)
def test_normal_url(spark, value, expected):
    assert one(spark, value, tx.normal_url) == expected


@pytest.mark.parametrize(
    ("value", "day", "precision"),
    [("2024-02-29", datetime.date(2024, 2, 29), "day"), ("3/4/2021", datetime.date(2021, 4, 3), "day"), ("8th Mar 2020", datetime.date(2020, 3, 8), "day"), ("2025-08", datetime.date(2025, 8, 1), "month"), ("1999", datetime.date(1999, 1, 1), "year"), ("soon", None, None), (None, None, None), ("2023-02-30", None, None)],
)
def test_lenient_dates(spark, value, day, precision):
    assert one(spark, value, tx.lenient_date) == day and one(spark, value, tx.date_precision) == precision


@pytest.mark.parametrize(("value", "expected"), [("$1,000,000", 1e6), ("275 million", 275.0), ("1.2.3", None), ("none", None), (None, None)])
def test_lenient_number(spark, value, expected):
    assert one(spark, value, tx.lenient_number) == expected


@pytest.mark.parametrize(
    ("value", "kind"),
    [("10.0.0.1", "ipv4"), ("a@b.co", "email"), ("a" * 32, "md5"), ("a" * 40, "sha1"), ("a" * 64, "sha256"), ("b" * 128, "sha512"), ("http://x", "url"), ("fe80::1", "ipv6"), ("a.example.org", "domain"), ("word", None)],
)
def test_indicator_kinds(spark, value, kind):
    assert one(spark, value, tx.indicator_kind) == kind


def test_keys_and_text(spark):
    assert one(spark, " Lock/Bit - Gang ", tx.lookup_key) == "lock_bit_gang"
    assert one(spark, "Lock Bit Ransomware Group", tx.bare_key) == "lock_bit"
    assert one(spark, " - ", tx.lookup_key) is None
    assert one(spark, "University of New Things", tx.acronym) == "unt"
    assert one(spark, "see cve-2021-44228 and CVE-2021-44228, CVE-1990-0001", tx.cves) == ["CVE-2021-44228"]
    assert one(spark, "took 1.5 TB of files", tx.volume_gb) == 1536.0
    assert one(spark, "One. Two leaks! Three leaks? Four.", lambda c: tx.quotes(c, "leak")) == ["Two leaks!", "Three leaks?"]
    assert one(spark, "maybe", tx.lenient_bool) is None and one(spark, " YES ", tx.lenient_bool) is True


def test_filters(spark):
    df = spark.createDataFrame([(1, "Ann", None), (2, "bob", 3), (3, None, 5)], "id int, name string, n int")
    pick = lambda **k: [r.id for r in filters.apply_filters(df, filters.FilterSpec(**k)).collect()]
    assert pick() == [1, 2, 3]
    assert pick(search=" AN ", search_in=("name",)) == [1]
    assert pick(present={"n": False}) == [1] and pick(at_least={"n": 4}) == [3] and pick(any_of={"id": [2, 3]}, at_most={"n": 3}) == [2]
    parents = spark.createDataFrame([(1,)], "id int")
    assert [r.id for r in filters.orphans(df, parents, "id").collect()] == [2, 3] and [r.id for r in filters.live(df, parents, "id").collect()] == [1]


def test_aggregates_guard_empty_and_zero(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert aggregate.breakdown(none, "k").count() == 0
    flat = aggregate.summary(spark.createDataFrame([("a", None)], "k string, v double"), ["k"], "v").first()
    assert (flat.n, flat["mean"], flat.p95) == (0, 0.0, 0.0)
    assert aggregate.unpivot_flags(none, {"x": F.col("v") > 0}).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1), (21, 20)], "a long, b long")
    assert sorted(tuple(r) for r in graph.connected_components(edges).collect()) == [(3, 3), (4, 3), (5, 3), (9, 3), (20, 20), (21, 20)]
    assert graph.connected_components(edges.where("a > 100")).count() == 0
    path = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in graph.connected_components(path).collect()} == {0}


def test_names(spark):
    rows = [(1, "Acme College of Arts", 1), (2, "acme college of arts", 1), (3, "Arts College of Acme", 1), (4, "Acme College Arts", 1), (5, "Acme Colege of Arts", 1), (6, "Other Place", 1), (7, "Acme College of Arts", 2), (8, None, 1)]
    got = {(r.a, r.b): r.route for r in matching.name_pairs(spark.createDataFrame(rows, "id long, name string, k int"), "id", "name", ["k"], ("of",)).collect()}
    assert got[1, 2] == "equal" and got[1, 3] == "words" and got[1, 5] == "alike" and (1, 7) not in got and (1, 6) not in got


@pytest.mark.parametrize("ratio", [85.0, 93.0, 70.0])
def test_names_alike_without_a_common_word(spark, ratio):
    rng = random.Random(3)
    names = ["Microsoft", "Mircosoft", "Health Care", "Healthcare", "ab", "ba", "aab"]
    for _ in range(40):
        name = "".join(rng.choice("abcde ") for _ in range(rng.randint(3, 14)))
        at = rng.randrange(len(name))
        names += [name, name[:at] + rng.choice("abcde ") + name[at + 1 :], name[:at] + name[at + 1 :]]
    plain = {k: " ".join(n.lower().split()) for k, n in enumerate(names) if any(len(w) > 1 for w in n.split())}
    alike = lambda x, y: 100 * difflib.SequenceMatcher(None, x, y).ratio()
    expected = {(a, b) for a in plain for b in plain if a < b and max(alike(plain[a], plain[b]), alike(*[" ".join(sorted(plain[k].split())) for k in (a, b)])) >= ratio}
    got = {(r.a, r.b) for r in matching.name_pairs(spark.createDataFrame(list(enumerate(names)), "id long, name string").withColumn("k", F.lit(1)), "id", "name", ["k"], ratio=ratio).collect()}
    assert expected <= got and ((0, 1) in got) == (ratio < 88) and (2, 3) in got


def test_cosine_top_in_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(matching, "SLICE", 30)
    monkeypatch.setattr(matching, "QUERIES", 7)
    v = np.random.default_rng(5).normal(size=(150, 8)).astype(np.float32)
    rows = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, v array<float>").coalesce(1)
    out = matching.cosine_top(rows, rows.where("vec_id % 3 = 0"), "vec_id", "v", 4, size=3)
    d = v.astype(float)
    cosine = np.round(d @ d.T / np.outer(*[np.linalg.norm(d, axis=1)] * 2), 9)
    expected = {(q, n + 1): int(i) for q in range(0, 150, 3) for n, i in enumerate([i for i in np.lexsort((np.arange(150), -cosine[q])) if i != q][:4])}
    assert {(r.query_id, r.rank): r.vec_id for r in out.collect()} == expected
    assert matching.cosine_top(rows.where("vec_id < 0"), rows, "vec_id", "v", 4).count() == 0


def test_range_pairs_meet_once(spark):
    rows = [(k, "g", datetime.date(2020, 1, 1) + datetime.timedelta(days=d)) for k, d in enumerate([0, 3, 6, 7, 13, 14, 30, 31])] + [(90, "h", datetime.date(2020, 1, 1)), (91, "g", None)]
    got = [tuple(r)[:2] for r in matching.range_pairs(spark.createDataFrame(rows, "id long, k string, day date"), "id", ["k"], "day", 7).collect()]
    days = {k: d for k, g, d in rows if g == "g" and d}
    assert sorted(got) == sorted((a, b) for a in days for b in days if a < b and abs((days[a] - days[b]).days) <= 7)


def test_merging(spark):
    df = spark.createDataFrame([("k", 1, "", "x"), ("k", 2, "b", None), ("k", 3, "c", "z")], "k string, rank int, a string, b string")
    r = merging.merge_fields(df, ["k"], ["a", "b"], [-F.col("rank")]).first()
    assert (r.a, r.b, r.merged_rows) == ("b", "x", 3)
    p = {r.field: r.sources for r in merging.provenance(df.withColumn("s", F.concat(F.lit("s"), "rank")), ["k"], ["a", "b"], "s").collect()}
    assert p == {"a": "s2|s3", "b": "s1|s3"}


def test_quality(spark):
    none = quality.confusion(spark.createDataFrame([], "g boolean, p boolean"), F.col("g"), F.col("p")).collect()
    assert none[0].tp == 0 and none[0].precision == 0.0 and none[0].ci_high == 1.0
    r = spark.range(1).select(quality.reasons({"a": F.lit(None).cast("boolean"), "b": F.lit(True), "c": F.lit(True)}).alias("r")).first().r
    assert r == "b; c"


def test_ranking(spark):
    df = spark.createDataFrame([("a", k) for k in range(5)] + [("b", 9)], "g string, v int")
    assert [tuple(r)[:2] for r in ranking.round_robin(df, "g", [F.col("v")], 3).orderBy("turn", "g").collect()] == [("a", 0), ("b", 9), ("a", 1)]
    assert ranking.knee(df.groupBy("g").agg(F.sum("v").alias("n")), [], [F.desc("n")], "n", 0.9).first().g == "b"


def test_keep_and_discard(spark):
    df = shared.keep(spark.range(3), "t")
    assert df.count() == 3
    shared.discard(df)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST|FAILED_READ"):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], datetime.date(2024, 1, 2)), (2, None, None)], "id int, tags array<string>, day date")
    export.write(df, f"{tmp_path}/c", "csv")
    export.write(df, f"{tmp_path}/j", "json")
    assert [r.tags for r in spark.read.csv(f"{tmp_path}/c", header=True).orderBy("id").collect()] == ["a|b", None]
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    with pytest.raises(ValueError, match="format"):
        export.write(df, f"{tmp_path}/x", "xml")
    lists = {(r["list"], r.key) for r in export.indicator_lists(spark.createDataFrame([("Actor A", "Fam", "FR", "cve-2020-1234|bad"), ("actor a", None, "", None)], "actor string, family string, country string, cves string")).collect()}
    assert lists == {("actor", "actor a"), ("family", "fam"), ("country", "fr"), ("cve", "CVE-2020-1234")}
    text = [r.value for r in export.prometheus(spark.createDataFrame([("hits", "web", 3.0)], "name string, label string, value double")).collect()]
    assert text == ['hits{source="web"} 3.0']
    bundle = export.stix_objects(spark.createDataFrame([("actor", "actor a")], "list string, key string")).first()
    assert bundle.id.startswith("threat-actor--") and '"name":"actor a"' in bundle.json


def test_exact_percentiles(spark):
    """Against numpy, with ties, one value, a null group and a group of nulls; windows of any width."""
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(size=3000)] + [("b", float(x)) for x in rng.integers(0, 4, 900)] + [("c", 7.0), (None, 1.0), (None, 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for accuracy in (10, 10_000):
        got = {r.g: [r[c] for c in shares] for r in aggregate.percentiles(df, ["g"], "x", shares, accuracy).collect()}
        assert set(got) == {"a", "b", "c", None}
        for g in got:
            assert np.allclose(got[g], np.percentile([x for k, x in rows if k == g], [10, 50, 99, 100]))
