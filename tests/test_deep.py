"""Choices kept up to date, nested documents, vendors as written, chain graphs: hand-made and hard rows."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from cairnflow.functions import dates, vendors
from cairnflow.operators import campaigns, changes, nested
from cairnflow.sources.shared import new_path

MEMBERS = "record long, member long, score double, valid boolean"


def test_changes_equal_choosing_anew(spark):
    draw = random.Random(9)
    path, known, chosen = new_path(spark, "choice"), {}, {}
    for version in range(4):
        batch = {(draw.randrange(12), draw.randrange(6)): (draw.choice([None, 1.0, 2.0, 3.0]), draw.random() < 0.7) for _ in range(14)}
        rows = spark.createDataFrame([(r, m, s, v) for (r, m), (s, v) in batch.items()] + [(None, 1, 1.0, True), (1, None, 1.0, True)], MEMBERS)
        if version:
            made = {r.record: r.member for r in changes.change(spark, path, rows, version, buckets=4).collect()}
            assert set(made) == {r for r, _ in batch}
        else:
            changes.start(rows, path, buckets=4)
        known |= batch
        for record in {r for r, _ in batch}:
            own = {m: s for (r, m), (s, v) in known.items() if r == record and v}
            best = min(own, key=lambda m: (own[m] is None, -(own[m] or 0), m), default=None)
            now = chosen.get(record)
            stays = now in own and (own[best] is None or (own[now] is not None and own[now] >= own[best]))
            chosen[record] = now if stays else best
        assert {r.record: r.member for r in changes.selected(spark, path).collect()} == chosen
    again = changes.change(spark, path, rows, version, buckets=4).count()  # a step run again
    assert again and {r.record: r.member for r in changes.selected(spark, path).collect()} == chosen
    assert changes.change(spark, path, rows.limit(0), 9, buckets=4).count() == 0


def test_nested_documents_merge_by_preference(spark):
    docs = [
        (1, 2, "b", '{"a":{"x":1,"y":{"z":"deep"}},"l":[1,"q"],"n":null,"e":{}}'), (1, 1, "a", '{"a":{"x":2.5},"l":["q",{"k":1}],"t":true}'), (1, 3, "c", '{"a":7,"l":"one"}'),
        (2, 1, "a", '{"a":5}'), (2, 2, "b", '{"a":{"x":1}}'), (3, 1, "a", None), (3, 2, "b", "not json"), (4, 1, "a", "[1,2]"), (5, 1, "a", '{"k\\"q":"v\\n","a":{"b":{"c":{"d":{"e":1}}}}}'),
    ]
    rows = spark.createDataFrame(docs, "k int, o int, s string, doc string").withColumn("path", F.lit("mine"))
    leaf = nested.leaves(rows, "doc", ["k", "o", "s"])
    merged = nested.merged_leaves(leaf, "k", "o", "s")
    got = {(r.k, r.path): (r.value, r.sources) for r in merged.collect()}
    assert got[1, "a.x"] == ("2.5", ["a"]) and got[1, "a.y.z"] == ('"deep"', ["b"]) and (1, "a") not in got and (1, "n") not in got
    assert got[1, "l"] == ('["q",{"k":1},1]', ["a", "b"]) and got[1, "t"] == ("true", ["a"])
    assert got[2, "a"] == ("5", ["a"]) and (2, "a.x") not in got and not {k for k, _ in got} & {3, 4}
    whole = {r.k: json.loads(r.document) for r in nested.documents(merged, "k").collect()}
    assert whole == {1: {"a": {"x": 2.5, "y": {"z": "deep"}}, "l": ["q", {"k": 1}, 1], "t": True}, 2: {"a": 5}, 5: {'k"q': "v\n", "a": {"b": {"c": {"d": {"e": 1}}}}}}
    assert nested.leaves(rows.limit(0), "doc", ["k"]).count() == 0


def split_by_hand(text):
    parts, held, depth = [], "", 0
    for ch in text:
        depth = depth + 1 if ch == "(" else max(0, depth - 1) if ch == ")" else depth
        if ch == "," and not depth:
            parts.append(held)
            held = ""
        else:
            held += ch
    return [p.strip(" ") for p in [*parts, held] if p.strip(" ")]


def test_entities_are_split_outside_brackets(spark):
    draw = random.Random(4)
    texts = ["", ",", "a, b", "A (b, c), d", "x ((y, z), w), q", ") a, b (", "(a, b", *("".join(draw.choice("ab ,()é") for _ in range(25)) for _ in range(60))]
    got = {r.t: r.e for r in spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", vendors.split_entities(F.col("t")).alias("e")).collect()}
    assert got.pop(None) is None
    assert got == {t: split_by_hand(t) for t in texts}


def test_vendors_by_registry(spark):
    registry = spark.createDataFrame([("Canvas", "Instructure", "Canvas", 1), ("Instructure", "Instructure", "Canvas", 2), ("MOVEit", "Progress Software", "MOVEit", 3), ("canvas", "Other", "X", 9), (None, "n", "n", 0)], "alias string, vendor string, platform string, rank int")
    rows = spark.createDataFrame([(1, ["MOVEit (Progress), NSC, TIAA", "canvas"]), (2, ["Canvas (Instructure)", "Hosting by (Instructure)", "SureFire (contractor)"]), (3, None), (4, [None, "(only)"])], "k int, v array<string>")
    got = {r.k: (r.vendors, r.platforms) for r in vendors.canonical_vendors(rows, "k", "v", registry).collect()}
    assert got == {1: (["Progress Software", "NSC", "TIAA", "Instructure"], ["MOVEit", "Canvas"]), 2: (["Instructure", "SureFire"], ["Canvas"]), 3: ([], []), 4: (["(only)"], [])}


def test_chains_reach_every_end(spark):
    named = spark.createDataFrame([("c", ["Grader"], ["Acme"], ["CVE-1", "CVE-2"], ["Zed", "Yan"]), ("d", [], [], ["CVE-1"], [])], "campaign_id string, platforms array<string>, vendors array<string>, cves array<string>, actors array<string>")
    evidence = spark.createDataFrame([("c", 1, ["Grader"], ["Acme"], ["CVE-1"], None), ("c", 1, None, None, None, ["Zed", "Stranger"]), ("c", 2, ["Other"], ["Acme"], [], ["Zed"])], "campaign_id string, i long, platforms array<string>, vendors array<string>, cves array<string>, actors array<string>")
    nodes, edges = campaigns.chain_graph(named, evidence, "i")
    assert {tuple(r) for r in edges.collect()} == {("c", "platform:grader", "cve:cve-1", "has_vuln"), ("c", "cve:cve-1", "actor:zed", "exploited_by"), ("c", "platform:grader", "cve:cve-2", "has_vuln"), ("c", "platform:grader", "actor:yan", "targeted_by")}
    assert {(r.node, r["size"], r.layer) for r in nodes.where("campaign_id = 'c'").collect()} == {("platform:grader", 24, 0), ("vendor:acme", 22, 0), ("cve:cve-1", 18, 1), ("cve:cve-2", 18, 1), ("actor:zed", 18, 2), ("actor:yan", 18, 2)}
    members = spark.createDataFrame([("c", 1), ("c", 2), ("c", 3)], "campaign_id string, member long")
    assert {(r.group, r.via, r["count"], tuple(r["first"])) for r in campaigns.victim_groups(named, members, evidence, "i", most=1).collect()} == {("platform:grader", "platform", 1, (1,)), ("vendor:acme", "vendor", 1, (2,)), ("direct", "direct", 1, (3,))}


def test_hierarchy(spark):
    rows = spark.createDataFrame([("r", "a", "x"), ("r", "a", "x"), ("r", "b", None), ("s", "a", "y"), ("r", "a", "w")], "l string, m string, n string")
    got = {r.name: (r.value, [(c.name, c.value, [tuple(d) for d in c.children]) for c in r.children]) for r in nested.hierarchy(rows, ["l", "m", "n"]).collect()}
    assert got == {"r": (4, [("a", 3, [("x", 2), ("w", 1)]), ("b", 1, [("Unknown", 1)])]), "s": (1, [("a", 1, [("y", 1)])])}
    assert nested.hierarchy(rows.limit(0), ["l", "m"]).count() == 0


def test_vendors_are_met_by_key_without_sending_rows_everywhere(spark):
    rows = spark.createDataFrame([(1, ["Acme (Grader), Bolt"]), (2, None), (3, [None, " , "])], "id long, v array<string>")
    registry = spark.createDataFrame([("grader", "Acme Inc", "Grader", 1)], "alias string, vendor string, platform string, rank int")
    found = vendors.canonical_vendors(rows, "id", "v", registry)
    assert {r.id: (r.vendors, r.platforms) for r in found.collect()} == {1: (["Acme Inc", "Bolt"], ["Grader"]), 2: ([], []), 3: ([], [])}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the registry alone


def test_relative_days_read_a_text_once(spark):
    rows = spark.createDataFrame([("Seven  weeks ago", 49), ("0 days ago, last week", 7), ("99999999999 days ago", None), ("five days ago", 5), (None, None)], "t string, back int")
    rows = rows.withColumn("d", F.lit("2024-05-20").cast("date"))
    found = rows.select(F.datediff("d", dates.relative_date(F.col("t"), F.col("d"))).alias("got"), "back", dates.relative_day(F.col("t"), F.col("d")).alias("day"))
    assert all(r.got == r.back for r in found.collect())
    assert found.select("day")._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_leaves_open_documents_in_one_pass(spark):
    docs = [(1, '{"a":{"b":{"c":{"d":{"e":1}}},"x":{}},"l":[1],"n":null}'), (2, "{}"), (3, "[1]"), (4, "no json"), (5, None), (6, '{"":{"k":2}}')]
    found = nested.leaves(spark.createDataFrame(docs, "id long, doc string"), "doc", ["id"])
    assert sorted(map(tuple, found.collect())) == [(1, "a.b.c.d", "value", '{"e":1}'), (1, "l", "list", "[1]"), (6, "k", "value", "2")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
