"""Documents merged straight from their texts: the same as by their leaves, dealt once, texts as Spark writes them."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from cairnflow.operators import nested

HARD = [
    '{"a":1.50,"b":1e5,"c":123456789012345678901234567890,"d":-0.0,"e":1E400,"f":12345678901234567890123456789012345678901234567890}', '{"s":"q\\"\\\\ \\u0001\\u001f\\n\\u00e9\\ud83d\\ude00 /","t":true,"f":false,"n":null}',
    '{"a":[1.0,"x",null,{"k":[true,null,{}]},[]],"b":[],"c":{},"d":{"e":{"f":{"g":{}}}}}', '{"a":{"b":{"c":{"d":{"e":[1,{"z":"\\t"}]}}}}}', ' {"x.y":1,"":2,"k\\u0002\\"":{"":3}}', '{"x":{"y":5}}', "[1]", "7", "null", "", "no", None, '{"a":1,"a":2}', "{}",
]


def _value(draw, depth):
    kind = draw.randrange(8 if depth else 6)
    if kind > 5:
        return {draw.choice("abc"): _value(draw, depth - 1) for _ in range(draw.randrange(4))}
    return [draw.randrange(9), draw.random(), draw.choice(["x", "é\n"]), None, True, [draw.randrange(3) for _ in range(draw.randrange(4))]][kind]


def test_texts_merge_as_their_leaves(spark):
    draw = random.Random(8)
    rows = [(k, None, str(k % 3), text) for k, text in enumerate(HARD)] + [(100 + k % 4, k % 2, "h", text) for k, text in enumerate(HARD)]
    rows += [(200 + k // 4, draw.choice([None, 1, 2, 3]), f"s{k % 4}", json.dumps({c: _value(draw, 5) for c in "abc"})) for k in range(400)] + [(None, 1, "a", '{"a":1}')]
    docs = spark.createDataFrame(rows, "id long, rank int, source string, doc string").repartition(3)
    found = nested.leaves(docs, "doc", ["id", "rank", "source"])
    by_leaves = {r.id: r.document for r in nested.documents(nested.merged_leaves(found, "id", "rank", "source"), "id").collect()}
    assert {r.id: r.document for r in nested.merged_documents(docs, "doc", "id", "rank", "source").collect()} == by_leaves
    assert len(by_leaves) > 100 and None not in by_leaves
    for text in filter(None, by_leaves.values()):
        json.loads(text)
    assert nested.merged_documents(docs.limit(0), "doc", "id", "rank", "source").count() == 0


def test_documents_are_dealt_once(spark):
    docs = spark.createDataFrame([(1, 1, "a", '{"a":{"b":1}}'), (1, 2, "b", '{"a":{"c":[2,1]}}')], "id long, rank int, source string, doc string")
    dealt = docs.repartition("id")
    for found in (nested.merged_documents(dealt, "doc", "id", "rank", "source"), nested.merged_leaves(nested.leaves(dealt, "doc", ["id", "rank", "source"]), "id", "rank", "source")):
        found.count()
        assert found._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
        assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange ") == 1
    assert nested.merged_documents(docs, "doc", "id", "rank", "source").first().document == '{"a":{"b":1,"c":[2,1]}}'


def test_documents_of_long_and_hard_paths(spark):
    leaf = spark.createDataFrame([(1, "a.b.c.d.e.f", "1"), (1, "a.b.c.x", '"y"'), (1, "a", "5"), (1, "q\"\u0001", "[]"), (2, "z", "{}"), (None, "a", "1")], "k long, path string, value string")
    assert {r.k: r.document for r in nested.documents(leaf, "k").collect()} == {1: '{"a":5,"a":{"b":{"c":{"d":{"e":{"f":1}},"x":"y"}}},"q\\"\\u0001":[]}', 2: '{"z":{}}'}
    assert nested.documents(leaf.where(F.lit(False)), "k").count() == 0
