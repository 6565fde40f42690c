"""The phrase matcher against brute force, by trie and by join, and the labels that ride on it."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from cairnflow.functions import identity, infer, vocab
from cairnflow.operators.phrases import find_phrases, with_phrases

TABLE = [("vendor", "Power", 0, "Power School"), ("vendor", "Power", 1, "power"), ("actor", "Clop", 2, "cl0p"), ("actor", "Clop", 3, "Clop gang!"), ("flag", "trend", 4, "trend report"), ("x", "none", 5, " -- "), ("x", "null", 6, None), ("place", "Zürich", 7, "in ZÜRICH"), ("vendor", "Power", 0, "Power School"), ("y", None, 9, "a a")]
SCHEMA = "kind string, label string, rank int, phrase string"


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def brute(text):
    own = words(text)
    return sorted((at, r, k, l or "") for k, l, r, p in TABLE if (w := words(p)) for at in range(len(own)) if own[at : at + len(w)] == w)


def texts():
    draw = random.Random(2)
    made = [" ".join(draw.choices(["power", "School", "clop", "gang", "trend", "report", "a", "in", "Zürich", "PowerSchool", "CL0P."], k=draw.randint(0, 30))) for _ in range(60)]
    return [(k, t, 7) for k, t in enumerate([None, "", "  ", "Power-School; power\nschool", "empower school", "power " * 50_000, *made])]


@pytest.mark.parametrize("most", [100, 3])
def test_phrases_equal_brute_force(spark, most):
    rows = spark.createDataFrame(texts(), "k long, t string, hits int")
    table = spark.createDataFrame(TABLE, SCHEMA)
    got = {r.k: r.hits for r in with_phrases(rows, "t", table, key="k", most=most).collect()}
    assert len(got) == len(texts())
    for k, t, _ in texts():
        assert sorted((h["at"], h["rank"], h["kind"], h["label"] or "") for h in got[k]) == brute(t), t and t[:60]
        assert [h["at"] for h in got[k]] == sorted(h["at"] for h in got[k])
    assert with_phrases(rows.limit(0), "t", table, key="k", most=most).count() == 0
    assert {len(r.hits) for r in with_phrases(rows, "t", table.limit(0)).collect()} == {0}
    with pytest.raises(ValueError, match="key"):
        with_phrases(rows, "t", table, most=2)


def test_trie_reads_once():
    assert find_phrases([], {}) == [] and find_phrases(["a", "b"], {"a": {"b": {None: [("k", "l", 0)]}, None: [("k", "m", 1)]}}) == [("k", "l", 0, 0), ("k", "m", 1, 0)]


def test_inferred_labels_of_hand_made_texts(spark):
    rows = spark.createDataFrame([(1, "The Clop gang used Power School"), (2, "a trend report"), (3, None)], "k int, t string")
    got = {r.k: (r.vendor, r.actor, r.flag) for r in infer.inferred(rows, "t", spark.createDataFrame(TABLE, SCHEMA), first=("vendor",), every=("actor",), flags=("flag",)).collect()}
    assert got == {1: ("Power", "Clop", False), 2: (None, "", True), 3: (None, "", False)}


def test_kinds_places_and_living_families(spark):
    kinds = spark.createDataFrame([("institution", "district", 0, "unified school district"), ("institution", "school", 1, "high school"), ("institution", "university", 2, "university")], SCHEMA)
    cities = spark.createDataFrame([("austin", "US", "Texas"), ("new york", "US", "New York"), ("york", "GB", "England")], "city string, country_code string, region string")
    names = spark.createDataFrame([("Oak Unified School District", None), ("University of Texas at Austin", "unknown"), ("York High School", "college"), ("New York University", None), ("school", None), (None, None)], "name string, known string")
    rows = with_phrases(vocab.with_region(names, "name", cities), "name", kinds)
    got = {r.name: (r.kind, r.region) for r in rows.select("name", "region", infer.institution_kind(F.col("known"), F.col("hits")).alias("kind")).collect()}
    assert got == {"Oak Unified School District": ("district", None), "University of Texas at Austin": ("university", "Texas"), "York High School": ("college", "England"), "New York University": ("university", "New York"), "school": (None, None), None: (None, None)}
    acts = spark.createDataFrame([("a", datetime.date(2024, 1, 1)), ("a", datetime.date(2020, 1, 1)), ("b", None), (None, None)], "f string, d date")
    ends = spark.createDataFrame([("a", datetime.date(2022, 1, 1))], "family string, last_day date")
    assert sorted(map(str, infer.living_families(acts, "f", "d", ends).collect())) == sorted(map(str, spark.createDataFrame([(None, datetime.date(2024, 1, 1)), ("a", datetime.date(2020, 1, 1)), ("b", None), (None, None)], "f string, d date").collect()))
    heads = spark.createDataFrame([("x" * 71, None), ("Breach at school - The Daily Post", ""), ("Lake College", "lake college"), ("Saint-Denis School", "t"), (None, None)], "n string, t string")
    assert [r.h for r in heads.select(infer.is_headline(F.col("n"), F.col("t")).alias("h")).collect()] == [True, True, True, False, False]


def test_generic_labels(spark):
    rows = spark.createDataFrame([("several schools",), ("Websites of a county",), ("An unnamed university",), ("Many Oaks College",), ("Some Districts hit",), ("college",), ("unknown",), ("",), (None,)], "x string")
    assert [r.g for r in rows.select(identity.is_generic_label(F.col("x")).alias("g")).collect()] == [True, True, True, True, True, False, False, False, False]
