"""A large table of phrases meets only the n-grams that may be in it."""

from __future__ import annotations

import random

from cairnflow.operators import phrases


def test_grams_are_dropped_in_the_tasks_and_hits_are_those_of_the_trie(spark):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(12)]
    texts = [(k, draw.choice([None, "", "!", " ".join(draw.choice(words) for _ in range(draw.randint(1, 40)))])) for k in range(120)]
    entries = [("k", str(k), k % 3, " ".join(draw.choice(words) for _ in range(draw.choice((1, 2, 4))))) for k in range(40)] + [("k", "none", 0, "?")]
    df, table = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(entries, "kind string, label string, rank int, phrase string")
    joined = phrases.with_phrases(df, "text", table, key="id", most=0)
    small = {r.id: sorted(map(tuple, r.hits)) for r in phrases.with_phrases(df, "text", table).collect()}
    assert {r.id: sorted(map(tuple, r.hits)) for r in joined.collect()} == small and sum(map(len, small.values())) > 100
    assert "marked(" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_a_bitmap_has_the_places_given_alone(spark):
    places = [0, 7, 8, phrases.ROW_BITS - 1, phrases.ROW_BITS, phrases.BITS - 1]
    bits = phrases._bitmap(spark.createDataFrame([(p,) for p in places], "bit int"))
    assert len(bits) == phrases.BITS // 8 and sum(b.bit_count() for b in bits) == len(places) and all(bits[p >> 3] >> (p & 7) & 1 for p in places)
