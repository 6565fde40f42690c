"""Indicators are looked for only in words that may hold one."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from cairnflow.functions import text as tx

SHAPE = r"""[^\s<>"'(),;]*(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[0-9a-fA-F]{32,128}|https?://[^\s<>"']+"""


def test_indicators_of_the_words_kept_are_those_of_the_text(spark):
    draw = random.Random(4)
    bits = ["1.2.3.4", "x(9.8.7.6)", "a@b.org", "(a@b.org,c@d.net)", "http://a.b/c?d=1.1.1.1", "see", "3.14", "end.", "f" * 32, "0a" * 70, "\x0b", " ", "\t", "\n", "1.2.3", "x" * 40, "@", "://", ",", "http://u,v;w"]
    rows = [(k, "".join(draw.choice(bits) + draw.choice(["", " ", "\n"]) for _ in range(draw.randint(0, 25)))) for k in range(300)] + [(300, None)]
    found = lambda c: F.regexp_extract_all(c, F.lit(SHAPE), F.lit(0))
    got = spark.createDataFrame(rows, "id long, text string").select(found(F.col("text")).alias("whole"), found(tx.indicator_words(F.col("text"))).alias("kept")).collect()
    assert all(r.whole == r.kept for r in got) and sum(len(r.whole or ()) for r in got) > 300


def test_a_long_word_without_indicators_is_not_searched(spark):
    df = spark.createDataFrame([("z" * 300_000,)], "text string").select(F.regexp_extract_all(tx.indicator_words(F.col("text")), F.lit(SHAPE), F.lit(0)).alias("v"))
    began = time.time()
    assert df.first().v == [] and time.time() - began < 20
