"""Published versions: whole or absent, typed, in a fixed order of fields; and medians of hard groups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cairnflow.operators.ranking import upper_median
from cairnflow.sources import export, publish
from cairnflow.sources.shared import new_path

ROWS = [(1, 'a "quoted", text\nof two lines', ["x", "y"], {"k": 1.5}), (2, None, None, None), (3, "", [], {}), (3, "", [], {})]


@pytest.mark.parametrize("form", publish.FORMS)
def test_versions_are_read_as_written(spark, form):
    path = new_path(spark, "publish")
    df = spark.createDataFrame(ROWS, "id int, t string, tags array<string>, m map<string,double>")
    assert publish.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        publish.published(spark, path)
    assert publish.publish(df, path, form, ["t", "id", "tags", "extra"]) == 1 and publish.publish(df.limit(0), path, form) == 2
    first, second = publish.published(spark, path, 1), publish.published(spark, path)
    assert first.columns == ["t", "id", "tags", "extra"] and second.count() == 0
    got = sorted((r.id, r.t or None, r.extra) for r in first.collect())
    assert got == sorted(((k, t or None, None) for k, t, *_ in ROWS), key=lambda r: r[0])
    assert publish.manifest(spark, path, 1)["rows"] == 4 and publish.versions(spark, path) == [1, 2]
    with pytest.raises(FileExistsError):
        publish.publish(df, path, form, version=2)
    with pytest.raises(ValueError, match="format"):
        publish.publish(df, path, "xls")


def test_metric_labels_are_escaped(spark):
    rows = spark.createDataFrame([("n", 'a"b\\c\nd', 1)], "name string, label string, value int")
    assert export.prometheus(rows).first().value == 'n{source="a\\"b\\\\c\\nd"} 1'


def test_upper_medians_of_ties_and_nulls(spark):
    rows = [("a", 1.0, k) for k in range(40)] + [("a", 2.0, 99), ("b", 5.0, 1), ("c", None, 1), (None, 1.0, 1), ("d", 1.0, 1), ("d", 2.0, 2)] + [("e", float(k), k) for k in range(1001)]
    got = {r.g: (r.v, r.t) for r in upper_median(spark.createDataFrame(rows, "g string, v double, t int").withColumn("n", F.lit(0)), "g", "v", "t").collect()}
    assert got == {"a": (1.0, 20), "b": (5.0, 1), "d": (2.0, 2), "e": (500.0, 500)}
