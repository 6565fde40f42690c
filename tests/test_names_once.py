"""Identity of names, judged once for all rows that bear them."""

from __future__ import annotations

from cairnflow.operators import resolution


def test_names_are_judged_once(spark):
    """A name of many observations is a candidate once, and every one of them finds its record."""
    seen = spark.createDataFrame([(k, "Lake College", None, None, None, None, None) for k in range(50)], "source_id long, name string, day date, country string, category string, family string, actor string")
    records = spark.createDataFrame([(7, "Lake College", None, None, None, None, None), (5, "Hill School", None, None, None, None, None)], "canonical_id long, name string, day date, country string, category string, family string, actor string")
    sizes, real = [], resolution.name_candidates

    def counted(left, right):
        sizes.append((left.count(), right.count()))
        return real(left, right)

    resolution.name_candidates = counted
    try:
        got = resolution.find_existing(seen, records).collect()
    finally:
        resolution.name_candidates = real
    assert sizes == [(1, 2)] and {(r.source_id, r.canonical_id, r.match_type, r.score) for r in got} == {(k, 7, "name_date", 104) for k in range(50)}
