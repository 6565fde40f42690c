"""Every query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import difflib
import glob
import math
import os
import re

import duckdb
import pytest

from cairnflow.plans import load

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CATALOG = load()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def names_by_hand(sql):
    """All pairs of suppliers of one nation, compared as they are."""
    rows = [(k, n, re.sub("[^a-z0-9]+", " ", name.lower()).strip()) for k, n, name in sql.execute("SELECT s_suppkey, s_nationkey, s_name FROM supplier").fetchall()]
    out = []
    for a, an, at in rows:
        for b, bn, bt in rows:
            if a < b and an == bn:
                aw, bw = ({w for w in t.split() if len(w) > 1} for t in (at, bt))
                few, many = sorted((len(aw), len(bw)))
                alike = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
                ratio = 100 * max(alike(at, bt), alike(" ".join(sorted(at.split())), " ".join(sorted(bt.split()))))
                route = "equal" if at == bt else "words" if aw == bw else "subset" if len(aw & bw) == few >= 2 and few / many >= 0.7 else "alike" if ratio >= 93 else None
                if route:
                    out.append((a, b, route))
    return sorted(out, key=repr)


BRUTE = {"name_match": names_by_hand}


@pytest.mark.parametrize("name", sorted(CATALOG.PLANS))
def test_query_equals_sql(spark, sql, name):
    df = CATALOG.PLANS[name](spark, FOLDER)
    rows = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    if name not in CATALOG.SQL:
        assert name in BRUTE, "a query without SQL needs a brute-force version"
        assert rows == BRUTE[name](sql)
        return
    found = sql.execute(CATALOG.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    assert rows == sorted((tuple(plain(r[k]) for k in order) for r in found.fetchall()), key=repr)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
