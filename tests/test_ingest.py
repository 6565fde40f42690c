"""The six steps of ingest on hand-made landings: rejected, late, repeated, by url, by name and day, new; and batches run again."""

from __future__ import annotations

import datetime

from cairnflow.sources.shared import move, new_path
from cairnflow.streaming import ingest

SCHEMA = "event_id long, url string, name string, ts timestamp"


def at(day, hour=0):
    return datetime.datetime(2024, 5, day, hour)


BATCHES = [
    [(1, "u1", "Lake", at(10)), (1, "u1", "Lake", at(10)), (2, "u2", "Lake", at(10, 5)), (3, "u3", "Hill", at(11)), (4, None, "Hill", at(12)), (None, "u9", "x", at(1)), (5, "u9", " ", at(1)), (6, "u9", "x", None)],
    [(1, "u1", "Lake", at(10)), (7, "u1", "Other name", at(12)), (8, "u8", "Lake", at(10, 9)), (9, "u7", "Lake", at(3)), (10, "u10", "New", at(20)), (11, "u10", "Newer", at(20)), (12, "u12", "Newer", at(20))],
    [(13, "u8", "Zed", at(19)), (14, None, None, None)],
    [],
]


def run(spark, base, epochs):
    for epoch in epochs:
        ingest.step(spark.createDataFrame(BATCHES[epoch], SCHEMA), epoch, base)
    return {r.event_id: (r.incident_id, r.step) for r in ingest.store(spark, base, "accepted").collect()}


def test_steps_and_batches_run_again(spark):
    base = new_path(spark, "ingest-test")
    want = {1: (1, "new"), 2: (1, "new"), 3: (3, "new"), 4: (4, "new"), 7: (1, "url"), 8: (1, "name_date"), 10: (10, "new"), 11: (10, "new"), 12: (12, "new"), 13: (1, "url")}
    assert run(spark, base, range(4)) == want
    assert run(spark, base, [2, 1, 3]) == want  # a batch that is run again decides as it did
    assert sorted(r.event_id for r in ingest.store(spark, base, "late").collect()) == [9]
    assert sorted((r.event_id or 0) for r in ingest.store(spark, base, "rejected").collect()) == [0, 5, 6, 14]
    got = {r.incident_id: (r.events, r.urls, r.first_ts) for r in ingest.incidents(spark, base).collect()}
    assert got[1] == (5, 3, at(10)) and got[10] == (2, 1, at(20)) and got[12] == (1, 1, at(20))


def test_empty_store(spark):
    base = new_path(spark, "ingest-none")
    assert ingest.incidents(spark, base).count() == 0 and ingest.store(spark, base, "late").count() == 0


def test_a_part_is_one_file_whatever_the_tasks(spark):
    """Every task once wrote a file of its own into each part, so that files grew with tasks times parts."""
    base = new_path(spark, "ingest-files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for epoch in (0, 1):
            rows = spark.range(600).selectExpr(f"id + {400 * epoch} AS event_id", "concat('u', event_id) AS url", "concat('n', event_id DIV 2) AS name", "TIMESTAMP '2024-05-10' AS ts")
            ingest.step(rows, epoch, base)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("events", "urls", "names"):
        files = ingest.store(spark, base, name).inputFiles()
        assert len({f.rsplit("/", 1)[0] for f in files}) > ingest.BUCKETS and len(files) == len({f.rsplit("/", 1)[0] for f in files}), name
    got = ingest.incidents(spark, base).collect()
    assert sorted((r.incident_id, r.events, r.urls) for r in got) == [(k, 2, 2) for k in range(0, 1000, 2)]


def test_what_is_known_adds_no_rows(spark):
    """Known events, urls and names meet the batch as rows of its groups; what the batch does not name stays out of it."""
    base = new_path(spark, "ingest-known")
    ingest.step(spark.createDataFrame([(1, "u1", "Lake", at(10)), (2, "u2", "Hill", at(10)), (3, "u3", "Wood", at(10))], SCHEMA), 0, base)
    ingest.step(spark.createDataFrame([(1, "u1", "Lake", at(10)), (4, "u2", "Zed", at(11)), (5, "u5", "Wood", at(10)), (6, "u5", "Wood", at(10)), (6, "u5", "Wood", at(10, 1))], SCHEMA), 1, base)
    got = sorted((r.event_id, r.incident_id, r.step, r.ts.hour) for r in ingest.store(spark, base, "accepted").collect())
    assert got == [(1, 1, "new", 0), (2, 2, "new", 0), (3, 3, "new", 0), (4, 2, "url", 0), (5, 3, "name_date", 0), (6, 3, "name_date", 0)]
    assert sorted((r.url, r.incident_id) for r in ingest.store(spark, base, "urls").collect()) == [("u1", 1), ("u2", 2), ("u3", 3), ("u5", 3)]
    assert sorted((r.name, r.incident_id) for r in ingest.store(spark, base, "names").collect()) == [("Hill", 2), ("Lake", 1), ("Wood", 3)]


def test_moved_folders(spark):
    base = new_path(spark, "moves")
    spark.range(3).write.parquet(f"{base}/from/k=0")
    move(spark, f"{base}/from/k=0", f"{base}/to/k=0")
    move(spark, f"{base}/from/k=1", f"{base}/to/k=1")
    assert spark.read.parquet(f"{base}/to/k=0").count() == 3 and spark.read.schema("id long").parquet(f"{base}/to/k=1").count() == 0
