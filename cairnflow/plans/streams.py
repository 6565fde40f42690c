"""Streaming queries, each with the batch SQL that it must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read as ev_read
from ..sources.shared import move, new_path
from ..streaming import events as ev
from ..streaming import ingest as take
from .catalog import query


@query("stream_tumbling", "SELECT time_bucket(INTERVAL 1 DAY, ts)::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, sf_dir):
    days = ev.tumbling(ev.event_stream(spark, sf_dir, "events", "ts"), "ts", "1 day", ["event_type"], "7 days")
    return ev.drain(days, "update", "tumbling", ["window_start", "event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_sliding",
    """
    SELECT CAST(d AS TIMESTAMP) AS window_start, count(*) AS n FROM events, LATERAL (SELECT unnest([ts::DATE - k::INTEGER FOR k IN range(7)]) AS d) GROUP BY 1
    """,
)
def stream_sliding(spark, sf_dir):
    weeks = ev.sliding(ev.event_stream(spark, sf_dir, "events", "ts"), "ts", "7 days", "1 day", "14 days")
    return ev.drain(weeks, "update", "sliding", ["window_start"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_sessions",
    """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM g)
    SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, nth
    """,
)
def stream_sessions(spark, sf_dir):
    """Appended as the watermark passes them; the rest in a second run from the same checkpoint, once the stream is closed."""
    closing, out, checkpoint = (new_path(spark, f"sessions-{x}") for x in ("closing", "table", "checkpoint"))
    runs = ev.sessions(ev.event_stream(spark, sf_dir, "events", "ts", closing=closing), "ts", "6 hours", "user_id", "7 days")
    ev.run(runs, "append", out, checkpoint)
    ev.close(spark, sf_dir, "events", "ts", closing)
    return ev.run(runs, "append", out, checkpoint).withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))


@query("stream_dedup", "SELECT event_id, event_type, user_id FROM events")
def stream_dedup(spark, sf_dir):
    """Every event id once, though every row arrives twice."""
    rows = ev.event_stream(spark, sf_dir, "events", "ts")
    once = ev.first_seen(rows.unionByName(ev.event_stream(spark, sf_dir, "events", "ts")), "ts", ["event_id"], "60 days")
    return ev.drain(once.select("event_id", "event_type", "user_id"), "append", "dedup")


@query("stream_merge", "SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def stream_merge(spark, sf_dir):
    """Counts kept up to date from mergeable states: a batch adds its own, and reading merges them."""

    def state(batch):
        return batch.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))

    parts = ev.states(ev.event_stream(spark, sf_dir, "events", "ts", 1), "merged", state)
    table = parts.groupBy("user_id", "event_type").agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    out = table.groupBy("user_id").agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.count("*").alias("kinds"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query("stream_upsert", "SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1")
def stream_upsert(spark, sf_dir):
    """A keyed table that every batch is merged into; the second run finds its checkpoint and adds nothing."""

    def merge(current, batch):
        fresh = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))
        both = fresh if current is None else current.unionByName(fresh)
        return both.groupBy("user_id").agg(F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"))

    out, checkpoint = new_path(spark, "upserts"), new_path(spark, "upserts-checkpoint")
    for _ in range(2):
        table = ev.merge_into(ev.event_stream(spark, sf_dir, "events", "ts", 1), "upserts", merge, out, checkpoint)
    return table.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))


def _landed(spark, sf_dir):
    """Events in three landings, some of the first coming with the last, and some of the second coming twice; all taken in."""
    events = ev_read(spark, sf_dir, "events")
    third = F.floor(F.col("event_id") * 3 / (events.agg(F.max("event_id")).first()[0] + 1))
    rows = events.select("event_id", F.concat_ws("-", F.lit("u"), "user_id", F.to_date("ts").cast("string"), "event_type").alias("url"), F.concat(F.lit("user "), "user_id").alias("name"), F.col("ts").cast("timestamp").alias("ts"), third.alias("k"))
    behind = (F.col("k") == 0) & (F.col("event_id") % 50 == 0)
    again = (F.col("k") == 1) & (F.col("event_id") % 20 == 0)
    base, landing, feed = (new_path(spark, x) for x in ("ingest", "landing", "feed"))
    # All landings are written in one pass, in files of a size that is read side by side; then one after the other is moved in.
    landed = rows.withColumn("k", F.explode(F.when(behind, F.array(F.lit(2))).when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.col("k").cast("int")))))
    landed.write.option("maxRecordsPerFile", 200_000).partitionBy("k").parquet(feed)
    for k in range(3):
        move(spark, f"{feed}/k={k}", f"{landing}/k={k}")
        take.ingest(spark.readStream.schema("event_id long, url string, name string, ts timestamp").parquet(landing), base, "2 days")
    return base


_TAKEN = """
    WITH r AS (SELECT *, event_id * 3 // (max(event_id) OVER () + 1) AS k FROM events),
    a AS (SELECT *, CASE WHEN k = 0 AND event_id % 50 = 0 THEN 2 ELSE k END AS landing FROM r UNION ALL SELECT *, 2 FROM r WHERE k = 1 AND event_id % 20 = 0),
    h AS (SELECT 1 AS landing, max(ts) AS high FROM a WHERE landing = 0 UNION ALL SELECT 2, max(ts) FROM a WHERE landing < 2),
    l AS (SELECT a.*, coalesce(ts < high - INTERVAL 2 DAY, FALSE) AS late FROM a LEFT JOIN h USING (landing)),
    t AS (SELECT event_id, min(landing) AS landing, any_value(ts) AS ts, any_value(user_id) AS user_id, any_value(event_type) AS event_type FROM l WHERE NOT late GROUP BY 1)
"""


@query("stream_ingest", _TAKEN + ", f AS (SELECT *, min(landing) OVER (PARTITION BY user_id, ts::DATE) AS born FROM t) SELECT min(event_id) FILTER (landing = born) AS incident_id, count(*) AS events, count(DISTINCT event_type) AS urls, min(ts) AS first_ts FROM f GROUP BY user_id, ts::DATE")
def stream_ingest(spark, sf_dir):
    """Incidents that three landings leave, merged by event, url, or name and day."""
    return take.incidents(spark, _landed(spark, sf_dir)).withColumn("first_ts", F.col("first_ts").cast("timestamp_ntz"))


@query("stream_late", _TAKEN + "SELECT event_id, ts, count(*) AS times FROM l WHERE late GROUP BY 1, 2")
def stream_late(spark, sf_dir):
    """Events that came later than the watermark allows, set aside."""
    late = take.store(spark, _landed(spark, sf_dir), "late")
    return late.groupBy("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("times"))
