"""Trends, rankings, running shares and source health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranking import half_window_change, knee, latest_per_key, round_robin, running_share, top_per_group, trend, upper_median, with_change
from ..session import read
from .catalog import query


@query(
    "topk_per_group",
    """
    SELECT p_brand, p_partkey, revenue, rank FROM (
      SELECT p_brand, p_partkey, revenue, row_number() OVER (PARTITION BY p_brand ORDER BY revenue DESC, p_partkey) AS rank FROM (
        SELECT p_brand, p_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE rank <= 3
    """,
)
def topk_per_group(spark, sf_dir):
    """The three best parts of each brand; line items are summed before the join."""
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return top_per_group(sums.join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey"), ["p_brand"], [F.desc("revenue"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "revenue", "rank")


@query(
    "trend_month",
    """
    SELECT date_trunc('month', o_orderdate)::DATE AS bucket, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done,
           count(*) FILTER (WHERE o_totalprice > 150000) AS n_large FROM orders GROUP BY 1
    """,
)
def trend_month(spark, sf_dir):
    return trend(read(spark, sf_dir, "orders"), F.col("o_orderdate"), "month", {"done": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 150000})


@query(
    "trend_change",
    """
    WITH m AS (SELECT date_trunc('quarter', o_orderdate)::DATE AS bucket, count(*) AS n FROM orders GROUP BY 1)
    SELECT bucket, n, lag(n) OVER (ORDER BY bucket) AS previous, round((n - lag(n) OVER (ORDER BY bucket)) * 100.0 / lag(n) OVER (ORDER BY bucket), 4) AS change_pct FROM m
    """,
)
def trend_change(spark, sf_dir):
    """Each quarter against the one before; the window runs over a row per quarter."""
    return with_change(trend(read(spark, sf_dir, "orders"), F.col("o_orderdate"), "quarter", {}), "bucket", "n")


@query(
    "half_window_change",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS bucket, count(*) AS n FROM orders GROUP BY 1),
    p AS (SELECT n, row_number() OVER (ORDER BY bucket) AS nth, count(*) OVER () AS total FROM m),
    s AS (SELECT sum(CASE WHEN nth <= floor((total - 1) / 2) THEN n ELSE 0 END)::BIGINT AS earlier, sum(CASE WHEN nth > floor((total - 1) / 2) THEN n ELSE 0 END)::BIGINT AS later FROM p WHERE nth < total)
    SELECT earlier, later, round((later - earlier) * 100.0 / earlier, 4) AS change_pct FROM s
    """,
)
def half_window(spark, sf_dir):
    return half_window_change(trend(read(spark, sf_dir, "orders"), F.col("o_orderdate"), "month", {}), "bucket", "n")


@query(
    "recent_vs_prior",
    """
    WITH m AS (SELECT max(o_orderdate)::DATE AS d FROM orders)
    SELECT o_orderpriority AS label, count(*) FILTER (WHERE o_orderdate::DATE > d - 90) AS recent, count(*) FILTER (WHERE o_orderdate::DATE > d - 180 AND o_orderdate::DATE <= d - 90) AS prior
    FROM orders, m GROUP BY 1
    """,
)
def recent_vs_prior(spark, sf_dir):
    """The last 90 days against the 90 before, counted from the newest row, not from today."""
    orders = read(spark, sf_dir, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day"))
    age = F.datediff("newest", "day")
    return orders.join(orders.agg(F.max("day").alias("newest"))).groupBy(F.col("o_orderpriority").alias("label")).agg(F.count_if(age < 90).alias("recent"), F.count_if((age >= 90) & (age < 180)).alias("prior"))


@query(
    "feed_health",
    """
    WITH m AS (SELECT max(ts) AS newest FROM events)
    SELECT user_id % 20 AS feed, count(*) AS n, count(*) FILTER (WHERE ts > newest - INTERVAL 7 DAY) AS n_week, count(*) FILTER (WHERE ts > newest - INTERVAL 1 DAY) AS n_day, max(ts) AS last_ts,
           CASE WHEN max(ts) > max(newest) - INTERVAL 1 DAY THEN 'live' WHEN max(ts) > max(newest) - INTERVAL 7 DAY THEN 'slow' ELSE 'stale' END AS status
    FROM events, m GROUP BY 1
    """,
)
def feed_health(spark, sf_dir):
    events = read(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("feed"), "ts")
    day = lambda n: F.col("newest") - F.expr(f"INTERVAL {n} DAY")
    last, newest = F.max("ts"), F.max("newest")
    status = F.when(last > newest - F.expr("INTERVAL 1 DAY"), "live").when(last > newest - F.expr("INTERVAL 7 DAY"), "slow").otherwise("stale")
    return events.join(events.agg(F.max("ts").alias("newest"))).groupBy("feed").agg(F.count("*").alias("n"), F.count_if(F.col("ts") > day(7)).alias("n_week"), F.count_if(F.col("ts") > day(1)).alias("n_day"), last.alias("last_ts"), status.alias("status"))


@query(
    "cumulative_share",
    """
    WITH g AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), r AS (SELECT user_id, n, sum(n) OVER (ORDER BY n DESC, user_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running, sum(n) OVER () AS total FROM g)
    SELECT user_id, n, running, round(running / total, 6) AS share FROM r
    """,
)
def cumulative_share(spark, sf_dir):
    return running_share(read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")), [], [F.desc("n"), F.col("user_id")], "n")


@query(
    "cumulative_knee",
    """
    WITH g AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2),
    r AS (SELECT event_type, day, n, sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING)::BIGINT AS running, sum(n) OVER (PARTITION BY event_type) AS total FROM g)
    SELECT event_type, day, n, running, round(running / total, 6) AS share FROM r WHERE round(running / total, 6) >= 0.95
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day) = 1
    """,
)
def cumulative_knee(spark, sf_dir):
    """The day by which 95 % of a kind's events had come."""
    return knee(read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n")), ["event_type"], [F.col("day")], "n")


@query(
    "latest_per_key",
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1",
)
def latest_event(spark, sf_dir):
    return latest_per_key(read(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query(
    "mode_of_group",
    """
    WITH g AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT p_brand, p_size AS modal_size, n FROM g QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size DESC) = 1
    """,
)
def mode_of_group(spark, sf_dir):
    """The commonest value of each group, ties to the larger one."""
    counts = read(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", "p_size"))
    return counts.groupBy("p_brand").agg(best.alias("b")).select("p_brand", F.col("b.p_size").alias("modal_size"), F.col("b.n").alias("n"))


@query(
    "upper_median",
    "SELECT c_mktsegment, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS nth, count(*) OVER (PARTITION BY c_mktsegment) AS total FROM customer) WHERE nth = total // 2 + 1",
)
def upper_median_row(spark, sf_dir):
    """The upper middle row of each group, an element and not a mean."""
    return upper_median(read(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "c_custkey").select("c_mktsegment", "c_custkey", "c_acctbal")


@query(
    "review_sample",
    """
    SELECT p_brand, p_partkey, turn FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS turn FROM part)
    ORDER BY turn, p_brand LIMIT 60
    """,
)
def review_sample(spark, sf_dir):
    return round_robin(read(spark, sf_dir, "part"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 60).select("p_brand", "p_partkey", "turn")


@query(
    "source_health",
    """
    WITH d AS (SELECT source, count(*) AS docs, count(DISTINCT lang) AS langs, max(n_chars) AS longest FROM documents GROUP BY 1),
    l AS (SELECT source, count(*) AS labelled, sum(toxic)::BIGINT AS toxic, sum(quality)::BIGINT AS good FROM labels JOIN documents USING (doc_id) GROUP BY 1)
    SELECT source, docs, langs, longest, coalesce(labelled, 0) AS labelled, coalesce(toxic, 0) AS toxic, coalesce(good, 0) AS good FROM d LEFT JOIN l USING (source)
    """,
)
def source_health(spark, sf_dir):
    """Children are counted by source before they meet, so no join multiplies rows."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    own = docs.groupBy("source").agg(F.count("*").alias("docs"), F.count_distinct("lang").alias("langs"), F.max("n_chars").alias("longest"))
    labels = read(spark, sf_dir, "labels").join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count("*").alias("labelled"), F.sum("toxic").cast("long").alias("toxic"), F.sum("quality").cast("long").alias("good"))
    return own.join(labels, "source", "left").fillna(0, ["labelled", "toxic", "good"])


@query(
    "backlog",
    "SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS state, count(*) AS n, max(ts) AS latest FROM events GROUP BY 1, 2",
)
def backlog(spark, sf_dir):
    """Tasks by type and state, the state read from JSON."""
    return read(spark, sf_dir, "events").groupBy("event_type", (F.get_json_object("props", "$.k").cast("long") % 3).alias("state")).agg(F.count("*").alias("n"), F.max("ts").alias("latest"))


@query(
    "metrics_merge",
    """
    SELECT event_type AS metric, count(*) AS hist_count, round(sum(value), 4) AS hist_sum, min(value) AS hist_min, max(value) AS hist_max,
           event_type || '_sum{kind="event"}' AS metric_key FROM events GROUP BY 1
    """,
)
def metrics_merge(spark, sf_dir):
    """Histogram states of single days, merged: count, sum, min and max add up."""
    days = read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("c"), F.sum("value").alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return days.groupBy(F.col("event_type").alias("metric")).agg(F.sum("c").alias("hist_count"), F.round(F.sum("s"), 4).alias("hist_sum"), F.min("lo").alias("hist_min"), F.max("hi").alias("hist_max")).withColumn("metric_key", F.format_string('%s_sum{kind="event"}', "metric"))
