"""Breakdowns, rollups, facets and matrices over orders, line items and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregate import breakdown, facets, matrix, profile, rates, summary, unpivot_flags
from ..operators.filters import FilterSpec, apply_filters, live, orphans, ranked
from ..operators.ranking import page
from ..session import read
from .catalog import query


def _located(spark, sf_dir):
    """Orders with customer, nation and region."""
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return read(spark, sf_dir, "orders").join(customers, "o_custkey").join(nations, "c_nationkey").join(read(spark, sf_dir, "region"), "r_regionkey")


LOCATED = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    "breakdown_share",
    """
    SELECT n_name AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def breakdown_share(spark, sf_dir):
    """Orders by the customer's nation, with each nation's share of all."""
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    per_customer = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    located = per_customer.join(read(spark, sf_dir, "customer"), "c_custkey").join(nations, "c_nationkey")
    return breakdown(located, "n_name", weight="orders")


@query(
    "breakdown_top",
    """
    SELECT p_type AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct
    FROM part GROUP BY p_type ORDER BY n DESC, label LIMIT 12
    """,
)
def breakdown_top(spark, sf_dir):
    return breakdown(read(spark, sf_dir, "part"), "p_type", limit=12)


@query(
    "breakdown_folded",
    """
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'Other' END AS label, count(*) AS n,
           round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct
    FROM orders GROUP BY 1
    """,
)
def breakdown_folded(spark, sf_dir):
    """Minor labels folded into one before counting."""
    return breakdown(read(spark, sf_dir, "orders"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority")).otherwise("Other"))


@query(
    "filtered_page",
    """
    SELECT o_orderkey, c_name, o_totalprice, o_orderdate::DATE AS day FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_totalprice >= 1000 AND o_orderdate::DATE >= DATE '1996-01-01'
      AND contains(lower(c_name), '1')
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey OFFSET 20 LIMIT 25
    """,
)
def filtered_page(spark, sf_dir):
    """The list request: filters, text search, total order, one page."""
    rows = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")).join(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    spec = FilterSpec(any_of={"o_orderpriority": ["1-URGENT", "3-MEDIUM"]}, at_least={"o_totalprice": 1000, "day": F.lit("1996-01-01").cast("date")}, search="1", search_in=("c_name",))
    return page(apply_filters(rows, spec), [F.desc_nulls_last("o_totalprice"), F.col("o_orderkey")], 20, 25).select("o_orderkey", "c_name", "o_totalprice", "day")


@query(
    "filtered_count",
    "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 5000 AND 200000 AND o_orderpriority IS NOT NULL",
)
def filtered_count(spark, sf_dir):
    spec = FilterSpec(equal={"o_orderstatus": "F"}, at_least={"o_totalprice": 5000}, at_most={"o_totalprice": 200000}, present={"o_orderpriority": True})
    return apply_filters(read(spark, sf_dir, "orders"), spec).agg(F.count("*").alias("n"))


@query(
    "severity_sort",
    """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 1 ELSE 0 END AS severity
    FROM orders ORDER BY severity DESC, o_orderdate DESC NULLS LAST, o_orderkey LIMIT 50
    """,
)
def severity_sort(spark, sf_dir):
    severity = ranked(F.col("o_orderpriority"), {"1-urgent": 4, "2-high": 3, "3-medium": 2, "5-low": 1})
    return page(read(spark, sf_dir, "orders").withColumn("severity", severity), [F.desc("severity"), F.desc_nulls_last("o_orderdate"), F.col("o_orderkey")], 0, 50).select("o_orderkey", "severity")


@query("semi_live", "SELECT source, count(*) AS n FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def semi_live(spark, sf_dir):
    return live(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))


@query("anti_orphans", "SELECT source, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def anti_orphans(spark, sf_dir):
    return orphans(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))


@query(
    "kpi_rollup",
    """
    SELECT count(*) AS lines, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers,
           count(*) FILTER (WHERE l_returnflag = 'R') AS returned, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           round(avg(CASE WHEN l_discount > 0 THEN l_discount END), 6) AS mean_discount, max(l_quantity) AS most
    FROM lineitem
    """,
)
def kpi_rollup(spark, sf_dir):
    """Eight figures of one pass."""
    return read(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("lines"),
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg(F.when(F.col("l_discount") > 0, F.col("l_discount"))), 6).alias("mean_discount"),
        F.max("l_quantity").alias("most"),
    )


@query(
    "ratio_by_year",
    """
    SELECT year(o_orderdate) AS year, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done,
           round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS done_rate
    FROM orders GROUP BY 1 HAVING count(*) >= 10
    """,
)
def ratio_by_year(spark, sf_dir):
    return rates(read(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("long")), ["year"], {"done": F.col("o_orderstatus") == "F"}).where("n >= 10")


@query(
    "finance_by_year",
    """
    SELECT year(l_shipdate) AS year, round(sum(l_extendedprice), 2) AS gross, round(sum(l_extendedprice * l_discount), 2) AS rebate,
           round(sum(l_extendedprice * (1 - l_discount) * l_tax), 2) AS tax, count(*) FILTER (WHERE l_discount > 0.05) AS n_rebated
    FROM lineitem GROUP BY 1
    """,
)
def finance_by_year(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").cast("long").alias("year")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("gross"),
        F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("rebate"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * F.col("l_tax")), 2).alias("tax"),
        F.count_if(F.col("l_discount") > 0.05).alias("n_rebated"),
    )


@query(
    "fallback_average",
    """
    SELECT l_returnflag AS flag, round(avg(CASE WHEN l_discount > 0.08 THEN l_discount * 100 WHEN l_tax > 0.04 THEN l_tax * 100 WHEN l_quantity > 40 THEN l_quantity END), 6) AS mean,
           count(*) AS n FROM lineitem GROUP BY 1
    """,
)
def fallback_average(spark, sf_dir):
    """The mean of the first figure that is known."""
    value = F.coalesce(F.when(F.col("l_discount") > 0.08, F.col("l_discount") * 100), F.when(F.col("l_tax") > 0.04, F.col("l_tax") * 100), F.when(F.col("l_quantity") > 40, F.col("l_quantity")))
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(F.round(F.avg(value), 6).alias("mean"), F.count("*").alias("n"))


@query(
    "unpivot_flags",
    """
    SELECT * FROM (
      SELECT 'returned' AS label, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem
      UNION ALL SELECT 'open', count(*) FILTER (WHERE l_linestatus = 'O') FROM lineitem
      UNION ALL SELECT 'bulk', count(*) FILTER (WHERE l_quantity >= 45) FROM lineitem
      UNION ALL SELECT 'free', count(*) FILTER (WHERE l_extendedprice < 0) FROM lineitem) WHERE n > 0
    """,
)
def unpivot(spark, sf_dir):
    return unpivot_flags(read(spark, sf_dir, "lineitem"), {"returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O", "bulk": F.col("l_quantity") >= 45, "free": F.col("l_extendedprice") < 0})


@query(
    "cross_matrix",
    f"""
    WITH c AS (SELECT n_name AS r, o_orderpriority AS k, count(*) AS n FROM {LOCATED} GROUP BY 1, 2),
    tr AS (SELECT r FROM c GROUP BY r ORDER BY sum(n) DESC, r LIMIT 6), tk AS (SELECT k FROM c GROUP BY k ORDER BY sum(n) DESC, k LIMIT 3)
    SELECT r AS "row", k AS "column", n FROM c WHERE r IN (SELECT r FROM tr) AND k IN (SELECT k FROM tk)
    """,
)
def cross_matrix(spark, sf_dir):
    """The top six nations by the top three priorities."""
    return matrix(_located(spark, sf_dir), "n_name", "o_orderpriority", 6, 3)


@query(
    "risk_matrix",
    "SELECT p_brand AS brand, p_size AS size, count(*) AS n, round(avg(p_retailprice), 4) AS mean_price FROM part GROUP BY 1, 2 HAVING count(*) >= 2",
)
def risk_matrix(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean_price")).where("n >= 2")


@query(
    "facets_grouping_sets",
    f"""
    SELECT CASE WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment' WHEN grouping(o_orderstatus) = 0 THEN 'o_orderstatus' WHEN grouping(n_name) = 0 THEN 'n_name' ELSE 'o_orderpriority' END AS facet,
           coalesce(c_mktsegment, o_orderstatus, n_name, o_orderpriority) AS value, count(*) AS n
    FROM {LOCATED} GROUP BY GROUPING SETS ((c_mktsegment), (o_orderstatus), (n_name), (o_orderpriority))
    """,
)
def facets_grouping_sets(spark, sf_dir):
    """Four facets of one scan."""
    return facets(_located(spark, sf_dir), ["c_mktsegment", "o_orderstatus", "n_name", "o_orderpriority"])


@query(
    "rollup_geo",
    f"""
    SELECT r_name AS region, n_name AS nation, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {LOCATED} GROUP BY ROLLUP (r_name, n_name)
    """,
)
def rollup_geo(spark, sf_dir):
    return _located(spark, sf_dir).rollup(F.col("r_name").alias("region"), F.col("n_name").alias("nation")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("cube_status", "SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_status(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").cube(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"))


@query(
    "actor_profile",
    """
    SELECT user_id, count(*) AS n, min(ts)::DATE AS first_seen, max(ts)::DATE AS last_seen, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS event_type_set
    FROM events GROUP BY user_id
    """,
)
def actor_profile(spark, sf_dir):
    """Per actor: count, first and last day, sorted set of kinds."""
    return profile(read(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), "user_id", "day", ["event_type"])


@query(
    "latency_summary",
    """
    SELECT event_type, count(value) AS n, round(coalesce(avg(value), 0), 6) AS mean, round(coalesce(quantile_cont(value, 0.5), 0), 6) AS p50,
           round(coalesce(quantile_cont(value, 0.9), 0), 6) AS p90, round(coalesce(quantile_cont(value, 0.95), 0), 6) AS p95, round(coalesce(quantile_cont(value, 0.99), 0), 6) AS p99,
           round(coalesce(min(value), 0), 6) AS low, round(coalesce(max(value), 0), 6) AS high FROM events GROUP BY 1
    """,
)
def latency_summary(spark, sf_dir):
    return summary(read(spark, sf_dir, "events"), ["event_type"], "value")


@query(
    "dashboard_stats",
    """
    SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT c_nationkey) FROM customer) AS nations,
           (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')) AS with_returns,
           (SELECT round(avg(o_totalprice), 4) FROM orders WHERE o_totalprice > 0) AS mean_price
    """,
)
def dashboard_stats(spark, sf_dir):
    """Figures of several tables in one row; the returned orders are found by a semi-join."""
    orders = read(spark, sf_dir, "orders")
    returned = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    one = orders.agg(F.count("*").alias("orders"), F.round(F.avg(F.when(F.col("o_totalprice") > 0, F.col("o_totalprice"))), 4).alias("mean_price"))
    return one.join(read(spark, sf_dir, "customer").agg(F.count_distinct("c_nationkey").alias("nations"))).join(orders.join(returned, "o_orderkey", "left_semi").agg(F.count("*").alias("with_returns"))).select("orders", "nations", "with_returns", "mean_price")


@query(
    "filter_options",
    """
    SELECT 'segment' AS facet, c_mktsegment AS value FROM customer WHERE trim(c_mktsegment) <> '' UNION SELECT 'type', p_type FROM part
    UNION SELECT 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders UNION SELECT 'nation', n_name FROM nation JOIN customer ON c_nationkey = n_nationkey
    UNION SELECT 'nation', n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey
    """,
)
def filter_options(spark, sf_dir):
    """The distinct values that each filter offers; nations come from two tables."""
    nation = read(spark, sf_dir, "nation")
    of = lambda df, facet, c: df.select(F.lit(facet).alias("facet"), c.cast("string").alias("value"))
    used = lambda t, k: nation.join(read(spark, sf_dir, t).select(F.col(k).alias("n_nationkey")), "n_nationkey", "left_semi")
    parts = [of(read(spark, sf_dir, "customer"), "segment", F.col("c_mktsegment")), of(read(spark, sf_dir, "part"), "type", F.col("p_type")), of(read(spark, sf_dir, "orders"), "year", F.year("o_orderdate")), of(used("customer", "c_nationkey"), "nation", F.col("n_name")), of(used("supplier", "s_nationkey"), "nation", F.col("n_name"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where("trim(value) <> ''").distinct()


@query("set_union", "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_union(spark, sf_dir):
    return read(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).union(read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select("s_nationkey")).distinct()


@query("set_intersect", "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_intersect(spark, sf_dir):
    return read(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("set_except", "SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000")
def set_except(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).subtract(read(spark, sf_dir, "supplier").where("s_acctbal > 7000").select("s_nationkey"))
