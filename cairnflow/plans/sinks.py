"""Sinks and landed files, written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read
from ..sources import export, publish
from ..sources.shared import new_path
from .catalog import query


@query("published_csv", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus || '|' || o_orderpriority AS labels, o_totalprice, NULL::VARCHAR AS notes FROM orders")
def published_csv(spark, sf_dir):
    """All orders as CSV of a fixed order of fields, published over an earlier version, as a reader gets them."""
    orders = read(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("labels"), F.to_date("o_orderdate").alias("day"))
    path, fields = new_path(spark, "published"), ["o_orderkey", "day", "labels", "o_totalprice", "notes"]
    publish.publish(orders.where("o_orderkey < 0"), path, "csv", fields)
    publish.publish(orders, path, "csv", fields)
    return publish.published(spark, path)


@query("published_lists", "SELECT 'country' AS list, lower(n_name) AS key FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) UNION SELECT 'family', lower(c_mktsegment) FROM customer UNION SELECT 'cve', 'CVE-2021-' || lpad(c_custkey::VARCHAR, 6, '0') FROM customer")
def published_lists(spark, sf_dir):
    """Key lists of all customers, published as JSON lines and read again."""
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    rows = read(spark, sf_dir, "customer").join(nations, "c_nationkey").select(F.lit("").alias("actor"), F.col("c_mktsegment").alias("family"), "country", F.concat(F.lit("cve-2021-"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("cves"))
    path = new_path(spark, "lists")
    publish.publish(export.indicator_lists(rows), path, "json")
    return publish.published(spark, path)


@query(
    "feed_items",
    """
    SELECT 'Order of ' || o_orderpriority || ' & more' AS title, 'http://shop.example/' || o_orderkey AS link, CASE WHEN o_orderkey % 2 = 0 THEN 'order-' || o_orderkey ELSE 'http://shop.example/' || o_orderkey END AS event_key, o_orderstatus || '|' || o_orderpriority AS category,
    CASE o_orderkey % 4 WHEN 2 THEN date_trunc('day', o_orderdate) WHEN 3 THEN NULL ELSE date_trunc('second', o_orderdate) END AS published_at FROM orders
    """,
)
def feed_items(spark, sf_dir):
    """Orders as items of feeds with dates in all their forms, landed as XML files and read as feeds are."""
    form = lambda f: F.date_format("o_orderdate", f)
    kind = F.col("o_orderkey") % 4
    date = F.when(kind == 0, form("EEE, dd MMM yyyy HH:mm:ss Z")).when(kind == 1, form("yyyy-MM-dd'T'HH:mm:ssXXX")).when(kind == 2, form("yyyy-MM-dd")).otherwise("some day")
    link = F.concat(F.lit("http://shop.example/"), "o_orderkey")
    items = read(spark, sf_dir, "orders").select(
        F.concat(F.lit(" Order of "), "o_orderpriority", F.lit(" & more ")).alias("title"), link.alias("link"), date.alias("pubDate"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("order-"), "o_orderkey")).alias("guid"), F.array("o_orderstatus", "o_orderpriority").alias("category")
    )
    path = new_path(spark, "feeds")
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return export.feed_items(spark, path).withColumn("category", F.array_join("category", "|"))
