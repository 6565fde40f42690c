"""Choices kept up to date, nested documents, vendors as written, chain graphs, hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vendors
from ..operators import campaigns, changes, nested
from ..session import read
from ..sources.shared import grows, new_path
from .catalog import query


@query(
    "reselected",
    """
    WITH o AS (SELECT o_custkey AS record, o_orderkey AS member, o_totalprice AS score, year(o_orderdate) % 3 AS step FROM orders),
    v AS (SELECT * FROM o WHERE NOT (step < 2 AND member % 11 = 0))
    SELECT r.record, member, score FROM (SELECT DISTINCT record FROM o) r LEFT JOIN (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY record ORDER BY score DESC, step, member) = 1) USING (record)
    """,
)
def reselected(spark, sf_dir):
    """Each customer's dearest order, brought up to date in two steps: orders come, and then others come and some of the first are void."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record"), F.col("o_orderkey").alias("member"), F.col("o_totalprice").alias("score"), (F.year("o_orderdate") % 3).alias("step"))
    stage = lambda k: orders.where(F.col("step") == k).select("record", "member", "score", F.lit(True).alias("valid"))
    void = orders.where((F.col("step") < 2) & (F.col("member") % 11 == 0)).select("record", "member", "score", F.lit(False).alias("valid"))
    path = new_path(spark, "selection")
    changes.start(stage(0), path)
    changes.change(spark, path, stage(1), 1)
    changes.change(spark, path, stage(2).unionByName(void), 2)
    return changes.selected(spark, path)


def _layers(spark, sf_dir):
    """Every order told by two documents: its own, which lacks some parts, and its customer's."""
    orders = read(spark, sf_dir, "orders")
    customers = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    third = F.col("o_orderkey") % 3
    own = F.to_json(F.struct(F.struct(F.col("o_custkey").alias("id"), F.when(third == 0, F.col("o_orderstatus")).alias("state")).alias("who"), F.struct(F.struct(F.col("o_orderpriority").alias("priority")).alias("how"), F.array("o_orderstatus", "o_orderpriority").alias("tags")).alias("what")))
    theirs = F.to_json(F.struct(F.struct((F.col("o_custkey") + 1).alias("id"), F.col("c_mktsegment").alias("state"), F.struct(F.col("c_nationkey").alias("nation")).alias("place")).alias("who"), F.struct(F.struct(F.lit("x").alias("priority"), F.col("c_name").alias("name")).alias("how"), F.array(F.col("o_orderpriority"), F.col("c_mktsegment")).alias("tags")).alias("what")))
    # Dealt by order before the documents are written, so that nothing is dealt again; by number, as these few bytes are much work and are not to be put together.
    met = orders.join(grows(customers), "o_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    said = lambda rank, source, doc: F.struct(F.lit(rank).alias("rank"), F.lit(source).alias("source"), doc.alias("doc"))
    return met.select("o_orderkey", F.inline(F.array(said(1, "order", own), said(2, "customer", theirs))))


@query(
    "nested_merge",
    """
    WITH m AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey), q AS (SELECT *, '"' || o_orderstatus || '"' AS s, '"' || o_orderpriority || '"' AS p, '"' || c_mktsegment || '"' AS g FROM m)
    SELECT o_orderkey, 'who.id' AS path, o_custkey::VARCHAR AS value, 'order' AS sources FROM q
    UNION ALL SELECT o_orderkey, 'who.state', CASE WHEN o_orderkey % 3 = 0 THEN s ELSE g END, CASE WHEN o_orderkey % 3 = 0 THEN 'order' ELSE 'customer' END FROM q
    UNION ALL SELECT o_orderkey, 'who.place.nation', c_nationkey::VARCHAR, 'customer' FROM q
    UNION ALL SELECT o_orderkey, 'what.how.priority', p, 'order' FROM q
    UNION ALL SELECT o_orderkey, 'what.how.name', '"' || c_name || '"', 'customer' FROM q
    UNION ALL SELECT o_orderkey, 'what.tags', '[' || s || ',' || p || ',' || g || ']', 'customer|order' FROM q
    """,
)
def nested_merge(spark, sf_dir):
    """Two nested documents of each order as one, by path, with who gave what."""
    merged = nested.merged_leaves(nested.leaves(_layers(spark, sf_dir), "doc", ["o_orderkey", "rank", "source"]), "o_orderkey", "rank", "source")
    return merged.select("o_orderkey", "path", "value", F.array_join("sources", "|").alias("sources"))


@query(
    "nested_documents",
    """
    SELECT o_orderkey, '{"what":{"how":{"name":"' || c_name || '","priority":"' || o_orderpriority || '"},"tags":["' || o_orderstatus || '","' || o_orderpriority || '","' || c_mktsegment || '"]},"who":{"id":' || o_custkey || ',"place":{"nation":' || c_nationkey || '},"state":"'
    || CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE c_mktsegment END || '"}}' AS document FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def nested_documents(spark, sf_dir):
    """The merged document of every order as JSON text."""
    return nested.merged_documents(_layers(spark, sf_dir), "doc", "o_orderkey", "rank", "source")


@query(
    "props_leaves",
    "SELECT event_id, ltrim(fullkey, '$.') AS path, atom::VARCHAR AS value FROM events, json_tree(props) AS t WHERE t.atom IS NOT NULL AND t.type NOT IN ('OBJECT', 'ARRAY', 'NULL')",
)
def props_leaves(spark, sf_dir):
    """What the properties of every event say, by path."""
    return nested.leaves(read(spark, sf_dir, "events").select("event_id", "props"), "props", ["event_id"]).select("event_id", "path", "value")


#: Makers as they are written, nested brackets included, from every part's own words.
_WRITTEN = "p_name || ' (' || p_brand || ', ' || p_type || ' (x, y)), ' || p_type || ', ' || p_name || ' (' || p_brand || ')'"


@query(
    "vendor_entities",
    f"""
    WITH w AS (SELECT p_partkey, {_WRITTEN} AS t FROM part), e AS (SELECT p_partkey, list_filter(list_transform(regexp_extract_all(t, '(?:[^,()]|\\((?:[^()]|\\([^()]*\\))*\\))+'), lambda x: trim(x)), lambda x: x <> '') AS e FROM w),
    k AS (SELECT p_brand AS alias, min(p_partkey) AS r FROM part GROUP BY 1), p AS (SELECT p_partkey, p_name, p_brand, p_type FROM part)
    SELECT p_partkey, array_to_string(e, ';') AS entities, array_to_string(CASE WHEN p_type = p_name || ' (' || p_brand || ', ' || p_type || ' (x, y))' THEN [p_type] ELSE [p_name || ' (' || p_brand || ', ' || p_type || ' (x, y))', p_type, 'Maker of ' || p_brand] END, ';') AS vendors, p_brand AS platforms
    FROM e JOIN p USING (p_partkey)
    """,
)
def vendor_entities(spark, sf_dir):
    """Makers of every part as they are written, parted outside brackets and met with a registry of brands."""
    parts = read(spark, sf_dir, "part").withColumn("written", F.expr(_WRITTEN))
    brands = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("rank")).select(F.col("p_brand").alias("alias"), F.concat(F.lit("Maker of "), "p_brand").alias("vendor"), F.col("p_brand").alias("platform"), "rank")
    met = vendors.canonical_vendors(parts.withColumn("list", F.array("written")), "p_partkey", "list", brands)
    joined = parts.select("p_partkey", F.array_join(vendors.split_entities(F.col("written")), ";").alias("entities")).join(grows(met), "p_partkey")
    return joined.select("p_partkey", "entities", F.array_join("vendors", ";").alias("vendors"), F.array_join("platforms", ";").alias("platforms"))


def _nation_campaigns(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    evidence = read(spark, sf_dir, "orders").join(customers, "o_custkey").select(F.col("c_nationkey").cast("string").alias("campaign_id"), "o_orderkey", F.array("c_mktsegment").alias("platforms"), F.array(F.lit("V")).alias("vendors"), F.array("o_orderpriority").alias("cves"), F.array("o_orderstatus").alias("actors"))
    fixed = lambda *xs: F.array(*[F.lit(x) for x in xs])
    named = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("campaign_id"), fixed("MACHINERY", "BUILDING").alias("platforms"), fixed("V").alias("vendors"), fixed("1-URGENT", "2-HIGH", "none").alias("cves"), fixed("F", "O").alias("actors"))
    return named, evidence


_CHAIN = """
    WITH o AS (SELECT c_nationkey::VARCHAR AS c, o_orderkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN lower(c_mktsegment) END AS p, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN lower(o_orderpriority) END AS v, CASE WHEN o_orderstatus IN ('F', 'O') THEN lower(o_orderstatus) END AS a FROM orders JOIN customer ON o_custkey = c_custkey),
    d AS (SELECT DISTINCT c, 'platform:' || p AS source, 'cve:' || v AS target, 'has_vuln' AS relation FROM o WHERE p IS NOT NULL AND v IS NOT NULL
          UNION SELECT c, 'cve:' || v, 'actor:' || a, 'exploited_by' FROM o WHERE v IS NOT NULL AND a IS NOT NULL UNION SELECT c, 'platform:' || p, 'actor:' || a, 'targeted_by' FROM o WHERE v IS NULL AND p IS NOT NULL AND a IS NOT NULL),
    n AS (SELECT n_nationkey::VARCHAR AS c, unnest(['cve:1-urgent', 'cve:2-high', 'cve:none', 'actor:f', 'actor:o']) AS target FROM nation)
"""


@query("chain_graph", _CHAIN + "SELECT c AS campaign_id, source, target, relation FROM d UNION ALL SELECT c, 'platform:machinery', target, CASE WHEN target LIKE 'cve%' THEN 'has_vuln' ELSE 'targeted_by' END FROM n WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.c = n.c AND d.target = n.target)")
def chain_graph(spark, sf_dir):
    """How each nation's orders hang together: from segments by priorities to states, every end led to."""
    named, evidence = _nation_campaigns(spark, sf_dir)
    return campaigns.chain_graph(named, evidence, "o_orderkey")[1]


@query(
    "victim_groups",
    """
    WITH o AS (SELECT c_nationkey::VARCHAR AS c, o_orderkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'platform:' || lower(c_mktsegment) ELSE 'vendor:v' END AS g FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT c AS campaign_id, g AS "group", split_part(g, ':', 1) AS via, count(*) AS count, array_to_string(list_sort(list(o_orderkey))[1:25], '|') AS first FROM o GROUP BY 1, 2
    """,
)
def victim_groups(spark, sf_dir):
    """Orders of each nation by the segment that they came through, and the first of them."""
    named, evidence = _nation_campaigns(spark, sf_dir)
    groups = campaigns.victim_groups(named, evidence.select("campaign_id", F.col("o_orderkey").alias("member")), evidence, "o_orderkey")
    return groups.withColumn("first", F.array_join(F.col("first").cast("array<string>"), "|"))


@query(
    "hierarchy",
    """
    WITH c AS (SELECT r_name, n_name, c_mktsegment AS g, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
    b AS (SELECT r_name, n_name, sum(n)::BIGINT AS n, list({'name': g, 'value': n} ORDER BY n DESC, g) AS kids FROM c GROUP BY 1, 2)
    SELECT r_name AS name, sum(n)::BIGINT AS value, to_json(list({'name': n_name, 'value': n, 'children': kids} ORDER BY n DESC, n_name))::VARCHAR AS children FROM b GROUP BY 1
    """,
)
def hierarchy(spark, sf_dir):
    """Customers by region, nation and segment as one tree a region, the largest first."""
    nations = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    tree = nested.hierarchy(read(spark, sf_dir, "customer").join(nations, "c_nationkey"), ["r_name", "n_name", "c_mktsegment"])
    return tree.withColumn("children", F.to_json("children"))
