"""Matching, merging, graph and star-schema queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import campaigns, graph, matching, merging, quality
from ..operators.aggregate import breakdown
from ..session import read
from ..sources.shared import grows, keep
from .catalog import query


def _customers(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return read(spark, sf_dir, "customer").join(nations, "c_nationkey")


@query(
    "range_match",
    """
    SELECT x.o_orderkey AS a, y.o_orderkey AS b, abs(x.o_orderdate::DATE - y.o_orderdate::DATE) AS gap FROM orders x JOIN orders y
    ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey AND abs(x.o_orderdate::DATE - y.o_orderdate::DATE) <= 14
    """,
)
def range_match(spark, sf_dir):
    """Orders of one customer at most 14 days apart."""
    return matching.range_pairs(read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")), "o_orderkey", ["o_custkey"], "day", 14).withColumn("gap", F.col("gap").cast("long"))


@query(
    "asof_last_event",
    """
    SELECT event_id, event_type, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_view FROM events
    """,
)
def asof_last_event(spark, sf_dir):
    """Each event with its user's last view before it."""
    return matching.last_before(read(spark, sf_dir, "events"), ["user_id"], "ts", [F.col("event_id")], F.col("event_type") == "view", "event_id", "last_view").select("event_id", "event_type", "last_view")


@query(
    "hash_dedup",
    """
    SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS keep_id, count(*) OVER (PARTITION BY md5(text)) AS copies FROM documents
    """,
)
def hash_dedup(spark, sf_dir):
    """Content-hash groups. The groups are counted by partial sums; only hashes of two rows or more meet the rows again."""
    docs = keep(read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h")), "hashes")
    groups = keep(docs.groupBy("h").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1"), "hash-groups")
    return docs.join(grows(groups), "h", "left").select("doc_id", F.coalesce("low", "doc_id").alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("copies"))


@query(
    "name_token_jaccard",
    r"""
    WITH w AS (SELECT p_partkey AS id, p_brand, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 1))) AS t FROM part)
    SELECT x.id AS a, y.id AS b, round(len(list_intersect(x.t, y.t)) / len(list_distinct(list_concat(x.t, y.t))), 6) AS jaccard FROM w x JOIN w y ON x.p_brand = y.p_brand AND x.id < y.id
    WHERE round(len(list_intersect(x.t, y.t)) / len(list_distinct(list_concat(x.t, y.t))), 6) >= 0.6
    """,
)
def name_token_jaccard(spark, sf_dir):
    """Parts of one brand whose name and type share most words."""
    parts = read(spark, sf_dir, "part").withColumn("label", F.concat_ws(" ", "p_name", "p_type"))
    return matching.token_pairs(parts, "p_partkey", "label", ["p_brand"], 0.6)


@query("name_match")
def name_match(spark, sf_dir):
    """Supplier names of one nation that match by words or, sorted, by letters."""
    return matching.name_pairs(read(spark, sf_dir, "supplier"), "s_suppkey", "s_name", ["s_nationkey"], ratio=93.0)


@query(
    "candidate_edges",
    """
    WITH p AS (SELECT DISTINCT o_orderkey AS id, o_orderdate::DATE AS d, l_partkey AS part FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
    e AS (SELECT x.id AS a, y.id AS b, min(abs(x.d - y.d)) AS gap_days FROM p x JOIN p y ON x.part = y.part AND x.id < y.id AND abs(x.d - y.d) <= 120 GROUP BY 1, 2)
    SELECT a, b, round(0.45::DOUBLE + CASE WHEN gap_days <= 14 THEN 0.25 WHEN gap_days <= 45 THEN 0.2 ELSE 0.15 END, 3) AS confidence, 'shared_vendor_or_platform' AS reasons, gap_days FROM e
    """,
)
def candidate_edges(spark, sf_dir):
    """Edges between orders that share a part within the days a shared platform allows; every line takes part."""
    parts = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_partkey").cast("array<string>").alias("platforms"))  # an order's lines
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).join(parts, "o_orderkey")
    return campaigns.campaign_edges(rows, "o_orderkey").withColumn("gap_days", F.col("gap_days").cast("long"))


@query(
    "components",
    """
    WITH RECURSIVE e AS (SELECT o_orderkey AS o, 'c' || o_custkey || '-' || year(o_orderdate) || '-' || quarter(o_orderdate) AS k FROM orders
                         UNION SELECT l_orderkey, 'p' || l_partkey || '-' || strftime(l_shipdate, '%Y-%m-%d') FROM lineitem),
    n AS (SELECT DISTINCT x.o AS a, y.o AS b FROM e x JOIN e y ON x.k = y.k),
    r(a, b) AS (SELECT a, b FROM n UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a)
    SELECT a AS node, min(b) AS label FROM r GROUP BY a HAVING count(*) > 1
    """,
)
def components(spark, sf_dir):
    """Orders linked by a customer's quarter or by a part's ship day; each such key is a chain to its first order."""
    quarters = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), F.concat_ws("-", F.concat(F.lit("c"), "o_custkey"), F.year("o_orderdate"), F.quarter("o_orderdate")).alias("key"))
    days = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("node"), F.concat_ws("-", F.concat(F.lit("p"), "l_partkey"), F.to_date("l_shipdate")).alias("key"))
    return graph.connected_components(graph.chain_edges(quarters.unionByName(days).distinct(), "node", "key"))


@query(
    "cooccurrence_network",
    """
    WITH s AS (SELECT DISTINCT n_name AS node, l_partkey AS signal FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT x.node AS a, y.node AS b, count(*) AS weight FROM s x JOIN s y ON x.signal = y.signal AND x.node < y.node GROUP BY 1, 2 HAVING count(*) >= 2
    """,
)
def cooccurrence_network(spark, sf_dir):
    """Nations linked by the parts they share."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return graph.co_occurrence(lines.join(orders, "o_orderkey").join(_customers(spark, sf_dir), "c_custkey"), "n_name", "l_partkey", 2)


@query(
    "sankey_links",
    """
    WITH c AS (SELECT r_name AS x, c_mktsegment AS y, o_orderpriority AS z FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT '0:' || x AS source, '1:' || y AS target, count(*) AS value FROM c GROUP BY x, y HAVING count(*) >= 2
    UNION ALL SELECT '1:' || y, '2:' || z, count(*) FROM c GROUP BY y, z HAVING count(*) >= 2
    """,
)
def sankey_links(spark, sf_dir):
    from .breakdowns import _located

    return graph.flow_links(_located(spark, sf_dir), ["r_name", "c_mktsegment", "o_orderpriority"])


@query(
    "chord_matrix",
    """
    WITH c AS (SELECT n_name AS r, c_mktsegment AS k, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    tr AS (SELECT r FROM c GROUP BY r ORDER BY sum(n) DESC, r LIMIT 8), tk AS (SELECT k FROM c GROUP BY k ORDER BY sum(n) DESC, k LIMIT 4),
    m AS (SELECT r, k, n FROM c WHERE r IN (SELECT r FROM tr) AND k IN (SELECT k FROM tk))
    SELECT r AS x, k AS y, n FROM m UNION ALL SELECT k, r, n FROM m
    """,
)
def chord_matrix(spark, sf_dir):
    return graph.symmetric_matrix(_customers(spark, sf_dir), "n_name", "c_mktsegment", 8, 4)


@query(
    "coherent_members",
    """
    WITH o AS (SELECT o_custkey AS g, o_orderkey AS node, o_orderdate::DATE AS day FROM orders),
    p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY day, node) AS nth, count(*) OVER (PARTITION BY g) AS total FROM o),
    m AS (SELECT g, day AS middle FROM p WHERE nth = total // 2 + 1 AND total >= 3)
    SELECT o.g, o.node FROM o LEFT JOIN m USING (g) WHERE middle IS NULL OR abs(o.day - middle) <= 365
    """,
)
def coherent_members(spark, sf_dir):
    """Members near their group's upper median day."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("node"), F.to_date("o_orderdate").alias("day"))
    return graph.trim_to_median(rows, "g", "node", "day", 365).select("g", "node")


@query(
    "survivor_merge",
    """
    WITH d AS (SELECT md5(text) AS k, doc_id, nullif(lang, 'en') AS lang, source, n_chars, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 2 WHEN source = 'src0' THEN 0 ELSE 1 END AS pref FROM documents)
    SELECT k, arg_max(lang, (pref, -doc_id)) FILTER (WHERE lang IS NOT NULL) AS lang, arg_max(source, (pref, -doc_id)) AS source, arg_max(n_chars, (pref, -doc_id)) AS n_chars, count(*) AS merged_rows FROM d GROUP BY k
    """,
)
def survivor_merge(spark, sf_dir):
    """Copies become one record: each field from the most trusted row that has it."""
    pref = F.when(F.col("source").isin("src1", "src2", "src3"), 2).when(F.col("source") == "src0", 0).otherwise(1)
    docs = read(spark, sf_dir, "documents").select(F.md5("text").alias("k"), "doc_id", F.nullif("lang", F.lit("en")).alias("lang"), "source", "n_chars")
    return merging.merge_fields(docs, ["k"], ["lang", "source", "n_chars"], [pref, -F.col("doc_id")])


@query(
    "field_provenance",
    """
    WITH d AS (SELECT md5(text) AS k, source, unnest([{'f': 'lang', 'v': lang}, {'f': 'n_chars', 'v': CAST(n_chars AS VARCHAR)}], recursive := true) FROM documents)
    SELECT k, f AS field, count(DISTINCT source) AS n_sources, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM d WHERE trim(v) <> '' GROUP BY 1, 2
    """,
)
def field_provenance(spark, sf_dir):
    return merging.provenance(read(spark, sf_dir, "documents").select(F.md5("text").alias("k"), "source", "lang", "n_chars"), ["k"], ["lang", "n_chars"], "source")


@query(
    "upsert_merge",
    """
    WITH c AS (SELECT c_custkey AS k, c_mktsegment AS segment, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer WHERE c_custkey % 5 <> 0),
    n AS (SELECT c_custkey AS k, 'NEW' AS segment, c_acctbal AS balance FROM customer WHERE c_custkey % 2 = 0)
    SELECT coalesce(c.k, n.k) AS k, coalesce(c.segment, n.segment) AS segment, coalesce(c.balance, n.balance) AS balance, CASE WHEN c.k IS NOT NULL THEN 'kept' ELSE 'added' END AS change FROM c FULL JOIN n ON c.k = n.k
    """,
)
def upsert_merge(spark, sf_dir):
    """New rows are added, null fields filled, known ones kept."""
    rows = read(spark, sf_dir, "customer")
    current = rows.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("balance"))
    new = rows.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.lit("NEW").alias("segment"), F.col("c_acctbal").alias("balance"))
    return merging.upsert(current, new, ["k"], ["segment", "balance"])


@query("completeness", "SELECT doc_id, round((CASE WHEN trim(lang) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(source) <> '' THEN 1 ELSE 0 END + CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / 3, 2) AS pct FROM documents LEFT JOIN labels USING (doc_id)")
def completeness(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", merging.completeness(["lang", "source", "quality"]).alias("pct"))


@query(
    "best_candidate",
    """
    WITH p AS (SELECT s_suppkey, c_custkey, (CASE WHEN c_mktsegment = 'BUILDING' THEN 50 ELSE 20 END) + (CASE WHEN abs(c_acctbal - s_acctbal) < 500 THEN 45 WHEN abs(c_acctbal - s_acctbal) < 2000 THEN 25 ELSE 0 END) AS score FROM supplier JOIN customer ON s_nationkey = c_nationkey)
    SELECT s_suppkey, c_custkey, score FROM p WHERE score >= 45 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, c_custkey) = 1
    """,
)
def best_candidate(spark, sf_dir):
    """Per supplier the customer of its nation with the highest additive score."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    customers = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.coalesce(F.col("c_mktsegment") == "BUILDING", F.lit(False)).alias("builds"))
    tiers = [(True, 500, 95), (True, 2000, 75), (False, 500, 65), (True, None, 50), (False, 2000, 45)]
    return matching.best_by_tiers(suppliers, customers, "s_suppkey", "c_custkey", "nation", "balance", F.col("builds"), tiers)


@query(
    "cosine_topk",
    """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, d.vec_id, round(list_cosine_similarity(q.e, d.e), 9) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
)
def cosine_topk(spark, sf_dir):
    """The five nearest of every hundredth vector, against all rows."""
    rows = read(spark, sf_dir, "embeddings")
    return matching.cosine_top(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding", 5)


@query(
    "star_breakdowns",
    """
    WITH f AS (SELECT l_partkey, l_suppkey, count(*) AS n, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2)
    SELECT 'brand' AS dim, p_brand AS label, sum(n)::BIGINT AS n, round(sum(v), 2) AS value FROM f JOIN part ON l_partkey = p_partkey GROUP BY 2
    UNION ALL SELECT 'type', p_type, sum(n)::BIGINT, round(sum(v), 2) FROM f JOIN part ON l_partkey = p_partkey GROUP BY 2
    UNION ALL SELECT 'nation', n_name, sum(n)::BIGINT, round(sum(v), 2) FROM f JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 2
    """,
)
def star_breakdowns(spark, sf_dir):
    """Fact counts by three dimensions; the fact table is summed by its keys once."""
    fact = read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("v"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    supplier = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    sums = lambda df, dim, c: df.groupBy(F.lit(dim).alias("dim"), F.col(c).alias("label")).agg(F.sum("n").alias("n"), F.round(F.sum("v"), 2).alias("value"))
    with_part = fact.join(part, "l_partkey")
    return sums(with_part, "brand", "p_brand").unionByName(sums(with_part, "type", "p_type")).unionByName(sums(fact.join(supplier, "l_suppkey"), "nation", "n_name"))


@query(
    "export_flat",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, n_name AS nation, round(o_totalprice, 2) AS total,
           (SELECT string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey) AS brands
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
)
def export_flat(spark, sf_dir):
    """One flat row an order, its brands sorted and joined."""
    brands = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey")
    joined = brands.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.array_sort(F.collect_set("p_brand")), "|").alias("brands"))
    rows = read(spark, sf_dir, "orders").join(_customers(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("nation")), "o_custkey")
    return rows.join(joined, "o_orderkey", "left").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "nation", F.round("o_totalprice", 2).alias("total"), "brands")


@query(
    "bridge_counts",
    """
    WITH b AS (SELECT DISTINCT l_orderkey, p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
    g AS (SELECT p_type, p_brand, count(*) AS rows_n, count(DISTINCT l_orderkey) AS orders_n FROM b GROUP BY 1, 2)
    SELECT p_type, p_brand, rows_n, orders_n, round(rows_n * 100.0 / sum(rows_n) OVER (PARTITION BY p_type), 4) AS pct FROM g QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY rows_n DESC, p_brand) <= 5
    """,
)
def bridge_counts(spark, sf_dir):
    """Per type its five commonest brands, with their share of the type's bridge rows."""
    bridge = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand"), "p_partkey").select("l_orderkey", "p_type", "p_brand").distinct()
    groups = bridge.groupBy("p_type", "p_brand").agg(F.count("*").alias("rows_n"), F.count("*").alias("orders_n"))
    w = Window.partitionBy("p_type")
    return groups.withColumn("pct", F.round(F.col("rows_n") * 100.0 / F.sum("rows_n").over(w), 4)).withColumn("nth", F.row_number().over(w.orderBy(F.desc("rows_n"), "p_brand"))).where("nth <= 5").drop("nth")


@query(
    "unknown_vendors",
    """
    WITH v AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part), k AS (SELECT DISTINCT unnest(string_split(lower(p_type), ' ')) AS word FROM part WHERE p_size < 25)
    SELECT word, count(*) AS n, min(p_partkey) AS sample FROM v WHERE word <> '' AND NOT EXISTS (SELECT 1 FROM k WHERE k.word = lower(v.word)) GROUP BY 1
    """,
)
def unknown_vendors(spark, sf_dir):
    """Words that the registry does not know, with a sample."""
    part = read(spark, sf_dir, "part")
    known = part.where("p_size < 25").select(F.explode(F.split(F.lower("p_type"), " ")).alias("key")).distinct()
    words = part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")).where("word <> ''").withColumn("key", F.lower("word"))
    return words.join(known, "key", "left_anti").groupBy("word").agg(F.count("*").alias("n"), F.min("p_partkey").alias("sample"))


@query(
    "cap_repeated_values",
    """
    WITH s AS (SELECT l_quantity AS q FROM lineitem WHERE l_quantity >= 30 GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 1250)
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity IN (SELECT q FROM s) OR l_quantity >= 50 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem
    """,
)
def cap_repeated_values(spark, sf_dir):
    """Large values that many orders share, or beyond the ceiling, are taken as unknown."""
    return quality.cap_repeated(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey", "l_quantity", 30, 1250, 50)


@query(
    "quality_reasons",
    """
    SELECT doc_id, concat_ws('; ', CASE WHEN n_chars < 200 THEN 'too short' END, CASE WHEN quality = 0 THEN 'low quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN contains(text, '@') THEN 'personal data' END) AS reasons FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def quality_reasons(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "n_chars", F.contains("text", F.lit("@")).alias("at")).join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", quality.reasons({"too short": F.col("n_chars") < 200, "low quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1, "personal data": F.col("at")}).alias("reasons"))


@query(
    "confusion_wilson",
    """
    WITH c AS (SELECT source, count(*) FILTER (WHERE g AND p) AS tp, count(*) FILTER (WHERE NOT g AND p) AS fp, count(*) FILTER (WHERE NOT g AND NOT p) AS tn, count(*) FILTER (WHERE g AND NOT p) AS fn
      FROM (SELECT source, quality = 1 AS g, n_chars >= 400 AS p FROM labels JOIN documents USING (doc_id)) GROUP BY 1),
    n AS (SELECT *, (tp + fp + tn + fn)::DOUBLE AS n, (tp + tn)::DOUBLE / (tp + fp + tn + fn) AS s FROM c),
    w AS (SELECT *, 1 + 3.8416 / n AS base, s + 3.8416 / (2 * n) AS mid, 1.96 * sqrt(s * (1 - s) / n + 3.8416 / (4 * n * n)) AS half FROM n)
    SELECT source, tp, fp, tn, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
           round(s, 6) AS accuracy, round(greatest(0, (mid - half) / base), 6) AS ci_low, round(least(1, (mid + half) / base), 6) AS ci_high FROM w
    """,
)
def confusion_wilson(spark, sf_dir):
    """A length rule against the quality labels, by source."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id")
    return quality.confusion(rows, F.col("quality") == 1, F.col("n_chars") >= 400, ["source"])


@query(
    "field_accuracy",
    """
    WITH r AS (SELECT quality, toxic, n_chars, lang FROM labels JOIN documents USING (doc_id)),
    x AS (SELECT 'quality' AS field, CAST(quality AS VARCHAR) AS g, CASE WHEN n_chars >= 400 THEN '1' ELSE '0' END AS p FROM r UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), '0' FROM r UNION ALL SELECT 'lang', nullif(lang, 'fr'), 'en' FROM r)
    SELECT field, count(*) AS n, count(*) FILTER (WHERE g = p) AS hits, round(count(*) FILTER (WHERE g = p) / count(*), 6) AS accuracy FROM x WHERE g IS NOT NULL GROUP BY 1
    """,
)
def field_accuracy(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    return quality.field_accuracy(rows, {"quality": (F.col("quality"), F.when(F.col("n_chars") >= 400, 1).otherwise(0)), "toxic": (F.col("toxic"), F.lit(0)), "lang": (F.nullif("lang", F.lit("fr")), F.lit("en"))})


@query(
    "consistency_mismatches",
    """
    SELECT * FROM (SELECT c_custkey, concat_ws('|', CASE WHEN lower(c_mktsegment) IS DISTINCT FROM (CASE WHEN c_custkey % 7 = 0 THEN 'machinery' ELSE lower(c_mktsegment) END) THEN 'segment' END,
      CASE WHEN CAST(c_nationkey AS VARCHAR) IS DISTINCT FROM (CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END) THEN 'nation' END) AS fields FROM customer) WHERE fields <> ''
    """,
)
def consistency_mismatches(spark, sf_dir):
    """A record against a projection that has drifted from it."""
    left = {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}
    right = {"segment": F.when(F.col("c_custkey") % 7 == 0, " MACHINERY ").otherwise(F.lower("c_mktsegment")), "nation": F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey"))}
    return read(spark, sf_dir, "customer").select("c_custkey", merging.differences(left, right).alias("fields")).where("fields <> ''")


@query(
    "orphan_counts",
    """
    SELECT 'labels' AS child, count(*) AS rows, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es')) AS orphans FROM labels
    UNION ALL SELECT 'copies', count(*), count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es')) FROM documents
    """,
)
def orphan_counts(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality.purge_counts(docs.where("lang <> 'es'"), {"labels": read(spark, sf_dir, "labels").select("doc_id"), "copies": docs.select("doc_id")}, "doc_id")


@query("vocabulary_keys", "SELECT DISTINCT p_type AS label, regexp_replace(translate(lower(trim(p_type)), '/- ', '___'), '_+', '_', 'g') AS slug, left(sha256(regexp_replace(translate(lower(trim(p_type)), '/- ', '___'), '_+', '_', 'g')), 12) AS dim_key FROM part")
def vocabulary_keys(spark, sf_dir):
    """A dimension's members with keys that any run gives alike."""
    key = tx.lookup_key(F.col("label"))
    return read(spark, sf_dir, "part").select(F.col("p_type").alias("label")).distinct().select("label", key.alias("slug"), F.left(F.sha2(key, 256), F.lit(12)).alias("dim_key"))


@query("segment_share", "SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'high' END AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM customer GROUP BY 1")
def segment_share(spark, sf_dir):
    """Segments of a figure, as confidence levels are cut from a score."""
    balance = F.col("c_acctbal")
    return breakdown(read(spark, sf_dir, "customer"), F.when(balance < 0, "debt").when(balance < 1000, "low").when(balance < 5000, "middle").otherwise("high"))
