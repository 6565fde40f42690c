"""Domain-shaped queries over the given tables: technique analytics, trends by metric, funnels, page yield, repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, vocab
from ..functions.text import core_tokens
from ..operators import readmodels, star
from ..operators.ranking import top_per_group
from ..session import read
from ..sources import export
from .catalog import query


def _lines(spark, sf_dir):
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey")


@query(
    "technique_analytics",
    """
    WITH x AS (SELECT l_orderkey AS i, p_type AS tactic, p_brand AS technique FROM lineitem JOIN part ON l_partkey = p_partkey),
    t AS (SELECT tactic, count(DISTINCT i) AS tactic_incidents, count(*) AS total FROM x GROUP BY 1), g AS (SELECT tactic, technique, count(DISTINCT i) AS incidents, count(*) AS rows FROM x GROUP BY 1, 2)
    SELECT tactic, technique, incidents, rows, round(rows * 100.0 / total, 4) AS pct, row_number() OVER (PARTITION BY tactic ORDER BY incidents DESC, rows DESC, technique) AS rank, tactic_incidents FROM g JOIN t USING (tactic)
    QUALIFY row_number() OVER (PARTITION BY tactic ORDER BY incidents DESC, rows DESC, technique) <= 4
    """,
)
def technique_analytics(spark, sf_dir):
    return readmodels.technique_analytics(_lines(spark, sf_dir), "l_orderkey", "p_type", "p_brand", 4)


@query(
    "kpi_trends",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS bucket, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS a, count(*) FILTER (WHERE o_orderstatus = 'F') AS b, count(*) FILTER (WHERE o_totalprice > 100000) AS c FROM orders GROUP BY 1)
    SELECT bucket, 'urgent' AS metric, a AS n FROM m UNION ALL SELECT bucket, 'done', b FROM m UNION ALL SELECT bucket, 'large', c FROM m
    """,
)
def kpi_trends(spark, sf_dir):
    """Three metrics by month from one pass."""
    return readmodels.kpi_trends(read(spark, sf_dir, "orders"), F.col("o_orderdate"), "month", {"urgent": F.col("o_orderpriority") == "1-URGENT", "done": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100000})


@query(
    "page_yield",
    r"""
    WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS source, try_cast(nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS INTEGER) AS page, contains(url, '/en/') AS useful FROM pages),
    g AS (SELECT source, page, count(*) AS items, count(*) FILTER (WHERE useful) AS useful FROM p WHERE page IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, round(coalesce(sum(useful) OVER (PARTITION BY source ORDER BY page ROWS UNBOUNDED PRECEDING) / nullif(sum(useful) OVER (PARTITION BY source), 0), 0), 6) AS share FROM g)
    SELECT *, share >= 0.95 AS past_knee FROM r
    """,
)
def page_yield(spark, sf_dir):
    """Which page of a listing has brought 95 % of what is useful."""
    pages = read(spark, sf_dir, "pages").withColumn("source", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1))
    return readmodels.page_yield(pages, "source", F.nullif(F.regexp_extract("url", r"page=(\d+)", 1), F.lit("")).try_cast("int"), F.contains("url", F.lit("/en/")))


@query(
    "collection_funnel",
    """
    WITH f AS (SELECT count(*) AS a, count(*) FILTER (WHERE n_chars >= 300) AS b, count(*) FILTER (WHERE n_chars >= 300 AND quality = 1) AS c, count(*) FILTER (WHERE n_chars >= 300 AND quality = 1 AND toxic = 0) AS d FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'collected' AS stage, a AS n, 100.0::DOUBLE AS pct_of_first, 100.0::DOUBLE AS pct_of_previous FROM f UNION ALL SELECT 'long', b, round(b * 100.0 / a, 4), round(b * 100.0 / a, 4) FROM f
    UNION ALL SELECT 'good', c, round(c * 100.0 / a, 4), round(c * 100.0 / b, 4) FROM f UNION ALL SELECT 'clean', d, round(d * 100.0 / a, 4), round(d * 100.0 / c, 4) FROM f
    """,
)
def collection_funnel(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return readmodels.funnel(rows, {"collected": F.lit(True), "long": F.col("n_chars") >= 300, "good": F.col("quality") == 1, "clean": F.col("toxic") == 0})


@query(
    "lead_times",
    """
    WITH t AS (SELECT l_returnflag AS flag, epoch(l_shipdate) - epoch(o_orderdate) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT flag, count(*) AS n, round(avg(s), 4) AS mean_s, round(quantile_cont(s, 0.5), 4) AS p50_s, round(quantile_cont(s, 0.9), 4) AS p90_s, round(quantile_cont(s, 0.95), 4) AS p95_s FROM t GROUP BY 1
    """,
)
def lead_times(spark, sf_dir):
    """From order to shipping, by flag."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("flag"), "l_shipdate")
    return readmodels.lead_times(lines.join(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey"), ["flag"], "o_orderdate", "l_shipdate")


@query(
    "vertex_confidence",
    """
    WITH v AS (SELECT doc_id, (CASE WHEN lang = 'en' THEN 1 ELSE 0 END + CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END + CASE WHEN coalesce(quality, 0) = 1 THEN 1 ELSE 0 END)::BIGINT AS victim_score, (CASE WHEN coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END)::BIGINT AS adversary_score FROM documents LEFT JOIN labels USING (doc_id))
    SELECT victim_score, CASE victim_score WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS victim_confidence, adversary_score, CASE adversary_score WHEN 0 THEN 'none' ELSE 'low' END AS adversary_confidence, count(*) AS n FROM v GROUP BY ALL
    """,
)
def vertex_confidence(spark, sf_dir):
    """Records by how surely their vertices are known."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    scored = rows.select(*readmodels.vertices({"victim": [F.col("lang") == "en", F.col("n_chars") > 1000, F.col("quality") == 1], "adversary": [F.col("toxic") == 1]}))
    return scored.groupBy(*scored.columns).agg(F.count("*").alias("n"))


@query(
    "date_repair",
    """
    WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS published, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate::DATE + 30 WHEN 1 THEN (o_orderdate::DATE + INTERVAL 12 MONTH)::DATE WHEN 2 THEN o_orderdate::DATE + 2000 END AS v FROM orders)
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN v WHEN 1 THEN (v - INTERVAL 12 MONTH)::DATE END AS value, CASE o_orderkey % 4 WHEN 1 THEN 'year shifted' WHEN 2 THEN 'after publication' END AS reason FROM d
    """,
)
def date_repair(spark, sf_dir):
    """Days near, a year after and far after their publication."""
    day = F.to_date("o_orderdate")
    fourth = F.col("o_orderkey") % 4
    value = F.when(fourth == 0, F.date_add(day, 30)).when(fourth == 1, F.add_months(day, 12)).when(fourth == 2, F.date_add(day, 2000))
    fixed = dates.repaired(value, day)
    return read(spark, sf_dir, "orders").select("o_orderkey", fixed["value"].alias("value"), fixed["reason"].alias("reason"))


@query(
    "enum_values",
    """
    SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'metal' WHEN contains(lower(p_type), 'steel') THEN 'steel' WHEN contains(lower(p_type), 'copper') THEN 'copper' ELSE 'other' END AS kind FROM part
    """,
)
def enum_values(spark, sf_dir):
    """Free labels as vocabulary values: exact, mapped, contained, else the fallback."""
    kind = vocab.enum_value(F.col("p_type"), ["steel", "copper"], None, "other")
    return read(spark, sf_dir, "part").select("p_partkey", F.when(F.contains(F.lower("p_type"), F.lit("brass")), "metal").otherwise(kind).alias("kind"))


@query(
    "star_bridge",
    """
    WITH d AS (SELECT user_id, event_type FROM events), b AS (SELECT DISTINCT user_id AS id, event_type AS slug FROM d)
    SELECT slug, count(*) AS n, min(id) AS low FROM b GROUP BY 1
    """,
)
def star_bridge(spark, sf_dir):
    """Kinds of event gathered as a JSON list a user, and exploded into a bridge."""
    docs = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.to_json(F.struct(F.collect_set("event_type").alias("kinds"))).alias("projection"))
    return star.bridge(docs, "id", "kinds").groupBy("slug").agg(F.count("*").alias("n"), F.min("id").alias("low"))


@query(
    "threat_lists",
    """
    SELECT 'actor' AS list, lower(trim(n_name)) AS key FROM nation JOIN supplier ON s_nationkey = n_nationkey UNION SELECT 'family', lower(trim(p_brand)) FROM part UNION SELECT 'country', lower(trim(r_name)) FROM region
    """,
)
def threat_lists(spark, sf_dir):
    """Key lists for export: distinct, lower case."""
    none = F.lit(None).cast("string")
    shape = lambda df, **c: df.select(*[c.get(k, none).alias(k) for k in ("actor", "family", "country", "cves")])
    used = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey", "left_semi")
    rows = shape(used, actor=F.col("n_name")).union(shape(read(spark, sf_dir, "part"), family=F.col("p_brand"))).union(shape(read(spark, sf_dir, "region"), country=F.col("r_name")))
    return export.indicator_lists(rows)


@query(
    "actor_targeting",
    """
    WITH x AS (SELECT p_brand AS actor, n_name AS country FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
    t AS (SELECT actor, count(*) AS total FROM x GROUP BY 1 ORDER BY total DESC, actor LIMIT 5), g AS (SELECT actor, country, count(*) AS n FROM x WHERE actor IN (SELECT actor FROM t) GROUP BY 1, 2)
    SELECT actor, country, n, row_number() OVER (PARTITION BY actor ORDER BY n DESC, country) AS rank FROM g QUALIFY row_number() OVER (PARTITION BY actor ORDER BY n DESC, country) <= 5
    """,
)
def actor_targeting(spark, sf_dir):
    """The five largest actors, each with its five first countries; counted by keys before any join."""
    keyed = read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("c"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("actor"))
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    cells = keyed.join(part, "l_partkey").join(supplier, "l_suppkey").join(nation, "n_nationkey").groupBy("actor", "country").agg(F.sum("c").alias("n"))
    largest = cells.groupBy("actor").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "actor").limit(5).select("actor")
    return top_per_group(cells.join(largest, "actor", "left_semi"), ["actor"], [F.desc("n"), F.col("country")], 5)


@query(
    "token_sets",
    r"""
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 1 AND x NOT IN ('part')))), '|') AS words FROM part
    """,
)
def token_sets(spark, sf_dir):
    """The content words of names, for blocking."""
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(core_tokens(F.col("p_name"), ("part",)), "|").alias("words"))
