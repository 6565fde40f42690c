"""Star rows from JSON documents, timelines, label and text rules, members, read models, sinks and cursors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, vocab
from ..functions import text as tx
from ..operators import campaigns, readmodels, resolution, star
from ..session import read
from ..sources import cursors, export
from .catalog import query


def _documents(spark, sf_dir):
    """Every order as a JSON document, as an extraction leaves it."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    technique = lambda n, name: F.struct(F.concat(F.lit("t1"), F.lpad((key % n).cast("string"), 3, "0")).alias("technique_id"), F.lit(name).alias("technique_name"), F.col("o_orderstatus").alias("tactic"))
    made = F.struct(
        F.struct(F.col("o_orderpriority").alias("family"), F.format_string("$%s", F.round("o_totalprice").cast("long").cast("string")).alias("amount")).alias("attack"),
        F.struct(F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("stolen")).alias("data"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.array(technique(7, "old"), technique(11, "new"), F.struct(F.lit("bad").alias("technique_id"), F.lit(None).cast("string").alias("technique_name"), F.lit(None).cast("string").alias("tactic"))).alias("mitre_attack_techniques"),
        F.array(F.concat(F.lit("10.0.0."), (key % 250).cast("string")), F.lit("zzz"), F.concat(F.lit("a"), key.cast("string"), F.lit(".example.com"))).alias("iocs"),
    )
    notes = F.concat(F.lit("see CVE-2021-"), F.lpad(key.cast("string"), 6, "0"), F.lit(" and cve-1998-1234, "), (key % 90 + 1).cast("string"), F.when(key % 2 == 0, " GB").otherwise(" TB"), F.lit(" gone"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.to_json(made).alias("projection"), notes.alias("notes"))


SLUG_SQL = "array_to_string(list_filter(string_split(translate(lower(trim({0})), '/- ', '___'), '_'), lambda x: x <> ''), '_')"


@query("star_facts", f"SELECT o_orderkey, {SLUG_SQL.format('o_orderpriority')} AS family, CAST(round(o_totalprice) AS DOUBLE) AS amount, o_orderstatus = 'F' AS stolen, o_orderdate::DATE AS day FROM orders")
def star_facts(spark, sf_dir):
    """Facts with the dimension that their keys name."""
    docs = _documents(spark, sf_dir)
    family = docs.select(F.get_json_object("projection", "$.attack.family").alias("family"))
    dim = star.dimension(family, "family").select(F.col("key").alias("family_key"), F.col("slug").alias("family"))
    return star.facts(docs, "o_orderkey", ["attack.family"], ["attack.amount"], ["data.stolen"], ["day"]).join(dim, "family_key").select("o_orderkey", "family", "amount", "stolen", "day")


@query(
    "star_techniques",
    """
    WITH t AS (SELECT o_orderkey, 'T1' || lpad(CAST(o_orderkey % 7 AS VARCHAR), 3, '0') AS technique_id, o_orderstatus AS tactic, 'old' AS name, 0 AS pos FROM orders UNION ALL SELECT o_orderkey, 'T1' || lpad(CAST(o_orderkey % 11 AS VARCHAR), 3, '0'), o_orderstatus, 'new', 1 FROM orders)
    SELECT o_orderkey, technique_id, tactic, name FROM t QUALIFY row_number() OVER (PARTITION BY o_orderkey, technique_id ORDER BY pos DESC) = 1
    """,
)
def star_techniques(spark, sf_dir):
    return star.techniques(_documents(spark, sf_dir), "o_orderkey")


@query("technique_columns", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = o_orderkey % 11 THEN 1 ELSE 2 END AS n, 'T1' || lpad(CAST(least(o_orderkey % 7, o_orderkey % 11) AS VARCHAR), 3, '0') || CASE WHEN o_orderkey % 7 = o_orderkey % 11 THEN '' ELSE '|T1' || lpad(CAST(greatest(o_orderkey % 7, o_orderkey % 11) AS VARCHAR), 3, '0') END AS techniques FROM orders")
def technique_columns(spark, sf_dir):
    """Techniques flattened to what a CSV file can hold."""
    lists = star.techniques(_documents(spark, sf_dir), "o_orderkey").groupBy("o_orderkey").agg(F.count("*").cast("int").alias("n"), F.array_sort(F.collect_list("technique_id")).alias("techniques"))
    return export.flat(lists)


@query("star_flaws", "SELECT o_orderkey, 'CVE-2021-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS cve FROM orders")
def star_flaws(spark, sf_dir):
    """Flaws named in notes; years before the list began are no flaws."""
    return star.flaws(_documents(spark, sf_dir), "o_orderkey", ["notes"])


@query("star_indicators", "SELECT o_orderkey, 'ipv4' AS kind, '10.0.0.' || (o_orderkey % 250) AS value FROM orders UNION ALL SELECT o_orderkey, 'domain', 'a' || o_orderkey || '.example.com' FROM orders")
def star_indicators(spark, sf_dir):
    return star.indicators(_documents(spark, sf_dir), "o_orderkey")


@query("text_rules", "SELECT o_orderkey, CAST(o_orderkey % 90 + 1 AS DOUBLE) * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 1024 END AS volume_gb, CASE o_orderkey % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'nas' END AS acronym FROM orders")
def text_rules(spark, sf_dir):
    """Data volumes of notes, and acronyms of names."""
    names = F.array(*[F.lit(n) for n in ("Massachusetts Institute of Technology", "New Art School", "Two Words")])
    docs = _documents(spark, sf_dir)
    return docs.select("o_orderkey", tx.volume_gb(F.col("notes")).alias("volume_gb"), tx.acronym(F.element_at(names, (F.col("o_orderkey") % 3 + 1).cast("int"))).alias("acronym"))


LABELS = {"ransomware": "Ransomware attack", "data_breach": "Data breach"}
FAMILIES = {"data_breach": "data", "ransomware": "data", "third_party": "vendor"}
RAW = ("Ransomware", "data-breach", "Third Party Vendor", "unknown", "phishing/web")


@query(
    "label_rules",
    """
    SELECT event_id, ['Ransomware attack', 'Data breach', 'Third Party Vendor', NULL, 'Phishing Web'][event_id % 5 + 1] AS label, ['data', 'data', 'vendor', 'other', 'other'][event_id % 5 + 1] AS family,
    ['ransomware', 'data_breach', '', '', ''][event_id % 5 + 1] AS known, chr(127462 + 5) || chr(127462 + 17) AS flag FROM events
    """,
)
def label_rules(spark, sf_dir):
    """Labels, families and known values of slugs, one given to every event; and a flag."""
    raw = F.element_at(F.array(*[F.lit(x) for x in RAW]), (F.col("event_id") % 5 + 1).cast("int"))
    known = F.array_join(vocab.enum_list(F.array(raw, raw), list(LABELS)), "|")
    return read(spark, sf_dir, "events").select("event_id", vocab.category_label(raw, LABELS).alias("label"), vocab.prefix_family(raw, FAMILIES).alias("family"), known.alias("known"), vocab.flag(F.lit("fr")).alias("flag"))


@query(
    "timeline_guards",
    """
    WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, CAST(o_orderkey % 200 AS INTEGER) AS late FROM orders)
    SELECT o_orderkey, CASE WHEN late <= 90 THEN d + late END AS attack, d AS notice, CASE WHEN late <= 3 THEN 'immediate' WHEN late <= 30 THEN 'prompt' WHEN late <= 90 THEN 'delayed' ELSE 'late' END AS level,
    CASE WHEN o_orderkey % 3 = 0 THEN d + 1 ELSE d END AS better, CASE WHEN late <= 1 THEN d + late END AS safe FROM o
    """,
)
def timeline_guards(spark, sf_dir):
    """Timelines without days long after publication, undated events filled, disclosure levels and the more precise of two dates."""
    day, late = F.to_date("o_orderdate"), (F.col("o_orderkey") % 200).cast("int")
    event = lambda when, kind: F.struct(when.cast("date").alias("date"), F.lit(kind).alias("event_type"))
    events = dates.filled(dates.guarded(F.array(event(F.date_add(day, late), "attack"), event(F.lit(None), "notice")), day), {"notice": day})
    third = F.col("o_orderkey") % 3 == 0
    better = dates.more_precise(day, dates.precision_rank(F.lit("month")), F.date_add(day, 1), dates.precision_rank(F.when(third, "day").otherwise("year")))
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.first_of_kind(events, "attack").alias("attack"), dates.first_of_kind(events, "notice").alias("notice"), dates.disclosure_level(late).alias("level"), better.alias("better"), dates.safe_date(F.date_add(day, late), day).alias("safe"))


@query("primary_members", "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1 AS is_primary FROM orders")
def primary_members(spark, sf_dir):
    """Each customer's dearest order is its primary one."""
    return resolution.primary_members(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey").drop("o_totalprice")


@query("retired_records", "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) THEN c_mktsegment ELSE 'excluded' END AS status FROM customer")
def retired_records(spark, sf_dir):
    """Customers without a large order are retired."""
    members = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return resolution.retired(read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("status")), members, "c_custkey")


@query(
    "campaign_consensus",
    """
    WITH n AS (SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) >= 2)
    SELECT o_custkey, string_agg(v, '|' ORDER BY n DESC, v) AS priorities_consensus FROM n GROUP BY 1
    """,
)
def campaign_consensus(spark, sf_dir):
    """What at least two of a customer's orders agree on, commonest first."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.array("o_orderpriority").alias("priorities"))
    return campaigns.consensus(orders, orders.select("o_custkey", F.col("o_orderkey").alias("member")), ["o_custkey"], "o_orderkey", "priorities")


@query(
    "campaign_families",
    """
    WITH RECURSIVE o AS (SELECT DISTINCT l_suppkey AS c, l_partkey AS m FROM lineitem), z AS (SELECT c, count(*) AS n FROM o GROUP BY 1),
    p AS (SELECT x.c AS a, y.c AS b, count(*) AS both_n FROM o x JOIN o y ON x.m = y.m AND x.c < y.c GROUP BY 1, 2),
    e AS (SELECT a, b FROM p JOIN z x ON x.c = a JOIN z y ON y.c = b WHERE both_n >= 3 AND both_n / (x.n + y.n - both_n) >= 0.1),
    n AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT c, c FROM z),
    r(a, b) AS (SELECT a, b FROM n UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a), f AS (SELECT a, min(b) AS family FROM r GROUP BY 1)
    SELECT family, count(*) AS campaigns FROM f GROUP BY 1
    """,
)
def campaign_families(spark, sf_dir):
    """Suppliers as campaigns: those with many parts in common form families, through whole chains."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("campaign_id"), F.col("l_partkey").alias("member"))
    tied = campaigns.families(lines, 3, 0.1)
    return tied.groupBy("family").agg(F.min("campaign_id").alias("first"), F.count("*").alias("campaigns")).select(F.col("first").alias("family"), "campaigns")


@query("order_detail", "SELECT o_orderkey, o_orderstatus, coalesce(string_agg(l_linenumber || ':' || l_partkey, '|' ORDER BY l_linenumber, l_partkey, l_rowid), '') AS lines FROM orders LEFT JOIN (SELECT *, rowid AS l_rowid FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER () AS rowid FROM lineitem)) ON l_orderkey = o_orderkey GROUP BY 1, 2")
def order_detail(spark, sf_dir):
    """Every order with its lines, those without any included."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    found = readmodels.detail(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), {"lines": (lines, ["l_linenumber", "l_partkey"])}, "o_orderkey")
    return found.withColumn("lines", F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), "|"))


@query("forgotten_orders", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def forgotten_orders(spark, sf_dir):
    """The newest order of customers that have none pending."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return readmodels.unselected(orders, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], orders.where("o_orderstatus = 'P'")).select("o_custkey", "o_orderkey")


def _uuid_sql(text: str) -> str:
    digest = f"sha1({text})"
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query(
    "stix_bundle",
    f"""
    WITH p AS (SELECT DISTINCT lower(p_brand) AS a, lower(p_type) AS b FROM part), a AS (SELECT DISTINCT a, 'malware--' || {_uuid_sql("'family:' || a")} AS id FROM p), b AS (SELECT DISTINCT b, 'location--' || {_uuid_sql("'country:' || b")} AS id FROM p)
    SELECT id, 'malware' AS type, a AS name, NULL AS source_ref, NULL AS target_ref FROM a UNION ALL SELECT id, 'location', b, NULL, NULL FROM b
    UNION ALL SELECT 'relationship--' || {_uuid_sql("a.id || ':targets:' || b.id")}, 'relationship', NULL, a.id, b.id FROM p JOIN a USING (a) JOIN b USING (b)
    """,
)
def stix_bundle(spark, sf_dir):
    """Brands as malware, types as places, and which targets which."""
    pairs = read(spark, sf_dir, "part").select(F.lower("p_brand").alias("a"), F.lower("p_type").alias("b")).distinct()
    keys = pairs.select(F.lit("family").alias("list"), F.col("a").alias("key")).union(pairs.select(F.lit("country"), "b")).distinct()
    rows = export.stix_objects(keys).union(export.stix_relationships(pairs, "targets", "family", "country"))
    return rows.select("id", *[F.get_json_object("json", f"$.{c}").alias(c) for c in ("type", "name", "source_ref", "target_ref")])


@query("metric_lines", "SELECT 'events_total{source=\"' || event_type || '\"} ' || count(*) AS value FROM events GROUP BY event_type")
def metric_lines(spark, sf_dir):
    """Metric text of the events by kind."""
    counted = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("value"))
    return export.prometheus(counted.select(F.lit("events_total").alias("name"), F.col("event_type").alias("label"), "value"))


@query(
    "source_cursors",
    """
    WITH c AS (SELECT source, max(doc_id) AS marker FROM documents WHERE lang = 'en' GROUP BY 1)
    SELECT d.source, count(*) AS behind, max(doc_id) AS marker FROM documents d LEFT JOIN c ON c.source IS NOT DISTINCT FROM d.source WHERE marker IS NULL OR doc_id > marker GROUP BY 1
    """,
)
def source_cursors(spark, sf_dir):
    """What lies behind each source's cursor, left by its English documents, and where the cursor stands then."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    seen = cursors.advanced(None, docs.where("lang = 'en'"), "source", "doc_id")
    rest = cursors.after(docs, seen, "source", "doc_id")
    now = cursors.advanced(seen, rest, "source", "doc_id")
    return rest.groupBy("source").agg(F.count("*").alias("behind")).join(now, "source").select("source", "behind", "marker")


@query("star_weaknesses", "SELECT o_orderkey, 'CWE-' || (o_orderkey % 900 + 1) AS cwe FROM orders UNION SELECT o_orderkey, 'CWE-79' FROM orders")
def star_weaknesses(spark, sf_dir):
    texts = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("by CWE-"), (F.col("o_orderkey") % 900 + 1).cast("string"), F.lit(" and cwe-0079, not CWE-0")).alias("notes"))
    return star.weaknesses(texts, "o_orderkey", ["notes"])


@query(
    "star_ready",
    """
    SELECT 'lines' AS "table", (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS missing, (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans,
    NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS ready
    UNION ALL SELECT 'facts', 0, 0, TRUE
    """,
)
def star_ready(spark, sf_dir):
    """Whether the layer holds every order: its facts do, its lines need not."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return star.readiness(orders, "o_orderkey", {"lines": lines, "facts": star.flaws(_documents(spark, sf_dir), "o_orderkey", ["notes"])})


@query("primary_articles", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def primary_articles(spark, sf_dir):
    """What is left when all but the primary members go."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return resolution.primary_members(rows, "o_custkey", "o_totalprice", "o_orderkey").where("is_primary").select("o_custkey", "o_orderkey")
