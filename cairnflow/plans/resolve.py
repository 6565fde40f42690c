"""Entity resolution, campaign edges, inferred labels and relative dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, identity, infer, vocab
from ..operators import campaigns, phrases, resolution
from ..session import read
from ..sources.shared import keep
from .catalog import query


def _orders(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    return read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")).join(customers, "o_custkey")


def _observations(spark, sf_dir):
    """Every order as an observation of its customer."""
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("source_id"), F.col("c_name").alias("name"), "day", F.col("c_nationkey").cast("string").alias("country"), F.col("o_orderpriority").alias("category"), F.col("c_mktsegment").alias("family"), F.lit(None).cast("string").alias("actor")
    )


@query(
    "resolution_match",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, c_nationkey, c_mktsegment, o_orderpriority, o_orderdate::DATE AS day FROM orders JOIN customer ON o_custkey = c_custkey),
    r AS (SELECT o_custkey AS canonical_id, max(day) AS day, max(o_orderpriority) AS category FROM o GROUP BY 1),
    s AS (SELECT o_orderkey AS source_id, canonical_id, 100 + CASE WHEN abs(o.day - r.day) <= 3 THEN 20 ELSE 12 END + 8 + CASE WHEN o_orderpriority = category THEN 6 ELSE 0 END + 4 AS score
          FROM o JOIN r ON o_custkey = canonical_id WHERE abs(o.day - r.day) <= 14)
    SELECT source_id, canonical_id, 'name_date' AS match_type, CAST(score AS BIGINT) AS score FROM s WHERE score >= 95
    """,
)
def resolution_match(spark, sf_dir):
    """Orders that belong to their customer's latest record."""
    seen = _observations(spark, sf_dir)
    ids = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("canonical_id"), F.col("c_name").alias("name"))
    records = seen.groupBy("name", "country", "family", "actor").agg(F.max("day").alias("day"), F.max("category").alias("category")).join(ids, "name")
    return resolution.find_existing(seen, records)


@query(
    "canonical_records",
    """
    WITH o AS (SELECT o_orderkey, c_name, c_nationkey, o_orderdate::DATE AS day FROM orders JOIN customer ON o_custkey = c_custkey),
    r AS (SELECT c_name, max(day) AS day FROM o GROUP BY 1),
    k AS (SELECT left(sha256(concat_ws('|', trim(regexp_replace(lower(o.c_name), '[^a-z0-9]+', ' ', 'g')), CAST(o.day AS VARCHAR), CAST(c_nationkey AS VARCHAR), '')), 24) AS canonical_key, o_orderkey FROM o JOIN r ON o.c_name = r.c_name WHERE abs(o.day - r.day) > 14)
    SELECT canonical_key, min(o_orderkey) AS first_source, count(*) AS members FROM k GROUP BY 1
    """,
)
def canonical_records(spark, sf_dir):
    """New records for the orders that belong to none."""
    return resolution.seed_records(_observations(spark, sf_dir), keep(resolution_match(spark, sf_dir), "matched"))


@query(
    "merged_documents",
    """
    WITH d AS (SELECT md5(text) AS k, doc_id, source, lang, n_chars FROM documents)
    SELECT k, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) AS n_chars, array_to_string(list_sort(list_distinct(list(source))), '|') AS sources, count(*) AS members FROM d GROUP BY k
    """,
)
def merged_documents(spark, sf_dir):
    """One record per distinct text, each field from the first document that has it."""
    docs = read(spark, sf_dir, "documents").select(F.md5("text").alias("k"), "doc_id", "source", "lang", "n_chars", F.array("source").alias("sources"))
    merged = resolution.merge_documents(docs, "k", [F.col("doc_id")], ["lang", "n_chars"], ["sources"], "source")
    return merged.select("k", "lang", "n_chars", F.array_join(F.array_sort("sources"), "|").alias("sources"), "members")


def _profiles(spark, sf_dir):
    """Every order with its customer as a flaw, its parts as platforms and its status as a category."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_partkey").cast("array<string>").alias("platforms"))  # an order's lines
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.array(F.col("o_custkey").cast("string")).alias("cves"), F.array("o_orderpriority").alias("families"), F.array("o_orderstatus").alias("categories"))
    return orders.join(lines, "o_orderkey", "left").withColumn("platforms", F.coalesce("platforms", F.array().cast("array<string>")))


EDGE_SQL = """
    WITH p AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    d AS (SELECT o_orderkey AS o, o_orderdate::DATE AS day, o_custkey AS cust, o_orderpriority AS prio, o_orderstatus AS status FROM orders),
    c AS (SELECT x.o AS a, y.o AS b FROM d x JOIN d y ON x.cust = y.cust AND x.o < y.o
          UNION SELECT x.o, y.o FROM p x JOIN p y ON x.part = y.part AND x.o < y.o JOIN d dx ON dx.o = x.o JOIN d dy ON dy.o = y.o WHERE abs(dx.day - dy.day) <= 120),
    s AS (SELECT DISTINCT x.o AS a, y.o AS b FROM c JOIN p x ON x.o = c.a JOIN p y ON y.o = c.b AND x.part = y.part),
    g AS (SELECT c.a, c.b, x.cust = y.cust AS cve, s.a IS NOT NULL AS part, x.prio = y.prio AS fam, x.status = y.status AS cat, abs(x.day - y.day) AS gap_days,
          CASE WHEN abs(x.day - y.day) <= 14 THEN 0.25 WHEN abs(x.day - y.day) <= 45 THEN 0.2 WHEN abs(x.day - y.day) <= 120 THEN 0.15 WHEN abs(x.day - y.day) <= 365 THEN 0.08 ELSE 0 END::DOUBLE AS near
          FROM c JOIN d x ON x.o = c.a JOIN d y ON y.o = c.b LEFT JOIN s ON s.a = c.a AND s.b = c.b),
    e AS (SELECT a, b, gap_days, round(CASE WHEN cve THEN 0.55::DOUBLE + near ELSE 0 END + CASE WHEN part AND gap_days <= 120 THEN 0.45::DOUBLE + near ELSE 0 END + CASE WHEN fam AND near >= 0.15 THEN 0.25::DOUBLE + near ELSE 0 END + CASE WHEN cat AND cve THEN 0.08::DOUBLE ELSE 0 END, 6) AS score,
          concat_ws('|', CASE WHEN cve THEN 'shared_cve' END, CASE WHEN part AND gap_days <= 120 THEN 'shared_vendor_or_platform' END, CASE WHEN fam AND near >= 0.15 THEN 'shared_ransomware_family_time_window' END, CASE WHEN cat AND cve THEN 'shared_attack_category' END) AS reasons FROM g)
    SELECT a, b, round(least(score, 1.0), 3) AS confidence, reasons, gap_days FROM e WHERE score >= 0.55
"""


@query("campaign_edges", EDGE_SQL)
def campaign_edges(spark, sf_dir):
    """Edges between orders by what they share and how near their days are; every order takes part."""
    return campaigns.campaign_edges(_profiles(spark, sf_dir), "o_orderkey").withColumn("gap_days", F.col("gap_days").cast("long"))


def _waves(spark, sf_dir):
    """Every order as an incident whose customer is, by thirds, a platform, a vendor or an actor."""
    third = lambda k: F.when(F.col("o_custkey") % 3 == k, F.array(F.concat(F.lit("c"), F.col("o_custkey")))).otherwise(F.array().cast("array<string>"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), third(0).alias("platforms"), third(1).alias("vendors"), third(2).alias("actors"), F.array("o_orderpriority").alias("families"), F.array("o_orderstatus").alias("categories"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status"), (F.col("o_totalprice") > 400000).alias("review"),
    )


def _campaigns(spark, sf_dir):
    found = _waves(spark, sf_dir)
    edges = campaigns.campaign_edges(found, "o_orderkey", SUPPLY, shared=True)
    return campaigns.campaigns(found, "o_orderkey", edges, supply_categories=SUPPLY)


SUPPLY = ("P",)
#: Edges, their components by a closure of each customer's own, members near the median day, and campaigns of them.
CAMPAIGN_SQL = """
    WITH RECURSIVE o AS (SELECT o_orderkey AS o, o_custkey AS c, o_custkey % 3 AS k, o_orderdate::DATE AS day, o_orderpriority AS prio, o_orderstatus AS status, o_orderstatus <> 'F' AND o_totalprice <= 400000 AS sure, o_totalprice > 400000 AS review FROM orders),
    p AS (SELECT x.o AS a, y.o AS b, x.c, x.k, abs(x.day - y.day) AS gap, x.prio = y.prio AS prio, x.status = y.status AS status, x.status = 'P' AND y.status = 'P' AS supply,
          CASE WHEN abs(x.day - y.day) <= 14 THEN 0.25 WHEN abs(x.day - y.day) <= 45 THEN 0.2 WHEN abs(x.day - y.day) <= 120 THEN 0.15 WHEN abs(x.day - y.day) <= 365 THEN 0.08 ELSE 0 END::DOUBLE AS near FROM o x JOIN o y ON x.c = y.c AND x.o < y.o),
    s AS (SELECT *, round(CASE WHEN k = 0 AND gap <= 120 THEN 0.45::DOUBLE + near WHEN k = 1 AND gap <= 180 THEN 0.45::DOUBLE + near WHEN k = 2 AND near >= 0.15 THEN 0.35::DOUBLE + near ELSE 0 END
          + CASE WHEN prio AND near >= 0.15 THEN 0.25::DOUBLE + near ELSE 0 END + CASE WHEN k = 0 AND supply THEN 0.12::DOUBLE WHEN k = 2 AND status THEN 0.08::DOUBLE ELSE 0 END, 6) AS score FROM p),
    e AS MATERIALIZED (SELECT a, b, c, k, round(least(score, 1.0), 3) AS confidence FROM s WHERE score >= 0.55),
    n AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(a, b) AS (SELECT a, b FROM n UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a),
    t AS MATERIALIZED (SELECT r.a AS member, min(r.b) AS comp, any_value(c) AS c, any_value(k) AS k, any_value(day) AS day, any_value(status) AS status, any_value(sure) AS sure, any_value(review) AS review FROM r JOIN o ON o.o = r.a GROUP BY 1),
    m AS (SELECT comp, day AS middle FROM t QUALIFY row_number() OVER (PARTITION BY comp ORDER BY day) = count(*) OVER (PARTITION BY comp) // 2 + 1 AND count(*) OVER (PARTITION BY comp) >= 3),
    w AS (SELECT t.*, coalesce(abs(t.day - middle) <= 120, TRUE) AS near FROM t LEFT JOIN m USING (comp)),
    x AS MATERIALIZED (SELECT * FROM w QUALIFY near OR count_if(near) OVER (PARTITION BY comp) < 2),
    i AS MATERIALIZED (SELECT u.comp, e.a, e.b, e.confidence FROM e JOIN x u ON u.member = e.a JOIN x v ON v.member = e.b AND u.comp = v.comp),
    y AS (SELECT comp, year(day) AS year FROM x GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY comp ORDER BY count(*) DESC, year(day) DESC) = 1),
    g AS (SELECT comp, any_value(c) AS c, any_value(k) AS k, count(*) AS member_count, count_if(sure)::BIGINT AS confirmed_member_count, min(day) AS first_seen, max(day) AS last_seen, string_agg(member::VARCHAR, '|' ORDER BY member::VARCHAR) AS ids FROM x GROUP BY 1),
    z AS (SELECT comp, ((2 * sum(round(confidence * 1000)::BIGINT) + count(*)) // (2 * count(*))) / 1000 AS mean FROM i GROUP BY 1),
    f AS MATERIALIZED (SELECT g.*, year::INTEGER AS year, 'c' || c || ' ' || year || CASE k WHEN 2 THEN ' education activity wave' ELSE ' education impact' END AS campaign_name, ['same_campaign', 'shared_vendor_incident', 'actor_activity_wave'][k + 1] AS campaign_type, coalesce(mean, 0) AS mean
          FROM g JOIN y USING (comp) LEFT JOIN z USING (comp) WHERE k <> 2 OR member_count >= 3),
    final AS MATERIALIZED (SELECT *, 'campaign_' || left(regexp_replace(lower(campaign_name), '[^a-z0-9]+', '-', 'g'), 48) || '_' || left(sha1(ids), 10) AS campaign_id FROM f)
"""


@query("campaign_groups", CAMPAIGN_SQL + "SELECT campaign_id, campaign_name, campaign_type, member_count, confirmed_member_count, member_count - confirmed_member_count AS evidence_only_member_count, first_seen, last_seen, year, CASE k WHEN 2 THEN 'c' || c ELSE '' END AS actors, mean AS confidence FROM final")
def campaign_groups(spark, sf_dir):
    """Campaigns of the orders that edges tie, less those far from the median day, with names, types and counts."""
    candidates, _ = _campaigns(spark, sf_dir)
    return candidates.select("campaign_id", "campaign_name", "campaign_type", "member_count", "confirmed_member_count", "evidence_only_member_count", "first_seen", "last_seen", "year", F.array_join("actors", "|").alias("actors"), "confidence")


@query(
    "campaign_roles",
    CAMPAIGN_SQL
    + """
    , own AS (SELECT comp, member, max(confidence) AS own FROM (SELECT comp, a AS member, confidence FROM i UNION ALL SELECT comp, b, confidence FROM i) GROUP BY 1, 2)
    SELECT campaign_id, x.member, CASE WHEN NOT x.sure THEN 'needs_review' WHEN x.k = 0 AND x.status = 'P' THEN 'affected_via_vendor' ELSE 'direct_victim' END AS role, coalesce(own, mean) AS confidence,
    CASE WHEN x.status = 'F' THEN 'excluded_evidence_only' WHEN x.review THEN 'manual_review_required' ELSE 'candidate_unreviewed' END AS review_status
    FROM final JOIN x USING (comp) LEFT JOIN own ON own.comp = x.comp AND own.member = x.member
    """,
)
def campaign_roles(spark, sf_dir):
    """Members of the campaigns with their part in it and what is to be reviewed."""
    return _campaigns(spark, sf_dir)[1].drop("day")


@query(
    "campaign_family_ids",
    CAMPAIGN_SQL
    + """
    , a AS (SELECT *, CASE k WHEN 2 THEN c || '|' || year(first_seen) ELSE campaign_id END AS fam FROM final),
    h AS (SELECT fam, 'family_' || left(sha1(string_agg(campaign_id, '|' ORDER BY campaign_id)), 10) AS family_id, count(*) - 1 AS related FROM a GROUP BY 1)
    SELECT campaign_id, family_id, related, row_number() OVER (PARTITION BY fam ORDER BY member_count DESC, mean DESC, campaign_id DESC) = 1 AS is_primary_in_family FROM a JOIN h USING (fam)
    """,
)
def campaign_family_ids(spark, sf_dir):
    """Families of the campaigns: waves of one actor in one year, or overlapping members; and the first of each."""
    named = campaigns.assign_families(*_campaigns(spark, sf_dir))
    return named.select("campaign_id", "family_id", F.size("related_campaign_ids").cast("long").alias("related"), "is_primary_in_family")


def _sql(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool | int) else "'" + x.replace("'", "''") + "'"


#: Phrases by kind, in order of preference within it: what the documents' own texts say of licences, insults and secrets, in four languages' common words.
SIGNALS = tuple((kind, label, rank, phrase) for rank, (kind, label, phrase) in enumerate((
    ("licence", "apache", "licensed under the Apache License"), ("licence", "gpl", "GNU General Public License"), ("licence", "mit", "MIT License"), ("licence", "mit", "permission is hereby granted"), ("licence", "creative_commons", "Creative Commons"), ("licence", "reserved", "all rights reserved"),
    ("insult", "person", "idiot"), ("insult", "person", "moron"), ("insult", "person", "clown"), ("insult", "worth", "worthless"), ("insult", "worth", "stupid"), ("insult", "threat", "hate you"),
    ("secret", "token", "token"), ("secret", "password", "password"), ("secret", "key", "api key"), ("secret", "key", "BEGIN PRIVATE KEY"),
    ("article", "en", "of the"), ("article", "fr", "de la"), ("article", "es", "de la"), ("article", "de", "für"), ("article", "es", "para"),
)))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_sql(x) for x in r) + ")" for r in rows)


_NORMAL = r"' ' || trim(regexp_replace(lower({}), '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+', ' ', 'g')) || ' '"


@query(
    "inferred_labels",
    f"""
    WITH s AS (SELECT kind, label, rank, {_NORMAL.format("phrase")} AS p FROM (VALUES {_values(SIGNALS)}) AS v(kind, label, rank, phrase)),
    d AS (SELECT doc_id, {_NORMAL.format("text")} AS t FROM documents), h AS (SELECT DISTINCT doc_id, kind, label, rank FROM d JOIN s ON contains(t, p))
    SELECT d.doc_id, min_by(label, rank) FILTER (kind = 'licence') AS licence, coalesce(string_agg(DISTINCT label, '|' ORDER BY label) FILTER (kind = 'insult'), '') AS insult,
    coalesce(string_agg(DISTINCT label, '|' ORDER BY label) FILTER (kind = 'article'), '') AS article, coalesce(bool_or(kind = 'secret'), FALSE) AS secret
    FROM d LEFT JOIN h ON h.doc_id = d.doc_id GROUP BY d.doc_id
    """,
)
def inferred_labels(spark, sf_dir):
    """What every document says of licences, insults, secrets and its language, in one reading."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    table = spark.createDataFrame(SIGNALS, "kind string, label string, rank int, phrase string")
    return infer.inferred(docs, "text", table, first=("licence",), every=("insult", "article"), flags=("secret",)).drop("text")


@query(
    "passage_mentions",
    f"""
    WITH w AS (SELECT item_id, string_split(trim({_NORMAL.format("text")}), ' ') AS w FROM benchmark), p AS (SELECT item_id, ' ' || array_to_string(w[1:6], ' ') || ' ' AS p FROM w WHERE len(w) >= 6),
    d AS (SELECT doc_id, {_NORMAL.format("text")} AS t FROM documents)
    SELECT doc_id, item_id, CAST(len(string_split(t[1:strpos(t, p)], ' ')) - 2 AS INTEGER) AS first_at FROM d JOIN p ON contains(t, p)
    """,
)
def passage_mentions(spark, sf_dir):
    """Documents that quote the first six words of a benchmark item, and where first; the table of phrases is the benchmark itself, so it is joined by hash."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[0-9a-z\x{80}-\x{10FFFF}]+"), F.lit(0))
    table = read(spark, sf_dir, "benchmark").select(F.lit("item").alias("kind"), F.col("item_id").cast("string").alias("label"), F.lit(0).alias("rank"), words.alias("w")).where(F.size("w") >= 6).select("kind", "label", "rank", F.array_join(F.slice("w", 1, 6), " ").alias("phrase"))
    hits = phrases.with_phrases(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", table, key="doc_id", most=0)
    return hits.select("doc_id", F.explode("hits").alias("h")).groupBy("doc_id", F.col("h.label").cast("long").alias("item_id")).agg(F.min("h.at").alias("first_at"))


#: Kinds of makers by what a part's name says, the first of equals first; and colours as places.
PART_KINDS = tuple((kind, label, rank, phrase) for rank, (kind, label, phrase) in enumerate((("institution", "toolmaker", "gear"), ("institution", "toolmaker", "bolt"), ("institution", "jeweller", "ring"), ("institution", "fitter", "small widget"), ("institution", "maker", "widget"))))


@query(
    "institution_kinds",
    f"""
    WITH s AS (SELECT label, rank, ' ' || phrase || ' ' AS p FROM (VALUES {_values(PART_KINDS)}) AS v(kind, label, rank, phrase)),
    h AS (SELECT p_partkey, min_by(label, rank) AS kind FROM part JOIN s ON contains(' ' || lower(p_name) || ' ', p) GROUP BY 1),
    r AS (SELECT DISTINCT p_type FROM part WHERE p_type IN (SELECT upper(w) FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)))
    SELECT part.p_partkey, coalesce(CASE WHEN p_size % 5 = 0 THEN p_brand END, kind) AS kind, r.p_type AS region FROM part LEFT JOIN h USING (p_partkey) LEFT JOIN r ON r.p_type = upper(split_part(p_name, ' ', 1))
    """,
)
def institution_kinds(spark, sf_dir):
    """Makers' kinds from the names of all parts, unless known, and the region of the first place that a name holds."""
    parts = read(spark, sf_dir, "part").withColumn("title", F.concat_ws(" ", F.transform(F.split("p_name", " "), F.initcap)))
    cities = parts.select(F.lower("p_type").alias("city"), F.lit("x").alias("country_code"), F.col("p_type").alias("region")).distinct()
    placed = vocab.with_region(parts, "title", cities)
    found = phrases.with_phrases(placed, "p_name", spark.createDataFrame(PART_KINDS, "kind string, label string, rank int, phrase string"))
    known = F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).otherwise("unknown")
    return found.select("p_partkey", F.nullif(infer.institution_kind(known, F.col("hits")), F.lit("unknown")).alias("kind"), "region")


@query("plain_letters", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def plain_letters(spark, sf_dir):
    """Every document's whole text without marks on its Latin letters."""
    return read(spark, sf_dir, "documents").select("doc_id", infer.ascii_fold(F.col("text")).alias("plain"))


TACTICS = (("T1566", "Initial Access"), ("T1078", "Initial Access"), ("T1078", "Defense Evasion"), ("T1486", "Impact"), ("T1003", "Credential Access"))


@query(
    "technique_tactics",
    f"""
    WITH t AS (SELECT event_id, ['t1566.001', 'T1078', ' T1486 ', 'T1003.002', 'T9999'][event_id % 5 + 1] AS technique FROM events)
    SELECT event_id, tactic FROM t JOIN (VALUES {", ".join(map(str, TACTICS))}) AS v(base, tactic) ON upper(trim(split_part(technique, '.', 1))) = base
    """,
)
def technique_tactics(spark, sf_dir):
    """Every event's technique with all its tactics."""
    ids = F.array(*[F.lit(x) for x in ("t1566.001", "T1078", " T1486 ", "T1003.002", "T9999")])
    rows = read(spark, sf_dir, "events").select("event_id", F.element_at(ids, (F.col("event_id") % 5 + 1).cast("int")).alias("technique"))
    return vocab.with_tactics(rows, "technique", spark.createDataFrame(TACTICS, "technique string, tactic string")).select("event_id", "tactic")


#: A phrase and, in SQL, the day that it names and how surely.
PHRASES = (
    ("Staff noticed it last Monday.", "d - CAST(CASE WHEN (isodow(d) - 1) % 7 = 0 THEN 7 ELSE (isodow(d) - 1) % 7 END AS INTEGER)", "approximate"), ("This past Friday it began", "d - CAST(CASE WHEN (isodow(d) + 2) % 7 = 0 THEN 7 ELSE (isodow(d) + 2) % 7 END AS INTEGER)", "approximate"),
    ("Yesterday, or 3 weeks ago", "d - 1", "day"), ("1 day ago", "d - 1", "day"), ("Eleven days ago", "d - 11", "approximate"), ("about 3  weeks ago", "d - 21", "approximate"), ("two months ago", "CAST(d - INTERVAL 2 MONTH AS DATE)", "month_only"),
    ("twelve years ago", "make_date(year(d) - 12, 1, 1)", "year_only"), ("last week", "d - 7", "approximate"), ("last month", "CAST(d - INTERVAL 1 MONTH AS DATE)", "month_only"), ("Last year", "make_date(year(d) - 1, 1, 1)", "year_only"),
    ("earlier this month", "make_date(year(d), month(d), 1)", "month_only"), ("earlier this year", "make_date(year(d), 1, 1)", "year_only"), ("on Monday staff", "NULL", None),
)


@query(
    "relative_dates",
    f"SELECT o_orderkey, CASE o_orderkey % {len(PHRASES)} {' '.join(f'WHEN {k} THEN {p[1]}' for k, p in enumerate(PHRASES))} END AS day, CASE o_orderkey % {len(PHRASES)} {' '.join(f'WHEN {k} THEN ' + ('NULL' if p[2] is None else repr(p[2])) for k, p in enumerate(PHRASES))} END AS precision FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)",
)
def relative_dates(spark, sf_dir):
    """Phrases, one given to every order, read against its day."""
    text = F.element_at(F.array(*[F.lit(p[0]) for p in PHRASES]), (F.col("o_orderkey") % len(PHRASES) + 1).cast("int"))
    day = dates.relative_day(text, F.to_date("o_orderdate"))
    return read(spark, sf_dir, "orders").select("o_orderkey", day["day"].alias("day"), day["precision"].alias("precision"))


@query("country_dim", "SELECT c_custkey, n_name AS country, CAST(n_nationkey AS VARCHAR) AS country_code, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def country_dim(spark, sf_dir):
    """Customers' places, written as names or codes, as one country with its region."""
    regions = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    countries = read(spark, sf_dir, "nation").join(regions, "n_regionkey").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.col("r_name").alias("region"), F.array(F.lower(F.replace("n_name", F.lit("_"), F.lit(" ")))).alias("aliases"))
    names = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = read(spark, sf_dir, "customer").join(names, "c_nationkey").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("c_nationkey").cast("string")).alias("place"))
    return vocab.with_country(rows, "place", countries).select("c_custkey", "country", "country_code", "region")


#: A label, a second one and a url, with what the rules make of them, in the columns' order below.
RULES = (
    ("LockBit 3.0", "Lock Bit", "https://news.google.com/rss/articles/x?y", "LockBit 3.0", False, "LockBit 3.0", "LockBit 3.0", False, "LockBit 3.0 | Lock Bit", True),
    ("lockbit-black", "", "http://www.news.google.com/articles/1", "LockBit 3.0", False, "lockbit-black", "lockbit-black", False, "lockbit-black", True),
    ("lockbit green", "lockbit green", "https://news.google.com/topics/1", "LockBit 2.0", False, "lockbit green", "lockbit green", False, "lockbit green", False),
    ("LockBit", None, "https://a.org/articles/1", "LockBit", False, "LockBit", "LockBit", False, "LockBit", False),
    ("Unnamed university", "Lake College", "nonsense", None, True, "Lake College", "Unnamed university", False, "Unnamed university | Lake College", False),
    ("several schools", "France", None, None, True, "several schools", "several schools", False, "several schools | France", False),
    ("Matthew D. Lane", "Lane", "", None, False, "Matthew D. Lane", "Matthew Lane", False, "Matthew D. Lane | Lane", False),
    ("Hacker Group", "unknown", "https://news.google.com/read/1", None, False, "Hacker Group", "Hacker Group", True, "Hacker Group | unknown", True),
    ("unknown", "Akira Group", "ftp://x", None, False, "Akira Group", "unknown", True, "unknown | Akira Group", False),
)


@query("identity_rules", f"SELECT event_id, v.family, v.generic_label, v.better, v.person, v.generic_actor, v.notes, v.wrapper, TRUE AS education, 'src' AS prefix FROM events JOIN (VALUES {', '.join(f'({k}, ' + ', '.join(map(_sql, r[3:])) + ')' for k, r in enumerate(RULES))}) AS v(k, family, generic_label, better, person, generic_actor, notes, wrapper) ON event_id % {len(RULES)} = v.k")
def identity_rules(spark, sf_dir):
    """The rules on labels, a set of them given to every event."""
    of = lambda nth: F.element_at(F.array(*[F.lit(r[nth]).cast("string") for r in RULES]), (F.col("event_id") % len(RULES) + 1).cast("int"))
    label, other, places = of(0), of(1), ("France",)
    return read(spark, sf_dir, "events").select(
        "event_id", identity.lockbit_family(label).alias("family"), identity.is_generic_label(label, places).alias("generic_label"), identity.better_name(label, other, places).alias("better"), identity.person_name(label).alias("person"),
        identity.is_generic_actor(label, ("akira",), ("hacker", "group", "hackers")).alias("generic_actor"), identity.merged_notes(label, other).alias("notes"), identity.is_wrapper_url(of(2)).alias("wrapper"),
        identity.has_education_category(F.array(F.lit("News"), F.lit("Education Sector"))).alias("education"), identity.source_prefix(F.lit("src_12")).alias("prefix"),
    )
