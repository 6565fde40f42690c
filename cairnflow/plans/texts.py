"""Scalar work on names, urls, dates, JSON, indicators and sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import read
from .catalog import query

URL_SQL = r"""
  SELECT page_id, url, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
         regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.', '') AS host,
         regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_source|utm_medium|utm_campaign|utm_content|utm_term|ref|source|via|fbclid|gclid|mc_cid|mc_eid|_ga|_gl|ncid|ocid|sr_share|social)(=|$)')), '&') AS asked
  FROM (SELECT page_id, url, regexp_replace(trim(url), '#.*$', '') AS u FROM pages)
"""


@query("url_normalize", f"SELECT page_id, CASE WHEN scheme <> '' THEN scheme || '://' || host || path || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS normal FROM ({URL_SQL})")
def url_normalize(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", tx.normal_url(F.col("url")).alias("normal"))


@query(
    "url_dedup",
    f"""
    WITH n AS (SELECT page_id, host || path AS k FROM ({URL_SQL}))
    SELECT k AS url_key, min(page_id) AS keep_id, count(*) AS n FROM n GROUP BY 1 HAVING count(*) > 1
    """,
)
def url_dedup(spark, sf_dir):
    """Pages of one host and path, whatever their scheme and query."""
    normal = tx.normal_url(F.col("url"))
    key = F.regexp_replace(F.regexp_replace(normal, r"^[^:]*://", ""), r"\?.*$", "")
    return read(spark, sf_dir, "pages").select("page_id", key.alias("url_key")).groupBy("url_key").agg(F.min("page_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1")


KEY_SQL = "array_to_string(list_filter(string_split(translate(lower(trim({0})), '/- ', '___'), '_'), lambda x: x <> ''), '_')"


@query("slug_keys", f"SELECT p_partkey, nullif({KEY_SQL.format('p_name')}, '') AS key, nullif(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), '') AS tight, left(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 48) AS slug FROM part")
def slug_keys(spark, sf_dir):
    name = F.col("p_name")
    return read(spark, sf_dir, "part").select("p_partkey", tx.lookup_key(name).alias("key"), tx.tight_key(name).alias("tight"), tx.slug(name).alias("slug"))


@query(
    "alias_canon",
    """
    WITH a(alias, name) AS (VALUES ('1_urgent', 'Critical'), ('2_high', 'High'), ('3_medium', 'Medium'), ('5_low', 'Low'))
    SELECT coalesce(a.name, o_orderpriority) AS label, count(*) AS n
    FROM orders LEFT JOIN a ON a.alias = regexp_replace(translate(lower(trim(o_orderpriority)), '/- ', '___'), '_+', '_', 'g') GROUP BY 1
    """,
)
def alias_canon(spark, sf_dir):
    """Aliases become canonical names before counting; unknown names stay."""
    aliases = spark.createDataFrame([("1_urgent", "Critical"), ("2_high", "High"), ("3_medium", "Medium"), ("5_low", "Low")], "alias string, name string")
    counted = read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("c"))
    return counted.join(aliases, tx.lookup_key(F.col("o_orderpriority")) == F.col("alias"), "left").groupBy(F.coalesce("name", "o_orderpriority").alias("label")).agg(F.sum("c").alias("n"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), 'unknown') AS first_known FROM events")
def json_extract(spark, sf_dir):
    path = lambda p: F.get_json_object("props", p)
    return read(spark, sf_dir, "events").select("event_id", path("$.k").cast("long").alias("k"), F.coalesce(path("$.missing"), path("$.k"), F.lit("unknown")).alias("first_known"))


@query(
    "indicator_counts",
    r"""
    WITH i AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\s<>"''(),;]*(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[0-9a-fA-F]{32,128}|https?://[^\s<>"'']+')) AS v FROM documents)
    SELECT CASE WHEN regexp_matches(v, '^[0-9]{1,3}(\.[0-9]{1,3}){3}$') THEN 'ipv4' WHEN regexp_matches(v, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN 'email' WHEN regexp_matches(v, '^[0-9a-fA-F]{32}$') THEN 'md5'
                WHEN regexp_matches(v, '^[0-9a-fA-F]{40}$') THEN 'sha1' WHEN regexp_matches(v, '^[0-9a-fA-F]{64}$') THEN 'sha256' WHEN regexp_matches(v, '^[0-9a-fA-F]{128}$') THEN 'sha512'
                WHEN regexp_matches(v, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN 'url' ELSE 'other' END AS kind, count(*) AS n, count(DISTINCT v) AS n_values, count(DISTINCT doc_id) AS n_docs FROM i GROUP BY 1
    """,
)
def indicator_counts(spark, sf_dir):
    """Indicators of whole texts, classified in a fixed order."""
    shape = r"""[^\s<>"'(),;]*(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[0-9a-fA-F]{32,128}|https?://[^\s<>"']+"""
    found = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all(tx.indicator_words(F.col("text")), F.lit(shape), F.lit(0))).alias("v"))
    return found.groupBy(F.coalesce(tx.indicator_kind(F.col("v")), F.lit("other")).alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("v").alias("n_values"), F.count_distinct("doc_id").alias("n_docs"))


@query(
    "sentence_quotes",
    r"""
    SELECT doc_id, array_to_string(list_transform(list_slice(list_filter(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '' AND contains(lower(s), 'released under')), 1, 3), lambda s: left(s, 360)), ' | ') AS quotes
    FROM documents WHERE contains(lower(text), 'released under')
    """,
)
def sentence_quotes(spark, sf_dir):
    """The first three sentences that hold a term, from the documents that do."""
    docs = read(spark, sf_dir, "documents").where(F.contains(F.lower("text"), F.lit("released under")))
    return docs.select("doc_id", F.array_join(tx.quotes(F.col("text"), "released under"), " | ").alias("quotes"))


@query(
    "lenient_values",
    r"""
    SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-01') ELSE strftime(o_orderdate, '%Y-01-01') END, '%Y-%m-%d')::DATE AS day,
           CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'month' ELSE 'year' END AS precision, round(o_totalprice, 2) AS amount, o_orderkey % 2 = 0 AS flag FROM orders
    """,
)
def lenient_values(spark, sf_dir):
    """Dates of three precisions, amounts in free text and yes/no words, read back."""
    third = F.col("o_orderkey") % 3
    raw = F.when(third == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(third == 1, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy"))
    money = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    word = F.when(F.col("o_orderkey") % 2 == 0, " Yes").otherwise("no")
    return read(spark, sf_dir, "orders").select("o_orderkey", tx.lenient_date(raw).alias("day"), tx.date_precision(raw).alias("precision"), F.round(tx.lenient_number(money), 2).alias("amount"), tx.lenient_bool(word).alias("flag"))


@query("short_ids", "SELECT doc_id, source || '_' || left(sha256(concat_ws('|', source, CAST(doc_id AS VARCHAR))), 16) AS record_id FROM documents")
def short_ids(spark, sf_dir):
    """Deterministic record ids: the source and the start of a hash."""
    return read(spark, sf_dir, "documents").select("doc_id", tx.short_hash(F.col("source"), F.col("source"), F.col("doc_id").cast("string")).alias("record_id"))


@query(
    "exploded_terms",
    """
    WITH w AS (SELECT lang, doc_id, unnest(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ')) AS term FROM documents),
    g AS (SELECT lang, term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM w WHERE length(term) >= 4 GROUP BY 1, 2)
    SELECT lang, term, n, docs, row_number() OVER (PARTITION BY lang ORDER BY docs DESC, n DESC, term) AS rank FROM g QUALIFY row_number() OVER (PARTITION BY lang ORDER BY docs DESC, n DESC, term) <= 15
    """,
)
def exploded_terms(spark, sf_dir):
    """Terms by rows and by documents, the first fifteen of each language.

    Terms are counted in each document first: one shuffle row a document and term at most.
    """
    words = read(spark, sf_dir, "documents").select("lang", "doc_id", F.explode(F.filter(F.split(tx.match_text(F.col("text")), " "), lambda w: F.length(w) >= 4)).alias("term"))
    counts = words.groupBy("lang", "doc_id", "term").agg(F.count("*").alias("c")).groupBy("lang", "term").agg(F.sum("c").alias("n"), F.count("*").alias("docs"))
    from ..operators.ranking import top_per_group

    return top_per_group(counts, ["lang"], [F.desc("docs"), F.desc("n"), F.col("term")], 15)


@query(
    "html_titles",
    r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p>')) AS paragraphs, len(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS links FROM pages",
)
def html_titles(spark, sf_dir):
    """Title, paragraphs and distinct links of raw pages."""
    return read(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_count("html", F.lit("<p>")).cast("long").alias("paragraphs"),
        F.size(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))).cast("long").alias("links"),
    )


@query(
    "conversation_order",
    "SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS chars, arg_min(role, turn) AS opener FROM conversations GROUP BY 1",
)
def conversation_order(spark, sf_dir):
    """Turns in order; roles are short, texts stay out of the collected lists."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(F.transform(ordered, lambda x: x["role"]), ">").alias("roles"), F.sum(F.length("text")).alias("chars"), F.min_by("role", "turn").alias("opener"))


@query(
    "timeline_flatten",
    """
    WITH f AS (SELECT user_id, event_type, min(ts)::DATE AS day FROM events GROUP BY 1, 2)
    SELECT user_id, max(CASE WHEN event_type = 'signup' THEN day END) AS signup_day, max(CASE WHEN event_type = 'purchase' THEN day END) AS purchase_day,
           max(CASE WHEN event_type = 'purchase' THEN day END) - max(CASE WHEN event_type = 'signup' THEN day END) AS delay_days,
           CASE WHEN max(CASE WHEN event_type = 'purchase' THEN day END) - max(CASE WHEN event_type = 'signup' THEN day END) <= 3 THEN 'fast'
                WHEN max(CASE WHEN event_type = 'purchase' THEN day END) - max(CASE WHEN event_type = 'signup' THEN day END) <= 30 THEN 'slow' ELSE 'never' END AS level
    FROM f GROUP BY 1
    """,
)
def timeline_flatten(spark, sf_dir):
    """Each entity's first day per event kind, the delay between two kinds, and its level."""
    first = lambda kind: F.to_date(F.min(F.when(F.col("event_type") == kind, F.col("ts"))))
    days = read(spark, sf_dir, "events").groupBy("user_id").agg(first("signup").alias("signup_day"), first("purchase").alias("purchase_day"))
    delay = F.datediff("purchase_day", "signup_day").cast("long")
    return days.withColumn("delay_days", delay).withColumn("level", F.when(F.col("delay_days") <= 3, "fast").when(F.col("delay_days") <= 30, "slow").otherwise("never"))
