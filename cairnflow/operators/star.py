"""The star schema: facts, dimensions with keys made from their slugs, bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cves, indicator_kind, lenient_bool, lenient_date, lenient_number, lookup_key


def dimension_key(c: Column) -> Column:
    """A surrogate key that every run makes alike."""
    return F.when(lookup_key(c).isNotNull(), F.xxhash64(lookup_key(c)))


def dimension(df: DataFrame, column: str, vocabulary: list[str] | None = None) -> DataFrame:
    """Rows (key, slug, label, in_vocabulary): the members in use and the seeded ones."""
    rows = df.select(F.col(column).alias("label")).where("label IS NOT NULL").groupBy(lookup_key(F.col("label")).alias("slug")).agg(F.min("label").alias("label"))
    if vocabulary:
        seed = df.sparkSession.createDataFrame([(v, v.replace("_", " ").title()) for v in vocabulary], "slug string, label string")
        rows = rows.unionByName(seed.join(rows.select("slug"), "slug", "left_anti"))
    known = F.col("slug").isin(vocabulary) if vocabulary else F.lit(False)
    return rows.where("slug IS NOT NULL").select(F.xxhash64("slug").alias("key"), "slug", "label", known.alias("in_vocabulary"))


def facts(documents: DataFrame, key: str, dims: list[str], numbers: list[str], flags: list[str], dates: list[str], json: str = "projection") -> DataFrame:
    """One fact a record: dimension keys, numbers, flags and dates read leniently from a JSON projection."""
    at = lambda f: F.get_json_object(json, f"$.{f}")
    last = lambda f: f.rsplit(".", 1)[-1]
    return documents.select(
        key,
        *[dimension_key(at(f)).alias(f"{last(f)}_key") for f in dims],
        *[lenient_number(at(f)).alias(last(f)) for f in numbers],
        *[lenient_bool(at(f)).alias(last(f)) for f in flags],
        *[lenient_date(at(f)).alias(last(f)) for f in dates],
    )


def bridge(documents: DataFrame, key: str, path: str, json: str = "projection") -> DataFrame:
    """Rows (key, slug): the distinct values of a JSON list; a single text counts as a list of one."""
    raw = F.get_json_object(json, f"$.{path}")
    values = F.coalesce(F.from_json(raw, "array<string>"), F.when(raw.isNotNull(), F.array(raw)))
    return documents.select(key, F.explode(values).alias("v")).select(key, lookup_key(F.col("v")).alias("slug")).where("slug IS NOT NULL").distinct()


def techniques(documents: DataFrame, key: str, path: str = "mitre_attack_techniques", json: str = "projection") -> DataFrame:
    """Rows (key, technique_id, tactic, name): well-formed ids, the last of equals."""
    found = F.from_json(F.get_json_object(json, f"$.{path}"), "array<struct<technique_id:string,technique_name:string,tactic:string>>")
    rows = documents.select(key, F.posexplode(found).alias("pos", "t")).select(key, "pos", F.upper(F.trim("t.technique_id")).alias("technique_id"), F.col("t.tactic").alias("tactic"), F.col("t.technique_name").alias("name"))
    last = F.max_by(F.struct("tactic", "name"), "pos").alias("x")
    return rows.where(F.regexp_like("technique_id", F.lit(r"^T\d{4}(\.\d{3})?$"))).groupBy(key, "technique_id").agg(last).select(key, "technique_id", "x.tactic", "x.name")


def flaws(documents: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """Rows (key, cve) from structured and free text."""
    return documents.select(key, F.explode(cves(F.concat_ws(" ", *texts))).alias("cve")).distinct()


def indicators(documents: DataFrame, key: str, path: str = "iocs", json: str = "projection") -> DataFrame:
    """Rows (key, kind, value) of indicators that are of a known kind."""
    found = F.from_json(F.get_json_object(json, f"$.{path}"), "array<string>")
    return documents.select(key, F.explode(found).alias("value")).select(key, indicator_kind(F.col("value")).alias("kind"), F.trim("value").alias("value")).where("kind IS NOT NULL").distinct()


def weaknesses(documents: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """Rows (key, cwe) of the weakness ids that texts name, without leading zeros."""
    found = F.regexp_extract_all(F.concat_ws(" ", *texts), F.lit(r"(?i)\bCWE-0*([1-9]\d{0,4})\b"), F.lit(1))
    return documents.select(key, F.explode(F.array_distinct(found)).alias("n")).select(key, F.concat(F.lit("CWE-"), "n").alias("cwe"))


def readiness(documents: DataFrame, key: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (table, missing, orphans, ready): per table of the layer the documents without a row and the keys without a document."""
    rows = None
    for name, table in tables.items():
        own = table.select(F.col(key).alias("k"), F.lit(1).alias("here")).distinct()
        both = documents.select(F.col(key).alias("k"), F.lit(1).alias("known")).distinct().join(own, "k", "full")
        one = both.agg(F.count_if(F.col("here").isNull()).alias("missing"), F.count_if(F.col("known").isNull()).alias("orphans")).select(F.lit(name).alias("table"), "missing", "orphans", ((F.col("missing") == 0) & (F.col("orphans") == 0)).alias("ready"))
        rows = one if rows is None else rows.unionByName(one)
    return rows
