"""Sinks and export shapes: flat CSV, JSON lines, key lists, STIX objects, metric text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame, mark: str = "|") -> DataFrame:
    """Arrays joined, maps and structs as JSON: what a CSV file can hold."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out.append(F.array_join(f.name, mark).alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write(df: DataFrame, path: str, form: str) -> None:
    """A folder of CSV, JSON lines or Parquet, as many files as the plan has tasks."""
    if form == "csv":
        flat(df).write.csv(path, header=True, nullValue="")
    elif form == "json":
        df.write.json(path)
    elif form == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"no such format: {form}")


def indicator_lists(df: DataFrame) -> DataFrame:
    """Rows (list, key): distinct lower-case actors, families and countries, and validated upper-case CVEs."""
    low = lambda kind, c: df.select(F.lit(kind).alias("list"), F.lower(F.trim(c)).alias("key"))
    cves = df.select(F.lit("cve").alias("list"), F.explode(F.split("cves", r"\|")).alias("raw")).select("list", F.upper(F.trim("raw")).alias("key")).where(F.regexp_like("key", F.lit(r"^CVE-\d{4}-\d{4,7}$")))
    return low("actor", "actor").union(low("family", "family")).union(low("country", "country")).union(cves).where("key <> ''").distinct()


def _uuid(digest: Column) -> Column:
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def stix_objects(lists: DataFrame) -> DataFrame:
    """Rows (id, json): one STIX 2.1 object for each key, the id made from the key alone."""
    kind = F.when(F.col("list") == "actor", "threat-actor").when(F.col("list") == "family", "malware").when(F.col("list") == "cve", "vulnerability").otherwise("location")
    name = F.concat(kind, F.lit("--"), _uuid(F.sha1(F.concat_ws(":", "list", "key"))))
    return lists.select(name.alias("id"), F.to_json(F.struct(kind.alias("type"), F.lit("2.1").alias("spec_version"), name.alias("id"), F.col("key").alias("name"))).alias("json"))


def stix_relationships(pairs: DataFrame, kind: str, a_list: str, b_list: str) -> DataFrame:
    """Rows (id, json): one STIX 2.1 relationship for each pair (a, b) of keys of two lists."""
    ends = [stix_objects(pairs.select(F.lit(name).alias("list"), F.col(c).alias("key")).distinct()).select("id", F.get_json_object("json", "$.name").alias(c)).withColumnRenamed("id", f"{c}_id") for c, name in (("a", a_list), ("b", b_list))]
    tied = pairs.select("a", "b").distinct().join(ends[0], "a").join(ends[1], "b")
    name = F.concat(F.lit("relationship--"), _uuid(F.sha1(F.concat_ws(":", "a_id", F.lit(kind), "b_id"))))
    return tied.select(name.alias("id"), F.to_json(F.struct(F.lit("relationship").alias("type"), F.lit("2.1").alias("spec_version"), name.alias("id"), F.lit(kind).alias("relationship_type"), F.col("a_id").alias("source_ref"), F.col("b_id").alias("target_ref"))).alias("json"))


def prometheus(metrics: DataFrame) -> DataFrame:
    """Lines of metric text from (name, label, value); backslashes, quotes and line feeds of labels are escaped."""
    label = F.replace(F.replace(F.replace("label", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return metrics.select(F.format_string('%s{source="%s"} %s', "name", label, F.col("value").cast("string")).alias("value"))


def feed_items(spark, path: str, row_tag: str = "item") -> DataFrame:
    """Items of landed RSS files: title, link, categories and the publication time."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "pubDate", "guid")]).add("category", T.ArrayType(T.StringType()))
    items = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    plain = F.regexp_replace("pubDate", r"^[A-Za-z]{3},\s*", "")
    when = F.coalesce(F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp("pubDate", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp("pubDate", F.lit("yyyy-MM-dd")))
    return items.select(F.trim("title").alias("title"), F.trim("link").alias("link"), F.coalesce("guid", "link").alias("event_key"), "category", when.alias("published_at"))
