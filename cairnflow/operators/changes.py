"""A choice of one member per record, kept up to date: only records whose members changed are chosen anew.

Two tables in the shared folder, both parted by a hash of the record: ``members``, to which
changes are added with a version, and ``selected``, of which only the parts of touched
records are read and written again. The present choice stays unless it is outscored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import discard, grows, keep

#: Parts of both tables.
BUCKETS = 64


def _parted(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("record"), F.lit(buckets)).cast("int"))


def _best(members: DataFrame) -> DataFrame:
    """(record, best, best_score): the valid member of the highest score, null scores last, ties to the smaller member."""
    order = F.struct(F.col("score").isNull().alias("none"), (-F.col("score")).alias("less"), F.col("member").alias("m"))
    return members.where("valid").groupBy("record").agg(F.min_by(F.struct("member", "score"), order).alias("b")).select("record", F.col("b.member").alias("best"), F.col("b.score").alias("best_score"))


def reselect(present: DataFrame, members: DataFrame, touched: DataFrame) -> DataFrame:
    """(record, member, score) of the ``touched`` records: the present choice unless it is no longer valid or outscored.

    ``present``: record, member; ``members``: record, member, score, valid, one row a member. A record
    without a valid member has a null one.
    """
    own = members.join(touched, "record", "left_semi")
    best = _best(own)
    now = present.where("member IS NOT NULL").select("record", "member").join(own.where("valid").select("record", "member", "score", F.lit(True).alias("stands")), ["record", "member"])
    met = touched.join(best, "record", "left").join(now, "record", "left")
    stays = F.col("stands") & (F.col("score") >= F.col("best_score")) | F.col("stands") & F.col("best_score").isNull()
    return met.select("record", F.when(F.coalesce(stays, F.lit(False)), F.col("member")).otherwise(F.col("best")).alias("member"), F.when(F.coalesce(stays, F.lit(False)), F.col("score")).otherwise(F.col("best_score")).alias("score"))


def _write(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def start(members: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Lay down both tables from ``members`` (record, member, score, valid; null valid counts as false).

    Rows without a record or member are left out; of a member given twice the valid one of the highest score counts.
    """
    rows = keep(_parted(_once(members), buckets).withColumn("version", F.lit(0).cast("long")), "members")
    _write(rows, f"{path}/members", "overwrite")
    every = rows.select("record").distinct()
    _write(_parted(every.join(_best(rows), "record", "left").select("record", F.col("best").alias("member"), F.col("best_score").alias("score")), buckets), f"{path}/selected", "overwrite")
    discard(rows)


def _once(members: DataFrame) -> DataFrame:
    valid = F.coalesce(F.col("valid"), F.lit(False))
    rank = F.struct(valid.alias("v"), F.col("score").isNotNull().alias("s"), "score")
    return members.where("record IS NOT NULL AND member IS NOT NULL").groupBy("record", "member").agg(F.max_by(F.struct("score", valid.alias("valid")), rank).alias("x")).select("record", "member", "x.score", "x.valid")


def change(spark: SparkSession, path: str, changes: DataFrame, version: int, buckets: int = BUCKETS) -> DataFrame:
    """Add ``changes`` (record, member, score, valid) and choose anew for their records; the new choices are returned.

    A later version of a member replaces the earlier. A step that is run again with its version
    gives the same tables. At most ``buckets`` numbers come to the driver: the parts to read.
    """
    fresh = keep(_parted(_once(changes), buckets).withColumn("version", F.lit(version).cast("long")), "changes")
    touched = fresh.select("record").distinct()
    parts = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if not parts:
        return fresh.select("record", "member", "score")
    _write(fresh.withColumn("score", F.col("score").cast("double")), f"{path}/members", "append")
    known = spark.read.parquet(f"{path}/members").where(F.col("bucket").isin(parts) & (F.col("version") <= version))
    latest = known.join(grows(touched), "record", "left_semi").groupBy("record", "member").agg(F.max_by(F.struct("score", "valid"), "version").alias("x")).select("record", "member", "x.score", "x.valid")
    present = spark.read.parquet(f"{path}/selected").where(F.col("bucket").isin(parts))
    made = keep(reselect(present, latest, touched), "reselected")
    rest = keep(present.join(grows(touched), "record", "left_anti").select("record", "member", "score").unionByName(made), "rewritten")
    _write(_parted(rest, buckets), f"{path}/selected", "overwrite")
    discard(fresh, rest)
    return made


def selected(spark: SparkSession, path: str) -> DataFrame:
    """The choices as they stand: record, member (null where none is valid), score."""
    return spark.read.parquet(f"{path}/selected").select("record", "member", "score")
