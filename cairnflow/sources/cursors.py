"""Where each source was read up to, and what comes after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def advanced(cursors: DataFrame | None, batch: DataFrame, source: str, marker: str) -> DataFrame:
    """Rows (source, marker): the largest marker of each source that the cursors or the batch hold; never back."""
    own = batch.where(F.col(marker).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.max(marker).alias("marker"))
    return own if cursors is None else cursors.unionByName(own).groupBy("source").agg(F.max("marker").alias("marker"))


def after(rows: DataFrame, cursors: DataFrame, source: str, marker: str) -> DataFrame:
    """Rows beyond their source's cursor; all rows of a source without one."""
    known = cursors.select(F.col("source").alias("__source"), F.col("marker").alias("__marker"))
    met = rows.join(known, F.col(source).eqNullSafe(F.col("__source")), "left")
    return met.where(F.col("__marker").isNull() | (F.col(marker) > F.col("__marker"))).drop("__source", "__marker")
