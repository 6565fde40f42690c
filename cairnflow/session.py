"""Session defaults: UTC, adaptive execution, Arrow transfer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings win over them."""
    builder = SparkSession.builder.config(map=DEFAULTS | conf)
    return (builder.master(master) if master else builder).getOrCreate()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
