"""What the corpus operators share: reading tables, intermediate tables, what workers remember."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import discard, grows, keep, shared_dir

__all__ = ["BATCH_ROWS", "SPACES", "bounded_sample", "discard", "grows", "keep", "numbered", "session_of", "shared_dir", "table", "worker_store"]

#: The characters that part words: `[\x20\x09-\x0D]`.
SPACES = b" \t\n\x0b\x0c\r"
#: Rows in an Arrow batch; texts are long, so fewer than Spark's own 10,000.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session_of(df: DataFrame) -> SparkSession:
    """The frame's session, with Arrow batches small enough for long texts."""
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """A Parquet table with a long ``name`` that tells its rows apart and is the same in every read.

    It is made of the file's number and the row's place in the file, so it does not depend on
    how a scan is split among the cores of the moment. Other frames are written first.
    """
    file, at, nth = (f"{x}{len(docs.columns)}_{name}" for x in ("__file", "__at", "__nth"))
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    except AnalysisException:
        return numbered(keep(docs, "numbered"), name)
    paths = sorted(r[file] for r in docs.select(F.col("_metadata.file_path").alias(file)).distinct().collect())
    files = docs.sparkSession.createDataFrame(list(enumerate(paths)), f"`{nth}` long, `{file}` string")  # a row for each file
    return placed.join(F.broadcast(files), file).withColumn(name, F.shiftleft(nth, 40) + F.col(at)).select(*docs.columns, name)


def bounded_sample(df: DataFrame, draw: Column, rows: int) -> DataFrame:
    """``df``, or where it has over ``rows`` rows about that many, those of the lowest draws.

    The draw is a hash of what makes a row distinct; one count and a filter, no sort.
    """
    n = df.count()
    return df if n <= rows else df.where(F.pmod(draw, F.lit(1 << 30)) < int(rows / n * (1 << 30)))


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, shared by the tasks it runs in turn.

    A worker holds one operator's store: the first task of another operator drops it.
    """
    home = sys.modules.setdefault("_cairnflow_worker", types.ModuleType("_cairnflow_worker")).__dict__
    stores = home.setdefault("stores", {})
    if name not in stores:
        stores.clear()
        pa.default_memory_pool().release_unused()
    return stores.setdefault(name, {})
