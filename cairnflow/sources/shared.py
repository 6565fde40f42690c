"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset a folder of the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder within the shared folder, so that what reads ``target``'s parent finds it whole or not; one that is not there becomes an empty one."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if not (files.rename(old, new) if files.exists(old) else files.mkdirs(new)):
        raise OSError(f"{source} could not be moved to {target}")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    It cuts the lineage: a lost executor costs the tasks it ran, not all that came before.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def grows(df: DataFrame) -> DataFrame:
    """Marks a join side that grows with the data: merged by key, never broadcast on a guess from file sizes."""
    return df.hint("merge")


def discard(*frames: DataFrame) -> None:
    """Delete tables that ``keep`` wrote and no later plan reads."""
    plain = lambda path: path.split(":")[-1].strip("/")
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if plain(folder.rsplit("/", 1)[0]) == plain(shared_dir(spark)):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
