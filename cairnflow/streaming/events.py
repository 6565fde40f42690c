"""Structured Streaming over landed files: windows, sessions, keyed dedup, upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import new_path

#: The column of a changed row's batch.
BATCH = "__batch"


def event_stream(spark: SparkSession, folder: str, name: str, time: str, files_a_trigger: int | None = None, closing: str | None = None) -> DataFrame:
    """A file stream of ``name``.parquet in ``folder``; ``time`` becomes a timestamp, as watermarks ask for.

    ``closing`` is a second folder of the same schema: what ``close`` lands there ends the stream.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_a_trigger:
        reader = reader.option("maxFilesPerTrigger", files_a_trigger)
    rows = reader.parquet(folder)
    if closing:
        spark.createDataFrame([], schema).write.mode("append").parquet(closing)  # the folder is there before its first row
        rows = rows.unionByName(spark.readStream.schema(schema).parquet(closing))
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def close(spark: SparkSession, folder: str, name: str, time: str, closing: str, day: str = "9999-01-01") -> None:
    """Land a row of nulls at the end of time: the next run's watermark passes every window."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    spark.range(1).select(*[(F.lit(day) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(closing)


def _epochs(spark: SparkSession, base: str, prefix: str = "") -> list[int]:
    """The finished batches of a folder, by their numbers, which follow ``prefix`` in their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    named = [s.getPath() for s in files.listStatus(path)]
    done = [p for p in named if p.getName().startswith(prefix) and p.getName()[len(prefix) :].isdigit()]
    return sorted(int(p.getName()[len(prefix) :]) for p in done if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def run(stream: DataFrame, mode: str, out: str, checkpoint: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what has landed since its checkpoint, and read the table that it leaves in ``out``.

    In append mode every batch adds rows once. In update mode each batch writes the rows that
    changed under its number, and of each of ``keys`` the row of the last batch counts; a
    batch that is run again overwrites its own rows alone.
    """
    spark = stream.sparkSession
    if mode == "append":
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def changed(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={epoch}")

    stream.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    done = _epochs(spark, out, f"{BATCH}=")
    if not done:
        return spark.createDataFrame([], stream.schema)
    # One scan of all finished batches; the batch is a column of the folder.
    rows = spark.read.option("basePath", out).schema(T.StructType([*stream.schema, T.StructField(BATCH, T.LongType())])).parquet(*[f"{out}/{BATCH}={epoch}" for epoch in done])
    values = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("__last"))
    return last.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in values]).select(stream.columns)


def drain(stream: DataFrame, mode: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """``run`` with a fresh table and checkpoint in the shared folder."""
    spark = stream.sparkSession
    return run(stream, mode, new_path(spark, label), new_path(spark, f"{label}-checkpoint"), keys)


def tumbling(stream: DataFrame, time: str, width: str, by: list[str], late: str) -> DataFrame:
    """Counts by window and key; rows later than the watermark are dropped in append mode."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")


def sliding(stream: DataFrame, time: str, width: str, slide: str, late: str) -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "n")


def sessions(stream: DataFrame, time: str, gap: str, key: str, late: str) -> DataFrame:
    """Runs of a key's rows with less than ``gap`` between neighbours."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), "n")


def first_seen(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """Each key once; the state of a key is kept as long as the watermark lets a copy come."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def states(stream: DataFrame, label: str, state: Callable[[DataFrame], DataFrame], out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The partial states of all batches, to be merged by whoever reads them.

    Each batch writes its own state under its number and reads no other, so nothing is
    written again; with ``out`` and ``checkpoint`` named, a later run adds to them.
    """
    spark = stream.sparkSession
    base, checkpoint = out or new_path(spark, label), checkpoint or new_path(spark, f"{label}-checkpoint")
    stream.writeStream.foreachBatch(lambda batch, epoch: state(batch).write.mode("overwrite").parquet(f"{base}/{epoch}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(*[f"{base}/{epoch}" for epoch in _epochs(spark, base)])


def merge_into(stream: DataFrame, label: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Merge every batch into the current table: the stateful ingest step.

    ``merge`` gets the current table (None at first) and the batch. Version N is made of the
    last finished version before N and batch N, and older ones are dropped once it stands, so
    a failed or repeated batch leaves the table whole. With ``out`` and ``checkpoint`` named,
    a later run goes on where the last one ended.
    """
    spark = stream.sparkSession
    base, checkpoint = out or new_path(spark, label), checkpoint or new_path(spark, f"{label}-checkpoint")

    def step(batch: DataFrame, epoch: int) -> None:
        before = [e for e in _epochs(spark, base) if e < epoch]
        current = spark.read.parquet(f"{base}/{before[-1]}") if before else None
        merge(current, batch).write.mode("overwrite").parquet(f"{base}/{epoch}")
        for old in before[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{old}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/{_epochs(spark, base)[-1]}")
