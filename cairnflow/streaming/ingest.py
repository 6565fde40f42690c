"""Stateful ingest of observations: cleaned, checked for lateness, and merged by event, url, or name and day.

What earlier batches decided is kept as keyed tables, parted by a hash of the key and by the
batch; a batch reads only the parts that its own keys fall into and only batches before
it, and writes under its own number. So a batch that is run again leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import discard, grows, keep

#: Parts of each table; which of them a batch falls into is told as the bits of a long, so 63 at most.
BUCKETS = 32
STORES = {"events": "event_id long", "urls": "url string, incident_id long", "names": "name string, day date, incident_id long", "accepted": "event_id long, url string, name string, ts timestamp, incident_id long, step string", "late": "event_id long, url string, name string, ts timestamp", "rejected": "event_id long, url string, name string, ts timestamp", "marks": "high timestamp"}


def _there(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def store(spark: SparkSession, base: str, name: str, before: int | None = None, parts: list[int] | None = None) -> DataFrame:
    """One table of the store: all of it, or what batches before ``before`` wrote, in the parts named."""
    path, schema = f"{base}/{name}", STORES[name]
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, bucket int, epoch long").parquet(path)
    rows = rows if before is None else rows.where(F.col("epoch") < before)
    return (rows if parts is None else rows.where(F.col("bucket").isin(parts))).drop("bucket", "epoch")


def _bucket(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _put(df: DataFrame, base: str, name: str, epoch: int, *keys: str) -> None:
    """Write a batch's rows; those of one part meet first, so that a part is one file and not one of every task. Without keys all is one part."""
    placed = df.withColumn("bucket", _bucket(*[F.col(k) for k in keys])).repartition("bucket") if keys else df.withColumn("bucket", F.lit(0))
    placed.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "bucket").parquet(f"{base}/{name}")


def _parts(*keys: str, where: Column | None = None) -> Column:
    """The parts that rows fall into, as the bits of a long."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bucket(*[F.col(k) for k in keys]))
    return F.bit_or(bit if where is None else F.when(where, bit)).alias("parts")


def _known(spark: SparkSession, base: str, name: str, epoch: int, seen: Observation) -> DataFrame:
    """What the table says of the batch's keys, whose parts were observed as they were written."""
    bits = seen.get.get("parts") or 0
    return store(spark, base, name, epoch, [b for b in range(BUCKETS) if bits >> b & 1])


def step(batch: DataFrame, epoch: int, base: str, late: str = "2 days") -> None:
    """Take a batch (event_id, url, name, ts) in, in six steps.

    1. Rows without an id, a name or a time are rejected. 2. Rows older than ``late`` before the newest
    of earlier batches go to the table of late ones. 3. Events that were taken, in this batch or before, are
    dropped. 4. A url that is known leads to its incident. 5. Of the rest, each url's first event stands for
    it and joins the incident of its name and day. 6. Where there is none, it is made, under the smallest of
    the events that stand for urls of that name and day. An event without a url has one of its own.

    What is known of a key is one more row of its group and not a table to join. Events move by id once; then
    each url is one row until its incident is known, and the events meet that.
    """
    spark = batch.sparkSession
    rows = batch.select(F.col("event_id").cast("long").alias("event_id"), F.coalesce("url", F.concat(F.lit("event:"), F.col("event_id").cast("string"))).alias("url"), F.trim("name").alias("name"), F.col("ts").cast("timestamp").alias("ts"))
    whole = F.col("event_id").isNotNull() & (F.coalesce(F.col("name"), F.lit("")) != "") & F.col("ts").isNotNull()
    high = store(spark, base, "marks", epoch).agg(F.max("high").alias("high")).first().high
    limit = F.lit(high).cast("timestamp") - F.expr(f"INTERVAL {late}") if high is not None else F.lit(None).cast("timestamp")
    kind = F.when(~whole, "rejected").when(F.col("ts") < limit, "late").otherwise("timely")
    ids, urls_of, names_of = Observation(), Observation(), Observation()
    told = [_parts("event_id", where=F.col("kind") == "timely"), F.max(F.when(F.col("kind") != "rejected", F.col("ts"))).alias("high"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("late", "rejected")]]
    rows = keep(rows.withColumn("kind", kind).observe(ids, *told), "batch")
    timely = rows.where("kind = 'timely'").select("event_id", F.struct("ts", "url", "name").alias("x"), F.lit(False).alias("known"))
    taken = _known(spark, base, "events", epoch, ids).select("event_id", F.lit(None).alias("x"), F.lit(True).alias("known"))
    once = timely.union(taken).groupBy("event_id").agg(F.min("x").alias("x"), F.max("known").alias("known")).where("NOT known")
    fresh = keep(once.select("event_id", "x.url", "x.name", "x.ts").observe(urls_of, _parts("url")), "fresh")
    standing = fresh.select("url", F.struct(F.col("event_id").alias("head"), "name", F.to_date("ts").alias("day")).alias("x"), F.lit(None).cast("long").alias("incident_id"))
    of_url = _known(spark, base, "urls", epoch, urls_of).select("url", F.lit(None).alias("x"), "incident_id")
    met = standing.union(of_url).groupBy("url").agg(F.min("x").alias("x"), F.min("incident_id").alias("incident_id")).where("x IS NOT NULL")
    urls = keep(met.select("url", "x.head", "x.name", "x.day", "incident_id").observe(names_of, _parts("name", where=F.col("incident_id").isNull())), "urls")
    unled = urls.where("incident_id IS NULL").drop("incident_id")
    of_name = _known(spark, base, "names", epoch, names_of).select("name", "day", F.lit(None).alias("head"), "incident_id")
    groups = unled.select("name", "day", "head", F.lit(None).cast("long").alias("incident_id")).union(of_name).groupBy("name", "day").agg(F.min("head").alias("new_id"), F.min("incident_id").alias("old_id")).where("new_id IS NOT NULL")
    groups = groups.select("name", "day", F.coalesce("old_id", "new_id").alias("incident_id"), F.when(F.col("old_id").isNotNull(), "name_date").otherwise("new").alias("step"))
    led = keep(unled.join(grows(groups), ["name", "day"]).select("url", "incident_id", "step", "head", "name", "day"), "led")
    decided = urls.where("incident_id IS NOT NULL").select("url", "incident_id", F.lit("url").alias("step")).unionByName(led.select("url", "incident_id", "step"))
    _put(fresh.join(grows(decided), "url").select("event_id", "url", "name", "ts", "incident_id", "step"), base, "accepted", epoch)
    _put(led.select("url", "incident_id"), base, "urls", epoch, "url")
    _put(led.where("step = 'new' AND head = incident_id").select("name", "day", "incident_id"), base, "names", epoch, "name")
    _put(fresh.select("event_id"), base, "events", epoch, "event_id")
    for k in ("late", "rejected"):
        if ids.get.get(k):
            _put(rows.where(F.col("kind") == k).drop("kind"), base, k, epoch)
    if ids.get.get("high") is not None:
        _put(rows.where("kind <> 'rejected'").agg(F.max("ts").alias("high")), base, "marks", epoch)
    discard(rows, fresh, urls, led)


def ingest(stream: DataFrame, base: str, late: str = "2 days") -> None:
    """Take in what has landed since the checkpoint under ``base``."""
    stream.writeStream.foreachBatch(lambda batch, epoch: step(batch, epoch, base, late)).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def incidents(spark: SparkSession, base: str) -> DataFrame:
    """(incident_id, events, urls, first_ts) as they stand; each url is one row of its table, so none is told apart again."""
    events = store(spark, base, "accepted").select("incident_id", F.lit(1).alias("event"), F.lit(0).alias("url"), "ts")
    urls = store(spark, base, "urls").select("incident_id", F.lit(0).alias("event"), F.lit(1).alias("url"), F.lit(None).cast("timestamp").alias("ts"))
    return events.unionByName(urls).groupBy("incident_id").agg(F.sum("event").alias("events"), F.sum("url").alias("urls"), F.min("ts").alias("first_ts"))
