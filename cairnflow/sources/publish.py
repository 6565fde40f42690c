"""Published tables: a version is whole or not there, and readers see one version at a time.

Rows go to a folder of their own first; then a manifest that nobody has written under that number
names the folder. Two writers can't take one number, and a job that dies before its manifest leaves
nothing that a reader sees.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .export import flat

FORMS = ("csv", "json", "parquet")


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions published there, in order."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n[len("manifest-") : -len(".json")]) for n in names if n.startswith("manifest-") and n.endswith(".json"))


def publish(df: DataFrame, path: str, form: str = "parquet", columns: list[str] | None = None, version: int | None = None) -> int:
    """Write the columns in their order as the next version, or as ``version``; the version's number.

    A column that the frame lacks is written as nulls. Arrays, maps and structs are flattened for CSV. A
    number that is taken raises FileExistsError, and the rows written for it are left aside.
    """
    if form not in FORMS:
        raise ValueError(f"no such format: {form}")
    spark = df.sparkSession
    rows = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]) if columns else df
    rows = flat(rows) if form == "csv" else rows
    seen = Observation("published")
    folder = f"rows-{uuid.uuid4().hex}"
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if form == "csv":
        counted.write.csv(f"{path}/{folder}", header=True, nullValue="", quoteAll=True, escape='"')
    else:
        getattr(counted.write, form)(f"{path}/{folder}")
    number = version if version is not None else (versions(spark, path) or [0])[-1] + 1
    files, _ = _files(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-{number}.json")
    if files.exists(target):
        raise FileExistsError(f"version {number} of {path} is published")
    manifest = json.dumps({"version": number, "folder": folder, "form": form, "rows": seen.get["rows"], "schema": json.loads(rows.schema.json())})
    out = files.create(target, False)  # fails where another writer was faster
    out.write(bytearray(manifest.encode()))
    out.close()
    return number


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """What the manifest of a version, the last by default, says."""
    number = version if version is not None else (versions(spark, path) or [None])[-1]
    if number is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    return json.loads(spark.read.text(f"{path}/manifest-{number}.json", wholetext=True).first().value)


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version's rows, typed as they were written; CSV files that were cut or changed since fail to read."""
    said = manifest(spark, path, version)
    schema = T.StructType.fromJson(said["schema"])
    reader = spark.read.schema(schema)
    if said["form"] == "csv":
        return reader.csv(f"{path}/{said['folder']}", header=True, nullValue="", emptyValue="", quote='"', escape='"', multiLine=True, mode="FAILFAST", enforceSchema=False)
    return getattr(reader, said["form"])(f"{path}/{said['folder']}")
