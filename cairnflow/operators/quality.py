"""Data quality and evaluation: reasons, implausible values, confusion counts, field accuracy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column], mark: str = "; ") -> Column:
    """The names of the rules that a row breaks, in their order; an unknown test breaks nothing."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])), mark)


def cap_repeated(df: DataFrame, entity: str, value: str, least: float, repeats: int, ceiling: float) -> DataFrame:
    """``df`` with ``value`` null where it is a large value that many entities share, or beyond the ceiling."""
    shared = df.where(F.col(value) >= least).groupBy(value).agg(F.count_distinct(entity).alias("entities")).where(F.col("entities") >= repeats).select(value, F.lit(True).alias("shared"))
    marked = df.join(shared, value, "left")
    return marked.withColumn(value, F.when(F.coalesce("shared", F.lit(False)) | (F.col(value) >= ceiling), None).otherwise(F.col(value))).select(df.columns)


def confusion(df: DataFrame, gold: Column, predicted: Column, by: list[str] | None = None, z: float = 1.96, digits: int = 6) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f1, accuracy and accuracy's Wilson interval; pairs with a null are left out."""
    pairs = df.where(gold.isNotNull() & predicted.isNotNull())
    c = pairs.groupBy(*(by or [])).agg(F.count_if(gold & predicted).alias("tp"), F.count_if(~gold & predicted).alias("fp"), F.count_if(~gold & ~predicted).alias("tn"), F.count_if(gold & ~predicted).alias("fn"))
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    right = F.col("tp") + F.col("tn")
    low, high = wilson(right, n, z)
    zero = lambda x: F.round(F.coalesce(x, F.lit(0.0)), digits)
    return c.select(
        *(by or []), "tp", "fp", "tn", "fn",
        zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
        zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"),
        zero(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("f1"),
        zero(F.try_divide(right, n)).alias("accuracy"), zero(low).alias("ci_low"), zero(high).alias("ci_high"),
    )


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson's interval of a share; null for no trials."""
    share = F.try_divide(k.cast("double"), n.cast("double"))
    base = 1 + F.try_divide(F.lit(z * z), n.cast("double"))
    middle = (share + F.try_divide(F.lit(z * z), 2.0 * n)) / base
    half = F.sqrt(F.try_divide(share * (1 - share), n.cast("double")) + F.try_divide(F.lit(z * z), 4.0 * n * n)) * z / base
    return F.greatest(F.lit(0.0), middle - half), F.least(F.lit(1.0), middle + half)


def field_accuracy(df: DataFrame, pairs: dict[str, tuple[Column, Column]], digits: int = 6) -> DataFrame:
    """Rows (field, n, hits, accuracy) of gold and predicted fields; rows without gold are left out."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), gold.isNotNull().alias("has"), F.coalesce(gold.cast("string") == said.cast("string"), F.lit(False)).alias("hit")) for f, (gold, said) in pairs.items()])).alias("x"))
    return long.where("x.has").groupBy(F.col("x.field").alias("field")).agg(F.count("*").alias("n"), F.count_if("x.hit").alias("hits")).withColumn("accuracy", F.round(F.col("hits") / F.col("n"), digits))


def purge_counts(parents: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows (child, rows, orphans) of each child table: what a purge would delete."""
    counted = [c.join(parents.select(key, F.lit(True).alias("has")).distinct(), key, "left").agg(F.count("*").alias("rows"), F.count_if(F.col("has").isNull()).alias("orphans")).select(F.lit(name).alias("child"), "rows", "orphans") for name, c in children.items()]
    return reduce(DataFrame.unionByName, counted)
