"""Mergeable profiles: stored sketches per day, merged for any range of days (AGG-01, AGG-04, AGG-23).

The exact reports read all rows, and exact quantiles and distinct counts shuffle them, each time they are
asked for. Here every day is read once: distinct-count sketches (HLL) of each column and quantile
sketches (KLL) of each value and group are written by day. A report over any range merges the days'
sketches, a few kilobytes each, and never touches the rows again. A day that is written again replaces
its own sketches. Counts of rows and nulls are exact; sketches keep to the stated errors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: log2 of an HLL sketch's buckets, and accuracy parameter of a KLL sketch.
HLL_K, KLL_K = 14, 800
_PROFILE = "column_name string, dtype string, rows long, nulls long, sketch binary, day date"
_QUANTILES = "group string, value_name string, rows long, sketch binary, day date"


def distinct_error(k: int = HLL_K) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / math.sqrt(1 << k)


def rank_error(k: int = KLL_K) -> float:
    """A KLL quantile's rank lies this close to the one asked for (99 % confidence)."""
    return 2.296 / k ** 0.9021


def _sketchable(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    return F.col(column) if kind in ("int", "bigint", "string") else F.col(column).cast("string")


def profile_by_day(df: DataFrame, day: Column, columns: list[str] | None = None, k: int = HLL_K) -> DataFrame:
    """Rows, nulls and a distinct-count sketch of every column, by day (one pass, partial sketches combined)."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.col(c)).alias(f"_nn{i}"), F.hll_sketch_agg(_sketchable(df, c), F.lit(k)).alias(f"_s{i}")]
    wide = df.withColumn("_day", day).groupBy("_day").agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"), F.col("_n").alias("rows"),
                        (F.col("_n") - F.col(f"_nn{i}")).alias("nulls"), F.col(f"_s{i}").alias("sketch"))
               for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*entries)).alias("e"), F.col("_day").alias("day")).select("e.*", "day")


def quantiles_by_day(df: DataFrame, day: Column, values: list[str], group: Column | None = None, k: int = KLL_K
                     ) -> DataFrame:
    """Rows with a value and a quantile sketch, by day, group and value column."""
    own = group if group is not None else F.lit("all")
    aggs = []
    for i, v in enumerate(values):
        x = F.col(v).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"_s{i}")]
    wide = df.withColumns({"_day": day, "_group": own.cast("string")}).groupBy("_day", "_group").agg(*aggs)
    entries = [F.struct(F.lit(v).alias("value_name"), F.col(f"_n{i}").alias("rows"), F.col(f"_s{i}").alias("sketch"))
               for i, v in enumerate(values)]
    return (wide.select(F.col("_group").alias("group"), F.explode(F.array(*entries)).alias("e"), F.col("_day").alias("day"))
            .select("group", "e.*", "day").where("rows > 0"))


def store(sketches: DataFrame, path: str) -> None:
    """Write sketches by day; days that were written before are replaced, others stay."""
    (sketches.withColumn("day", F.coalesce("day", F.lit("1970-01-01").cast("date"))).repartition("day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def _days(spark: SparkSession, path: str, schema: str, first=None, last=None) -> DataFrame:
    df = spark.read.schema(schema).parquet(path)
    for bound, keep in ((first, F.col("day") >= F.lit(first)), (last, F.col("day") <= F.lit(last))):
        df = df if bound is None else df.where(keep)  # prunes the day folders
    return df


def merged_profile(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """column_name, dtype, rows, nulls, null_pct and distinct estimate over the days from ``first`` to ``last``."""
    g = _days(spark, path, _PROFILE, first, last).groupBy("column_name", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
    return g.withColumn("null_pct", F.try_divide(F.col("nulls") * 100.0, F.col("rows")))


def merged_quantiles(spark: SparkSession, path: str, quantiles: list[float], first=None, last=None) -> DataFrame:
    """group, value_name, rows, q and the value at q over the days from ``first`` to ``last``."""
    g = _days(spark, path, _QUANTILES, first, last).groupBy("group", "value_name").agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("s"))
    at = F.array(*[F.struct(F.lit(q).alias("q"), F.kll_sketch_get_quantile_double("s", F.lit(q)).alias("value"))
                   for q in quantiles])
    return g.select("group", "value_name", "rows", F.explode(at).alias("e")).select("group", "value_name", "rows", "e.*")


def ranks_of(df: DataFrame, values: DataFrame, column: str, group: Column) -> DataFrame:
    """``values(group, q, value)`` with the exact shares of rows below and up to each value.

    ``values`` has one row per group and quantile; each scan task counts all of a group's values at once.
    """
    asked = values.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("asked"))
    x = df.select(group.cast("string").alias("group"), F.col(column).cast("double").alias("x")).where("x is not null")
    met = x.join(asked, "group").select("group", "x", F.posexplode("asked").alias("i", "a"))
    return met.groupBy("group", "i").agg(
        F.first("a.q").alias("q"), F.first("a.value").alias("value"), F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col("x") < F.col("a.value")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("x") <= F.col("a.value")) / F.count(F.lit(1))).alias("up_to")).drop("i")
