"""Sinks: split parquet, CSV cache, JSON reports, ingestion manifest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def write_split(df: DataFrame, spark: SparkSession, path: str | None = None) -> str:
    """SRC-09: one pass writes both splits (``split=train`` / ``split=test`` folders).

    Partitioning by split lets a later ``where split = 'train'`` prune the test
    files; within a split, rows stay in scan order.
    """
    path = path or scratch_path(spark, "clean_split")
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def write_csv_cache(df: DataFrame, path: str, null_value: str = "N/A") -> None:
    """SRC-10: small dimension cache with header (one file: the dimension is bounded)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", null_value).csv(path)


def read_csv_dimension(spark: SparkSession, path: str, schema: str, null_value: str = "N/A") -> DataFrame:
    """SRC-02: CSV look-up with an explicit schema; ``N/A`` reads as missing."""
    return spark.read.option("header", True).option("nullValue", null_value).schema(schema).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """SRC-11: run records as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_ingest(df: DataFrame, path: str, force: bool = False, min_rows: int = 1) -> dict:
    """SRC-06: land a table once; ``force`` rewrites. Returns a manifest row.

    A target is kept when it holds ``min_rows`` rows (the guard of the table); a truncated one is
    written again. Only an absent path or one without Parquet files counts as absent: any other
    failure is raised.
    """
    spark = df.sparkSession
    existing = None
    try:
        existing = spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    if existing is not None and existing >= min_rows and not force:
        return {"path": path, "status": "skipped", "rows": existing}
    df.write.mode("overwrite").parquet(path)
    return {"path": path, "status": "written", "rows": spark.read.parquet(path).count()}

