"""Ingestion guards: file size, row counts, look-up contract (SRC-03..05)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import GIVEN_TABLES, read_table

# minimum rows per table; the trip source (events) must hold a full month
MIN_ROWS = {"events": 1000}
MIN_BYTES = {"events": 10 * 1024}
LOOKUP_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")
MIN_LOOKUP_ROWS = 260


def row_count_audit(spark: SparkSession, sf_dir: str, tables=GIVEN_TABLES) -> DataFrame:
    """Rows per table; ``count()`` over an empty projection reads no column data."""
    parts = [read_table(spark, sf_dir, t).select(F.lit(t).alias("table_name")) for t in tables]
    counts = reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
    mins = F.coalesce(*[F.when(F.col("table_name") == t, F.lit(n)) for t, n in MIN_ROWS.items()], F.lit(1))
    return counts.select("table_name", "rows", mins.cast("bigint").alias("min_rows"),
                         (F.col("rows") >= mins).alias("ok"))


def file_size_audit(spark: SparkSession, sf_dir: str, tables=GIVEN_TABLES) -> DataFrame:
    """Files and bytes per table from the scan's ``_metadata`` column."""
    parts = [read_table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), "_metadata.file_path",
                                                  "_metadata.file_size") for t in tables]
    files = reduce(DataFrame.unionByName, parts).groupBy("table_name", "file_path").agg(
        F.max("file_size").alias("file_size"))
    agg = files.groupBy("table_name").agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
    mins = F.coalesce(*[F.when(F.col("table_name") == t, F.lit(n)) for t, n in MIN_BYTES.items()], F.lit(1))
    return agg.select("table_name", "files", "bytes", mins.cast("bigint").alias("min_bytes"),
                      (F.col("bytes") >= mins).alias("ok"))


def assert_file_size(spark: SparkSession, path: str, min_bytes: int) -> int:
    """Raise when the table is missing or smaller than ``min_bytes``; return its size.

    Sizes come from the scan's file metadata, so any Hadoop filesystem works.
    """
    from pyspark.errors import AnalysisException
    try:
        files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
        size = files.agg(F.sum("file_size")).first()[0] or 0
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    if size < min_bytes:
        raise ValueError(f"{path}: {size} bytes < required {min_bytes}")
    return int(size)


def assert_lookup_contract(lookup: DataFrame, min_rows: int = MIN_LOOKUP_ROWS) -> int:
    """SRC-05: the four required columns and at least ``min_rows`` rows."""
    missing = sorted(set(LOOKUP_COLUMNS) - set(lookup.columns))
    if missing:
        raise ValueError(f"zone look-up lacks columns {missing}")
    n = lookup.count()
    if n < min_rows:
        raise ValueError(f"zone look-up has {n} rows < {min_rows}")
    return n
