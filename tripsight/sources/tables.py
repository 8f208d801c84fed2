"""Scans of the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Files, bytes and last change of a table: one row per file, no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table_path(sf_dir, name))
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime")).first())
