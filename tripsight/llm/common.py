"""Helpers shared by the training-data operators: table access, hand-over tables, word hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsight.session import scratch_path

#: White space of the word contracts: space, tab, LF, VT, FF, CR (what ``bytes.split()`` splits on).
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per context, so that task code imports it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_tripsight_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="tripsight-"), "tripsight_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tripsight")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._tripsight_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def handover(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and the
    several readers of one intermediate see the same committed rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Hand-over tables of this driver that are still there, by application.
_written: dict[str, list[str]] = {}


def handovers(spark: SparkSession) -> list[str]:
    """The hand-over tables that are still there, in the order they were written."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete hand-over tables, for callers that know their results to be committed: a result still to be
    computed needs its tables."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
        _written[spark.sparkContext.applicationId].remove(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out_remainder(col: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (the documented fold of the classifiers)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(mod)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each Arrow batch as Python lists."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)


def free_memory() -> None:
    """Give memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; elsewhere there is nothing to call
    if trim is not None:
        trim(0)


def freeing(step: Callable) -> Callable:
    """A step for ``mapInArrow`` that frees its memory when it ends.

    Python workers outlive their tasks, and an executor keeps several for each core: what the allocators
    hold for the next task would stand beside what the running tasks need.
    """
    @wraps(step)
    def run(batches):
        try:
            yield from step(batches)
        finally:
            free_memory()

    return run


def batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    arrays = [c if isinstance((c := cols[f.name]), pa.Array) else pa.array(c, type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same on every machine."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


_MUL = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * k & 0xFFFFFFFFFFFFFFFF | 1) for k in range(64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (wraps modulo 2**64)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (empty if there are fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out += h[k:k + m] * _MUL[k]
    return mix64(out)


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the signed longs Spark stores."""
    return x.view(np.int64)


#: Bits of an id filter (its size is fixed, whatever the number of ids) and probes per id.
FILTER_BITS, PROBES = 1 << 25, 4
_WORDS = pa.schema([("word", pa.int64()), ("bits", pa.int64())])


def _probe(ids: np.ndarray) -> list[np.ndarray]:
    h = mix64(ids.astype(np.int64).view(np.uint64))
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + b * np.uint64(i)) % np.uint64(FILTER_BITS)).astype(np.int64) for i in range(PROBES)]


@freeing
def _filter_words(batches):
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for (ids,) in rows_of(batches, "id"):
        for at in _probe(np.array(ids, dtype=np.int64)):
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    words = bits.view(np.int64)
    at = np.flatnonzero(words)
    for lo in range(0, len(at), 100_000):
        yield batch(_WORDS, word=at[lo:lo + 100_000], bits=words[at[lo:lo + 100_000]])


def id_filter(ids: DataFrame):
    """A condition that holds for every value among ``ids(id)`` and for few others (null for none).

    A Bloom filter of fixed size (4 MB, built by a distributed OR), whatever the number of ids: with more
    ids than it separates it lets more values through, so an exact join has to follow.
    """
    got = (ids.select("id").mapInArrow(_filter_words, "word long, bits long")
           .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    if got.num_rows:
        words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    packed = words.view(np.uint8)

    @F.pandas_udf("boolean")
    def maybe(x: pd.Series) -> pd.Series:
        known = x.notna().to_numpy()
        out = known.copy()
        for at in _probe(x.fillna(0).to_numpy().astype(np.int64)):
            out &= (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return pd.Series(out)

    return maybe


def only_ids(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``col`` is among ``ids(id)``.

    ``id_filter`` thins the rows before the exact semi-join, so that wide rows that aren't asked for are
    not shuffled.
    """
    maybe = id_filter(ids)
    return df.where(maybe(F.col(col))).join(ids.select(F.col("id").alias(col)).distinct(), col, "left_semi")


def without_ids(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``col`` is not among ``ids(id)``; rows that ``id_filter`` passes over stay where they are."""
    marked = df.withColumn("_maybe", id_filter(ids)(F.col(col)))
    judged = marked.where("_maybe").join(ids.select(F.col("id").alias(col)).distinct(), col, "left_anti")
    return marked.where(~F.col("_maybe")).unionByName(judged).select(*df.columns)
