"""The corpus pipeline: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept. Stages return the
columns of ``documents``; the last returns packed pieces. ``run`` writes every stage as Parquet in
the shared folder and reads it again, so a lost executor costs one stage's task at most.

Null and empty texts go through like others (the quality score decides on them); an empty table
gives an empty result with the last stage's columns. Stages judge rows, not identifiers: each row has
a key of its own within a stage, so a null ``doc_id`` is no reason to drop or to pass a row, and rows
that share a ``doc_id`` are judged one by one, each on its own text. Of a group of copies or near copies
(rows that repeat a document included) one row stays: the smallest ``doc_id``, null ids last, among equal
ids the row that stands first. Extra columns are ignored.

Disk: a row's key is the place of the row in its file, so rows are not written to be numbered. Operators
give narrow lists of rows to drop, and only rows that a fixed-size filter can't clear of being on the list
are shuffled. A stage that reads its predecessor's written result begins by deleting the tables that the
predecessor handed over to itself; ``run`` also deletes a stage's result once its successor is written.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsight.llm.common import handover, handovers, read_table, release, without_ids
from tripsight.llm.decontamination import contamination
from tripsight.llm.exact_dedup import exact_dedup
from tripsight.llm.minhash import near_dedup
from tripsight.llm.packing import pack, piece_digests
from tripsight.llm.quality import score_quality, train_quality

#: Columns of ``documents``, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents that score below this are rejected.
QUALITY_THRESHOLD = 0.7


#: Bits of a key for the row's place in its file; the file's number stands above.
PLACE_BITS = 36
#: Files (of some 100 bytes a name) whose numbers are broadcast at most.
BROADCAST_FILES = 100_000


#: Bytes of rows that travel to a Python worker at a time (10,000 documents are some 50 MB, held by the JVM, by
#: Arrow and as Python objects at once, for every core and Python step of a task).
BATCH_BYTES = 4 << 20


#: What a stage handed over to itself when it last ran, by application and stage.
_done: dict[tuple[str, str], list[str]] = {}


def _is_scan(docs: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, as they stand there."""
    plan = docs._jdf.queryExecution().analyzed()
    return plan.nodeName() == "LogicalRelation" and "parquet" in plan.toString().lower()


def _stage(f):
    """A stage that deletes the tables of the stage before it, if ``docs`` is its written result.

    Batches for Python are bounded by their bytes; the result is computed later, so the setting stays.
    Stages run one after another (a second chain may follow, not interleave).
    """
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        app = spark.sparkContext.applicationId
        names = [s.__name__ for _, s in STAGES]
        at = names.index(f.__name__)
        if at and _is_scan(docs):
            release(spark, _done.pop((app, names[at - 1]), []))
        before = set(handovers(spark))
        out = f(spark, docs, sf_dir)
        _done[app, f.__name__] = [p for p in handovers(spark) if p not in before]
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, COLUMNS)
    return scored.where(F.col("_quality_score") >= QUALITY_THRESHOLD).select(*COLUMNS)


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a key ``_row`` that every reading of them sees alike."""
    if not _is_scan(docs) or "_metadata" in docs.columns:
        docs = handover(docs.select(*COLUMNS), f"pipeline-{name}-rows")
    placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    # the driver that planned the scan holds the list of its files
    files = sorted(r[0] for r in placed.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "_number long, _file string")
    if len(files) <= BROADCAST_FILES:  # counted; else a join that shuffles
        numbers = F.broadcast(numbers)
    key = F.shiftleft("_number", PLACE_BITS) + F.col("_at")
    return placed.join(numbers, "_file").select(key.alias("_row"), *COLUMNS)


def _others(keyed: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Rows of ``groups(_row, group)`` but the first of each: smallest doc_id, null last, then row key."""
    ids = groups.join(keyed.select("_row", "doc_id"), "_row")
    first = ids.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("m"))
    drop = groups.join(first.select(F.col("m._row").alias("_row")), "_row", "left_anti")
    return handover(drop.select(F.col("_row").alias("id")), f"pipeline-{name}-drop")


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs, "exact")
    found = exact_dedup(keyed.select("_row", "text"), id_col="_row").where(F.col("group_size") > 1)
    drop = _others(keyed, found.select(F.col("doc_id").alias("_row"), F.col("text_sha256").alias("group")), "exact")
    return without_ids(keyed, "_row", drop).select(*COLUMNS)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs, "near")
    found = handover(near_dedup(keyed.select("_row", "text"), id_col="_row")
                     .select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")), "pipeline-near-found")
    # a component has other members than the row that names it, or it is that row alone
    shared = found.where(F.col("group") != F.col("_row")).select("group").distinct()
    drop = _others(keyed, found.join(shared, "group", "left_semi"), "near")
    return without_ids(keyed, "_row", drop).select(*COLUMNS)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs, "decontamination")
    found = contamination(keyed.select(F.col("_row").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    drop = handover(found.select(F.col("doc_id").alias("id")).distinct(), "pipeline-decontamination-drop")
    return without_ids(keyed, "_row", drop).select(*COLUMNS)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near),
          ("decontamination", decontaminate), ("packing", packing)]

#: The learned and near-duplicate stages have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    last: list[str] = []
    for name, stage in STAGES[:-1]:
        docs = handover(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, last)
        last = handovers(spark)[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
