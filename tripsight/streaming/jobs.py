"""Streaming jobs over the event files (file source, checkpointed, replay-safe).

Each job reads ``events`` as a file stream, reuses the batch column
expressions, and writes through ``foreachBatch`` into one folder per batch id
with overwrite: a batch replayed after a failure replaces its own output
instead of duplicating it. Checkpoints and outputs live under the shared
folder of ``spark.checkpoint.dir``. ``trigger(availableNow=True)`` drains what
is there and stops (a scheduled job); a service would use a processing-time
trigger on the same plan.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import config as C
from ..functions.literals import instant_to_ntz, ntz_to_instant
from ..functions.stats import decimal_mean
from ..operators import cleaning as CL
from ..operators.ml import spread_requests
from ..session import scratch_path
from ..sources import adapters as A
from ..sources.tables import table_path


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a file stream (schema from the footer, no inference)."""
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    r = spark.readStream.schema(schema).option("basePath", sf_dir.rstrip("/"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{sf_dir.rstrip('/')}/events*.parquet")


def _run(stream: DataFrame, out: str, mode: str = "append", keyed_batches: bool = True):
    """Drain the stream into ``out`` (one folder per batch, overwrite on replay)."""
    def write(batch: DataFrame, batch_id: int):
        target = f"{out}/batch_id={batch_id}" if keyed_batches else out
        batch.write.mode("overwrite").parquet(target)

    q = (stream.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", f"{out}_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_score(spark: SparkSession, sf_dir: str, run, version: str = C.DEFAULT.model_version) -> tuple[str, str]:
    """STR-01: validate -> score (fitted pipeline, floors, version) -> scored / rejected sinks."""
    events = event_stream(spark, sf_dir)
    req = CL.request_failures(A.requests_from_trips(A.trips_from_events(events)))
    base = scratch_path(spark, "stream_score")
    scored_dir, rejected_dir = f"{base}/scored", f"{base}/rejected"

    def write(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        ok = batch.where("valid")
        pred = run.predict(spread_requests(model_input(ok)))
        (pred.select("request_id",
                     F.greatest("pred_fare", F.lit(C.FARE_FLOOR)).alias("predicted_fare"),
                     F.greatest("pred_duration", F.lit(C.DURATION_FLOOR)).alias("predicted_duration_minutes"),
                     F.lit(version).alias("model_version"))
         .write.mode("overwrite").parquet(f"{scored_dir}/batch_id={batch_id}"))
        (batch.where(~F.col("valid")).select("request_id", F.array_join("failed_fields", ",").alias("failed_fields"))
         .write.mode("overwrite").parquet(f"{rejected_dir}/batch_id={batch_id}"))
        batch.unpersist()

    q = (req.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return scored_dir, rejected_dir


def model_input(valid_requests: DataFrame) -> DataFrame:
    """Request rows in the training shape: parsed pickup, double-typed codes, vendor unset."""
    return valid_requests.select(
        "request_id", F.col("pickup_ts").alias(CL.PU), "PULocationID", "DOLocationID",
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("RatecodeID").cast("double").alias("RatecodeID"), "trip_distance")


class _Progress(StreamingQueryListener):
    """Adds up what a query's batches report: rows observed as ``seen.rows`` and rows dropped as late."""

    def __init__(self):
        self.rows, self.dropped, self.ended, self.id = 0, 0, threading.Event(), None

    def onQueryStarted(self, event):
        self.id = str(event.runId)

    def onQueryProgress(self, event):
        p = event.progress
        if str(p.runId) != self.id:
            return
        seen = p.observedMetrics.get("seen")
        self.rows += seen.rows if seen else 0
        self.dropped += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)

    def onQueryTerminated(self, event):
        if str(event.runId) == self.id:
            self.ended.set()

    def onQueryIdle(self, event):
        pass


def _drained(spark: SparkSession, start) -> _Progress:
    """Run a query to the end of its input and return what its batches reported."""
    said = _Progress()
    spark.streams.addListener(said)
    try:
        q = start()
        said.id = str(q.runId)
        q.awaitTermination()
        said.ended.wait(60)  # progress is reported behind the query
    finally:
        spark.streams.removeListener(said)
    return said


def request_log_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Requests with scenario, outcome and latency. Event time is the NTZ wall clock read as UTC through epoch
    microseconds (watermarks need TIMESTAMP), independent of the session time zone."""
    return event_stream(spark, sf_dir, max_files_per_trigger).select(
        F.element_at(F.array(*[F.lit(s) for s in A.SCENARIOS]), (F.col("user_id") % 2 + 1).cast("int")).alias("scenario"),
        ntz_to_instant(F.col("ts")).alias("ts"), (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("latency_ms"))


def _by_window(log: DataFrame, window: str, watermark: str) -> DataFrame:
    return (log.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), "scenario")
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("ok")).alias("rejects"),
                 decimal_mean(F.col("latency_ms")).alias("mean_latency_ms")))


def _window_rows(df: DataFrame) -> DataFrame:
    return df.select(instant_to_ntz(F.col("w.start")).alias("window_start"),
                     instant_to_ntz(F.col("w.end")).alias("window_end"),
                     "scenario", "requests", "rejects", "mean_latency_ms")


@dataclass
class Telemetry:
    """Windows the watermark has closed (each emitted once), requests of open windows, and rows that came too late."""

    closed: DataFrame
    open: DataFrame
    seen: int
    late: int


def stream_telemetry(spark: SparkSession, sf_dir: str, window: str = "1 day", watermark: str = "1 hour",
                     max_files_per_trigger: int | None = None) -> Telemetry:
    """STR-02 in append mode: a window is written once, when the watermark passes its end, and its state goes.

    State holds open windows only. Rows behind the watermark are not added to a closed window; they are
    counted: rows observed, less those of emitted windows and of the windows still in the state store.
    """
    base = scratch_path(spark, "stream_telemetry")
    log = request_log_stream(spark, sf_dir, max_files_per_trigger).observe("seen", F.count(F.lit(1)).alias("rows"))
    agg = _by_window(log, window, watermark)

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{base}/closed/batch_id={batch_id}")

    said = _drained(spark, lambda: agg.writeStream.outputMode("append").foreachBatch(write).option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    closed = _window_rows(spark.read.schema(agg.schema).option("basePath", f"{base}/closed").parquet(f"{base}/closed"))
    state = spark.read.format("statestore").option("path", f"{base}/checkpoint").load()
    # the first aggregation buffer is the count of requests
    state = state.select("key.window.start", "key.window.end", "key.scenario", "value.*").toDF(
        "start", "end", "scenario", "requests", *[f"buffer_{i}" for i in range(len(state.schema["value"].dataType) - 1)])
    open_ = state.select(instant_to_ntz(F.col("start")).alias("window_start"),
                         instant_to_ntz(F.col("end")).alias("window_end"), "scenario", "requests")
    counted = sum(int(d.agg(F.coalesce(F.sum("requests"), F.lit(0))).first()[0]) for d in (closed, open_))
    return Telemetry(closed, open_, said.rows, said.rows - counted)


def stream_latency_window(spark: SparkSession, sf_dir: str, window: str = "1 day", watermark: str = "1 hour",
                          mode: str = "complete") -> DataFrame:
    """STR-02: requests, rejects and mean latency per scenario and tumbling window.

    ``append`` emits a window once the watermark passes it (production: ``stream_telemetry``, which also counts
    late rows); ``complete`` re-emits all windows, so the last window of a finite input is
    included (what a comparison with a batch engine needs).
    """
    agg = _by_window(request_log_stream(spark, sf_dir), window, watermark)
    out = scratch_path(spark, "stream_latency")
    _run(agg, out, mode=mode, keyed_batches=(mode != "complete"))
    return _window_rows(spark.read.parquet(out))


@dataclass
class Deduplicated:
    """Each request once. ``late`` rows came behind the watermark and were settled against the sink."""

    rows: DataFrame
    late: int
    state_rows: int


def stream_dedup(spark: SparkSession, sf_dir: str, copies: int = 2, max_files_per_trigger: int | None = None,
                 watermark: str = "2 days") -> Deduplicated:
    """STR-03: requests delivered several times are kept once, by keyed state that expires.

    The state store holds a key for ``watermark`` behind the latest event time and then forgets it, so state
    and the cost of a batch follow the delay, not the history. Spark drops rows that come behind the
    watermark; those are not lost: if any were, one pass at the end keeps the source rows whose id the sink
    doesn't hold. A replayed batch replaces its own folder.
    """
    s = None
    for _ in range(copies):
        one = event_stream(spark, sf_dir, max_files_per_trigger).select(
            F.col("event_id").alias("request_id"), "ts", ntz_to_instant(F.col("ts")).alias("at"))
        s = one if s is None else s.unionByName(one)
    kept = s.withWatermark("at", watermark).dropDuplicatesWithinWatermark(["request_id"])
    base = scratch_path(spark, "stream_dedup")

    def write(batch: DataFrame, batch_id: int):
        batch.select("request_id", "ts").write.mode("overwrite").parquet(f"{base}/kept/batch_id={batch_id}")

    said = _drained(spark, lambda: kept.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    state = spark.read.format("statestore").option("path", f"{base}/checkpoint").load().count()
    rows = spark.read.schema("request_id long, ts timestamp_ntz").option("basePath", f"{base}/kept").parquet(f"{base}/kept")
    if said.dropped:
        source = spark.read.parquet(f"{sf_dir.rstrip('/')}/events*.parquet").select(
            F.col("event_id").alias("request_id"), "ts")
        missed = source.join(rows.select("request_id"), "request_id", "left_anti")
        (missed.groupBy("request_id").agg(F.min("ts").alias("ts"))
         .write.mode("overwrite").parquet(f"{base}/late"))
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{base}/late"))
    # a key that came again after its state had expired is in the sink twice
    return Deduplicated(rows.groupBy("request_id").agg(F.min("ts").alias("ts")), said.dropped, state)
