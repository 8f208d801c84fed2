"""Streaming queries, guards, sinks."""

import pytest

from tripsight.sources import guards as G
from tripsight.sources import adapters as A
from tripsight.sources.sinks import write_ingest
from tripsight.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_stream_dedup_keeps_one_copy(spark):
    from tripsight.streaming.jobs import stream_dedup
    got = stream_dedup(spark, SF)
    assert got.rows.count() == 1000 and got.rows.select("request_id").distinct().count() == 1000
    assert got.late == 0


def test_stream_dedup_over_unordered_files(spark, tmp_path):
    """One file per trigger, in any order: what comes behind the watermark is settled, nothing comes twice."""
    from pyspark.sql import functions as F
    from tripsight.streaming.jobs import stream_dedup
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.withColumn("k", F.xxhash64("event_id")).repartition(4, "k").drop("k").write.parquet(str(tmp_path / "events.parquet"))
    got = stream_dedup(spark, str(tmp_path), max_files_per_trigger=1)
    out = got.rows
    assert got.late > 0
    assert out.count() == 1000 and out.select("request_id").distinct().count() == 1000
    assert out.join(ev.select(F.col("event_id").alias("request_id"), "ts"), ["request_id", "ts"]).count() == 1000


def day_files(spark, folder, late=0):
    """Events dealt to one file per three days, in order; ``late`` rows of the first days come last."""
    import os
    import time
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF}/events.parquet")
    day = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01")) / 3)
    behind = F.col("event_id").isin([r[0] for r in ev.orderBy("ts").select("event_id").limit(late).collect()])
    parts = ev.withColumn("part", F.when(behind, 99).otherwise(day))
    now = time.time()
    target = folder / "events.parquet"
    target.mkdir(parents=True)
    for i, (p,) in enumerate(sorted(parts.select("part").distinct().collect())):
        one = str(folder / f"part{i}")
        parts.where(F.col("part") == p).drop("part").coalesce(1).write.parquet(one)
        name = next(n for n in os.listdir(one) if n.endswith(".parquet"))
        os.rename(f"{one}/{name}", target / f"{i:03}.parquet")
        os.utime(target / f"{i:03}.parquet", (now - 1000 + i, now - 1000 + i))  # the source reads by file time
    return ev


def test_stream_dedup_state_is_bounded_by_the_watermark(spark, tmp_path):
    from pyspark.sql import functions as F
    from tripsight.streaming.jobs import stream_dedup
    ev = day_files(spark, tmp_path)
    got = stream_dedup(spark, str(tmp_path), max_files_per_trigger=1, watermark="1 day")
    assert got.rows.count() == 1000
    # keys are forgotten: what is left lies within the delay (two days here: a key expires a delay after its own time)
    last = ev.agg(F.max("ts")).first()[0]
    recent = ev.where(F.col("ts") >= F.lit(last) - F.expr("interval 2 days")).count()
    assert 0 < got.state_rows <= recent < 1000


def test_telemetry_counts_late_rows(spark, tmp_path):
    """Closed windows come once, and every row is in a closed window, in an open one, or counted as late."""
    from pyspark.sql import functions as F
    from tripsight.streaming.jobs import stream_telemetry
    ev = day_files(spark, tmp_path, late=37)
    got = stream_telemetry(spark, str(tmp_path), max_files_per_trigger=1)
    assert (got.seen, got.late) == (1000, 37)
    closed = got.closed.groupBy("window_start", "scenario").count()
    assert closed.where("count > 1").count() == 0 and got.open.count() > 0
    late = [r[0] for r in ev.orderBy("ts").select("event_id").limit(37).collect()]
    want = (ev.where(~F.col("event_id").isin(late)).groupBy(F.date_trunc("day", F.col("ts")).alias("day")).count())
    days = got.closed.unionByName(got.open, allowMissingColumns=True).groupBy("window_start").agg(
        F.sum("requests").alias("n"))
    assert sorted((str(r[0]), r[1]) for r in days.collect()) == sorted((str(r[0]), r[1]) for r in want.collect())


def test_stream_and_batch_scores_agree(spark):
    from tripsight.plans.catalog import REGISTRY
    r = REGISTRY["scoring_parity"](spark, SF).first()
    assert r.compared > 0 and r.mismatches == 0


def test_file_size_guard(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        G.assert_file_size(spark, str(tmp_path / "missing.parquet"), 1)
    with pytest.raises(ValueError):
        G.assert_file_size(spark, f"{SF}/region.parquet", 10 ** 9)
    assert G.assert_file_size(spark, f"{SF}/events.parquet", 1) > 0


def test_lookup_contract(spark):
    assert G.assert_lookup_contract(A.zone_lookup(spark)) == 265
    with pytest.raises(ValueError, match="service_zone"):
        G.assert_lookup_contract(A.zone_lookup(spark).drop("service_zone"))


def test_ingest_is_idempotent(spark):
    path = scratch_path(spark, "landing")
    df = spark.read.parquet(f"{SF}/region.parquet")
    assert write_ingest(df, path)["status"] == "written"
    assert write_ingest(df, path)["status"] == "skipped"
    assert write_ingest(df, path, force=True)["status"] == "written"


def test_polygon_centroid_of_unit_square_and_l_shape(spark):
    from tripsight.operators.zones import polygon_centroids
    sq = [(1, 0, i, x, y) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)])]
    ell = [(2, 0, i, float(x), float(y)) for i, (x, y) in
           enumerate([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)])]
    v = spark.createDataFrame([(a, b, c, float(x), float(y)) for a, b, c, x, y in sq] + ell,
                              "LocationID long, ring long, seq long, x double, y double")
    got = {r.LocationID: r for r in polygon_centroids(v).collect()}
    assert (got[1].longitude, got[1].latitude, got[1].area) == pytest.approx((1.0, 1.0, 4.0))
    assert (got[2].longitude, got[2].latitude) == pytest.approx((5 / 6, 5 / 6))


def test_json_report_and_csv_cache_round_trip(spark):
    from tripsight.sources.sinks import read_csv_dimension, write_csv_cache, write_json_report
    path = scratch_path(spark, "report")
    df = spark.createDataFrame([("fare", 1.5), ("duration", None)], "target string, mae double")
    write_json_report(df, path)
    assert sorted(r.target for r in spark.read.json(path).collect()) == ["duration", "fare"]
    csv = scratch_path(spark, "csv")
    write_csv_cache(A.zone_lookup(spark), csv)
    z = read_csv_dimension(spark, csv, "LocationID bigint, Borough string, Zone string, service_zone string")
    assert z.count() == 265 and z.where("Borough is null").count() == 2


def test_require_columns_raises(spark):
    from tripsight.operators.cleaning import require_columns
    df = spark.createDataFrame([(1.0,)], "trip_distance double")
    with pytest.raises(ValueError, match="fare_amount"):
        require_columns(df, ["fare_amount"])


def test_fit_or_load_reuses(spark):
    from tripsight.operators import ml as ML
    from tripsight.operators.bundle import fit_or_load
    from tripsight.plans.catalog import train_test
    train, _ = train_test(spark, SF)
    path = scratch_path(spark, "bundle")
    _, how1 = fit_or_load(path, lambda: ML.fit_run(train, A.zones(spark), "linear"))
    _, how2 = fit_or_load(path, lambda: ML.fit_run(train, A.zones(spark), "linear"))
    assert (how1, how2) == ("fitted", "loaded")


def test_append_mode_withholds_open_window(spark):
    from tripsight.streaming.jobs import stream_latency_window
    complete = stream_latency_window(spark, SF, mode="complete")
    append = stream_latency_window(spark, SF, mode="append")
    # append emits a window only after the watermark passes its end: the last day stays open
    last = complete.agg({"window_start": "max"}).first()[0]
    assert append.where(append.window_start == last).count() == 0
    assert append.count() == complete.where(complete.window_start < last).count()
    assert complete.agg({"requests": "sum"}).first()[0] == 1000


def test_ingest_keeps_a_valid_target_and_rewrites_a_truncated_one(spark):
    from tripsight.sources.sinks import write_ingest
    path = scratch_path(spark, "landing")
    df = spark.range(100).toDF("id")
    assert write_ingest(df, path, min_rows=100) == {"path": path, "status": "written", "rows": 100}
    assert write_ingest(df, path, min_rows=100)["status"] == "skipped"
    df.limit(3).write.mode("overwrite").parquet(path)
    assert write_ingest(df, path, min_rows=100) == {"path": path, "status": "written", "rows": 100}


def test_table_version_changes_with_the_files(spark):
    from tripsight.sources.tables import table_version
    folder = scratch_path(spark, "versioned")
    spark.range(10).write.parquet(f"{folder}/t.parquet")
    a = table_version(spark, folder, "t")
    spark.range(20).write.mode("append").parquet(f"{folder}/t.parquet")
    b = table_version(spark, folder, "t")
    assert a != b and b[0] > a[0]
