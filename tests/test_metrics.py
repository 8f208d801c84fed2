"""Metric known answers (FIXTURES F7), skewness, quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripsight.functions.stats import sample_skewness
from tripsight.operators import evaluation as EV
from tripsight.operators.quantiles import quantiles


def frame(spark, y, p):
    rows = [(float(a), float(b), float(a), float(b)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "fare_amount double, pred_fare double, duration_minutes double, "
                                       "pred_duration double")


def test_metrics_known_answer_1(spark):
    m = EV.regression_metrics(frame(spark, [10, 20, 30, 40], [12, 18, 33, 37]), "t").where("target='fare'").first()
    assert m.mae == pytest.approx(2.5) and m.r2 > 0.9


def test_metrics_known_answer_2(spark):
    m = EV.regression_metrics(frame(spark, [10, 20], [12, 18]), "t").where("target='fare'").first()
    assert (m.mae, m.rmse, m.mape_pct, m.r2) == pytest.approx((2.0, 2.0, 15.0, 0.84))


def test_mape_skips_zero_targets(spark):
    m = EV.regression_metrics(frame(spark, [0, 10], [1, 12]), "t").where("target='fare'").first()
    assert m.mape_pct == pytest.approx(20.0)
    e = EV.regression_metrics(frame(spark, [0, 10], [1, 12]), "t", eps_mape=True).where("target='fare'").first()
    assert e.mape_pct > 1e10  # the epsilon form explodes on a zero target


def test_mean_baseline(spark):
    train = spark.createDataFrame([(10.0, 1.0), (20.0, 2.0), (30.0, 3.0)], "fare_amount double, duration_minutes double")
    test = spark.createDataFrame([(5.0, 1.0), (7.0, 2.0)], "fare_amount double, duration_minutes double")
    p = EV.MeanPredictor.fit(train).predict(test).collect()
    assert [r.pred_fare for r in p] == [20.0, 20.0]


def test_mean_predictor_r2_not_positive_elsewhere(spark):
    from tripsight.plans.catalog import REGISTRY
    rows = REGISTRY["mean_baseline_eval"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.r2 <= 0.0 for r in rows)


def test_bias_adjusted_skewness(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 4, 9, 30]], "x double")
    assert df.select(sample_skewness(F.col("x"))).first()[0] == pytest.approx(1.89916, abs=1e-5)


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = [("hot" if rng.random() < 0.5 else str(rng.integers(0, 4)), float(rng.normal())) for _ in range(3000)]
    df = spark.createDataFrame(rows + [("hot", None)], "g string, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in quantiles(df, "v", probs, ["g"], partitions=6).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-12)


def test_approx_quantiles_close(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    q = quantiles(df, "v", [0.5], approx=True).first().q
    assert abs(q - 500.0) <= 2.0


def test_residual_slices_cover_every_bucket(spark):
    from tripsight.plans.catalog import REGISTRY
    out = REGISTRY["residuals_by_distance"](spark, "/root/testdata/sf0.001").collect()
    assert [r.distance_bucket for r in sorted(out, key=lambda r: r.bucket_order)] == [
        "Short (<2 mi)", "Medium (2-10 mi)", "Long (>10 mi)"]


def test_quantiles_agree_with_numpy(spark):
    rng = np.random.default_rng(11)
    rows = [("hot" if rng.random() < 0.4 else str(rng.integers(0, 3)), float(rng.integers(0, 200)) / 2.0)
            for _ in range(2500)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in quantiles(df, "v", probs, ["g"]).collect()}
    glob = {r.p: r.q for r in quantiles(df, "v", probs).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-12)
    allv = np.array([v for _, v in rows])
    for p in probs:
        assert glob[p] == pytest.approx(float(np.percentile(allv, p * 100)), abs=1e-12)


def test_hot_group_is_ranked_by_many_tasks(spark):
    """A group holding half the rows is spread over several range partitions."""
    from tripsight.operators.quantiles import _ranked_counts
    rows = [("hot" if i % 2 == 0 else f"g{i % 7}", float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    v = df.withColumnRenamed("v", "_v")
    from pyspark.sql import functions as F
    ranked = _ranked_counts(v, ["g"], 8)
    hot = ranked.where("g = 'hot'").collect()
    assert sorted((r._start, r._end) for r in hot) == [(i, i + 1) for i in range(2000)]
    assert {r._n for r in hot} == {2000}


def test_one_value_holding_half_the_rows(spark):
    import numpy as np
    from tripsight.operators.quantiles import quantiles
    x = [52.0] * 2000 + [i / 7.0 for i in range(2000)]
    df = spark.createDataFrame([(None if i % 3 else "a", v) for i, v in enumerate(x)], "g string, v double")
    got = {(r.g, r.p): r.q for r in quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in (None, "a"):
        own = [v for i, v in enumerate(x) if (None if i % 3 else "a") == g]
        for p in (0.25, 0.5, 0.9):
            assert got[(g, p)] == float(np.quantile(own, p))


def test_sums_beyond_a_long(spark):
    from tripsight.functions.stats import MINUTE_UNIT, decimal_mean, grid_sum
    from pyspark.sql import functions as F
    big = spark.createDataFrame([(1.2e11,), (1.3e11,), (1.4e11,)], "m double")
    assert big.agg(grid_sum(F.col("m"), MINUTE_UNIT)).first()[0] == 3.9e11
    tiny = spark.createDataFrame([(0.00041,), (0.00042,)], "ms double")
    assert abs(tiny.agg(decimal_mean(F.col("ms"))).first()[0] - 0.000415) < 1e-12


def test_folds_with_extra_columns_and_any_partitioning(spark):
    from pyspark.sql import functions as F
    from tripsight.operators.evaluation import before_fold, fold_assignment
    n = 20_011
    df = spark.range(n).select(
        F.col("id").alias("trip_id"),
        F.timestamp_add("SECOND", (F.xxhash64("id") % 4000).cast("int"), F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"))
        .alias("tpep_pickup_datetime"), F.rand(1).alias("x"), F.lit("text").alias("y"))
    for parts in ("3", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        a = fold_assignment(df.repartition(int(parts)), 3)
        rows = sorted((r.tpep_pickup_datetime, r.trip_id, r.test_fold) for r in a.collect())
        spark.conf.set("spark.sql.shuffle.partitions", before)
        size = n // 4
        want = [None] * (n - 3 * size) + [f for f in range(3) for _ in range(size)]
        assert [f for _, _, f in rows] == want
    assert before_fold(a, 1).count() == n - 2 * size


def test_tiny_and_degenerate_inputs_do_not_fail(spark):
    from datetime import datetime
    from tripsight.operators.evaluation import fold_assignment
    from tripsight.operators.zones import polygon_centroids
    from tripsight.operators import features as FE
    from tripsight.sources.adapters import zones
    two = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))],
                                "trip_id long, tpep_pickup_datetime timestamp_ntz")
    assert [r.test_fold for r in fold_assignment(two, 3).collect()] == [None, None]
    flat = spark.createDataFrame([(1, 0, i, 0.0, 0.0) for i in range(4)], "LocationID long, ring long, seq long, "
                                                                         "x double, y double")
    assert polygon_centroids(flat).first().longitude is None
    odd = spark.createDataFrame([(132, 236, -0.001, 1.0)], "PULocationID long, DOLocationID long, "
                                                          "trip_distance double, RatecodeID double")
    assert FE.with_spatial(odd, zones(spark)).first().haversine_ratio == 10.0


def test_nth_id_by_counts(spark, monkeypatch):
    """Rows that share a time are ranked by counts of id ranges, with repeats."""
    from tripsight.operators import evaluation as EV
    monkeypatch.setattr(EV, "IDS_SORTED", 20)
    monkeypatch.setattr(EV, "ID_PARTS", 8)
    ids = sorted([(i * 7919) % 100_003 - 500 for i in range(700)] + [42] * 60)
    df = spark.createDataFrame([(i,) for i in ids], "trip_id long")
    for rank in (0, 1, 77, 400, 758, 759):
        assert EV.nth_id(df, "trip_id", rank) == ids[rank]


def test_folds_of_rows_that_share_one_time(spark):
    from pyspark.sql import functions as F
    from tripsight.operators.evaluation import PU, fold_assignment
    df = spark.range(103).select(F.col("id").alias("trip_id"), F.lit("2024-01-03 10:00:00").cast("timestamp_ntz").alias(PU))
    got = {r.trip_id: r.test_fold for r in fold_assignment(df, 3).collect()}
    assert [sum(f == k for f in got.values()) for k in (None, 0, 1, 2)] == [28, 25, 25, 25]
    assert [got[i] for i in (27, 28, 52, 53, 102)] == [None, 0, 0, 1, 2]


def test_cold_start_is_the_smallest_request_of_the_first_time(spark):
    from tripsight.operators.latency import latency_report
    rows = [("a", 5, "2024-01-01 00:00:00", True, 9.0), ("a", 3, "2024-01-01 00:00:00", True, 7.0),
            ("a", 1, "2024-01-01 00:00:01", True, 1.0)]
    log = spark.createDataFrame(rows, "scenario string, request_id long, ts string, ok boolean, latency_ms double")
    assert latency_report(log.withColumn("ts", log.ts.cast("timestamp_ntz"))).first().cold_start_ms == 7.0
