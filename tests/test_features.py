"""Feature known answers (FIXTURES F2) and invariants."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripsight import config as C
from tripsight.functions.geo import haversine_miles, manhattan_miles
from tripsight.operators import features as FE

MAY = C.RunConfig(month_start="2022-05-01 00:00:00", month_end="2022-06-01 00:00:00",
                  split_at="2022-05-23 00:00:00", holidays=((5, 30),))
SCHEMA = ("tpep_pickup_datetime timestamp_ntz, PULocationID long, DOLocationID long, passenger_count long, "
          "RatecodeID long, trip_distance double, VendorID long, fare_amount double, trip_id long")


@pytest.fixture
def rows(spark):
    d = datetime
    data = [(d(2022, 5, 16, 8, 30), 132, 236, 1, 2, 15.5, 1, 52.0, 1),
            (d(2022, 5, 21, 22, 15), 236, 236, 2, 1, 0.8, 2, 8.5, 2),
            (d(2022, 5, 30, 12, 0), 1, 132, 3, 3, 22.0, 1, 65.0, 3)]
    return spark.createDataFrame(data, SCHEMA)


def test_calendar_flags(rows):
    out = FE.with_temporal(rows, MAY).orderBy("trip_id").collect()
    assert (out[0].pickup_hour, out[0].is_weekend, out[0].is_rush_hour, out[0].is_holiday) == (8, 0, 1, 0)
    assert (out[1].is_weekend, out[1].is_rush_hour) == (1, 0)
    assert out[2].is_holiday == 1
    assert out[0].pickup_dayofweek == 0  # Monday = 0


def test_spatial_flags(spark, rows):
    from tripsight.sources.adapters import zones
    out = FE.with_spatial(rows, zones(spark)).orderBy("trip_id").collect()
    assert out[0].is_jfk == 1 and out[1].is_same_zone == 1 and out[2].is_newark == 1
    for r in out:
        assert r.is_jfk in (0, 1) and r.is_newark in (0, 1) and r.is_same_zone in (0, 1)


def test_target_encoding_worked_value(spark, rows):
    enc = FE.fit_target_encoding(rows)
    assert enc.global_mean == pytest.approx(41.8333, abs=1e-4)
    unseen = spark.createDataFrame([(999, 999, 9.0)], "PULocationID long, DOLocationID long, RatecodeID double")
    got = enc.apply(rows).where("trip_id = 1").first()
    assert got.PULocationID_target_enc == pytest.approx(42.7576, abs=1e-4)
    u = enc.apply(unseen).first()
    assert u.PULocationID_target_enc == pytest.approx(enc.global_mean)


def test_spark_target_encoder_agrees(spark, rows):
    from pyspark.ml.feature import TargetEncoder
    enc = FE.fit_target_encoding(rows)
    te = TargetEncoder(inputCols=["PULocationID"], outputCols=["e"], labelCol="fare_amount",
                       targetType="continuous", smoothing=10.0, handleInvalid="keep").fit(rows)
    a = {r.trip_id: r.e for r in te.transform(rows).collect()}
    b = {r.trip_id: r.PULocationID_target_enc for r in enc.apply(rows).collect()}
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12)


def test_feature_frame_has_29_columns_in_order(spark, rows):
    from tripsight.sources.adapters import zones
    enc = FE.fit_target_encoding(rows)
    out = FE.build_features(rows, zones(spark), enc, MAY)
    assert out.columns == list(C.FEATURE_ORDER) and len(out.columns) == 29


def test_haversine_jfk_times_square(spark):
    df = spark.createDataFrame([(40.6413, -73.7781, 40.7580, -73.9855)], "a double, b double, c double, d double")
    h, m, h2 = df.select(haversine_miles(F.col("a"), F.col("b"), F.col("c"), F.col("d")),
                         manhattan_miles(F.col("a"), F.col("b"), F.col("c"), F.col("d")),
                         haversine_miles(F.col("c"), F.col("d"), F.col("a"), F.col("b"))).first()
    assert 13.0 <= h <= 14.0
    assert h == pytest.approx(h2)  # symmetric
    assert m > 0


def test_unknown_zone_gives_zero_distance(spark):
    from tripsight.sources.adapters import zones
    df = spark.createDataFrame([(264, 1, 2.0, 1.0)], "PULocationID long, DOLocationID long, trip_distance double, "
                                                   "RatecodeID double")
    r = FE.with_spatial(df, zones(spark)).first()
    assert r.haversine_distance == 0.0 and r.manhattan_distance == 0.0 and r.pu_lat is None


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_fitted_maps_join_alike_with_and_without_broadcast(spark, threshold):
    from tripsight.operators import evaluation as EV
    from tripsight.plans.catalog import train_test
    train, test = train_test(spark, "/root/testdata/sf0.001")
    rows = train.collect()
    mean = sum(r.fare_amount for r in rows) / len(rows)
    zones = {}
    for r in rows:
        zones.setdefault(r.PULocationID, []).append(r.fare_amount)
    want = {z: (sum(v) + 10 * mean) / (len(v) + 10) for z, v in zones.items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        enc = FE.fit_target_encoding(train).apply(test).collect()
        zm = EV.ZoneMeanPredictor.fit(train).predict(test).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(enc) == len(zm) == test.count()
    for r in enc:
        assert r.PULocationID_target_enc == pytest.approx(want.get(r.PULocationID, mean))
    for r in zm:
        assert r.pred_fare == pytest.approx(want.get(r.PULocationID, mean))
