"""Known answers of the reference's cleaning tests (FIXTURES F1, F6) and invariants."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripsight import config as C
from tripsight.operators import cleaning as CL

MAY = C.RunConfig(month_start="2022-05-01 00:00:00", month_end="2022-06-01 00:00:00",
                  split_at="2022-05-23 00:00:00", holidays=((5, 30),))

RAW_SCHEMA = ("VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
              "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
              "PULocationID long, DOLocationID long, payment_type long, fare_amount double, extra double, "
              "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
              "total_amount double, congestion_surcharge double, airport_fee double")


def raw_rows():
    d = datetime
    pick = [d(2022, 5, 10, 10), d(2022, 5, 15, 12), d(2022, 5, 25, 8), d(2022, 4, 30, 23), d(2022, 5, 20, 9)]
    mins = [15, 30, 45, 11, 10]
    from datetime import timedelta
    rows = []
    specs = [(1, 1.0, 2.5, 1.0, 132, 236, 1, 12.5), (2, 2.0, 5.0, 1.0, 230, 161, 2, 25.0),
             (1, 1.0, 8.0, 2.0, 142, 132, 1, 52.0), (2, 1.0, 1.0, 1.0, 100, 100, 2, 10.0),
             (1, 1.0, 3.0, 1.0, 100, 100, 1, -5.0)]
    for (v, pax, dist, rc, pu, do, pay, fare), p, m in zip(specs, pick, mins):
        rows.append((v, p, p + timedelta(minutes=m), pax, dist, rc, "N", pu, do, pay, fare,
                     0.5, 0.5, 1.0, 0.0, 0.3, fare + 2.3, 2.5, 0.0))
    return rows


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(raw_rows(), RAW_SCHEMA)


def test_duration_minutes(raw):
    d = [r[0] for r in CL.with_duration(raw).select("duration_minutes").collect()]
    assert d[:3] == [15.0, 30.0, 45.0]


def test_sequential_cleaning_counts(raw):
    t = CL.with_duration(raw)
    stats = {r["stat"]: r["value"] for r in CL.cleaning_cost(t, MAY).collect()}
    assert stats["out_of_bound_timestamps"] == 1
    assert stats["invalid_fares"] == 1
    assert stats["total_final_rows"] == 3 and stats["total_dropped_rows"] == 2
    assert stats["retention_rate_pct"] == pytest.approx(60.0)
    assert CL.clean(t, MAY).count() == 3


def test_surviving_columns_are_allowed_plus_targets(raw):
    kept = CL.leakage_safe(CL.clean(CL.with_duration(raw), MAY))
    assert kept.columns == list(C.ALLOWED_FEATURES) + list(C.TARGETS)
    assert not set(kept.columns) & set(C.BANNED_COLUMNS)


def test_temporal_split_two_one(raw):
    kept = CL.leakage_safe(CL.clean(CL.with_duration(raw), MAY))
    train, test = CL.split_frames(kept, MAY)
    assert (train.count(), test.count()) == (2, 1)


def test_contract_validator_raises():
    with pytest.raises(ValueError, match="tip_amount"):
        CL.validate_feature_contract(["trip_distance", "tip_amount"])
    with pytest.raises(ValueError, match="fare_amount"):
        CL.validate_feature_contract(["fare_amount"])
    CL.validate_feature_contract(list(C.ALLOWED_FEATURES))


def test_overlapping_periods_raise(spark):
    rows = [(datetime(2022, 5, 20), 1.0), (datetime(2022, 5, 25), 2.0)]
    train = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, trip_distance double")
    test = spark.createDataFrame([(datetime(2022, 5, 23), 3.0)], "tpep_pickup_datetime timestamp_ntz, trip_distance double")
    with pytest.raises(ValueError, match="overlap"):
        CL.assert_no_overlap(train, test)
    CL.assert_no_overlap(train.limit(0), test)  # an empty side skips the check


def test_missing_values_fail_rules(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "passenger_count double, RatecodeID double")
    rules = dict(CL.cleaning_rules(MAY))
    out = df.select(rules["invalid_passenger_counts"].alias("ok")).collect()
    assert [r.ok for r in out] == [False, False]


def test_request_validation_rejects_each_field(spark):
    base = dict(request_id=0, PULocationID=132, DOLocationID=236, tpep_pickup_datetime="2022-05-20T14:30:00",
                passenger_count=2, RatecodeID=1, trip_distance=6.2)
    bad = [("PULocationID", 0), ("DOLocationID", 266), ("passenger_count", 0), ("RatecodeID", 99),
           ("trip_distance", 0.0), ("tpep_pickup_datetime", "not-a-date")]
    rows = [tuple(base.values())]
    for i, (k, v) in enumerate(bad, start=1):
        r = dict(base, request_id=i)
        r[k] = v
        rows.append(tuple(r.values()))
    df = spark.createDataFrame(rows, "request_id long, PULocationID long, DOLocationID long, "
                                     "tpep_pickup_datetime string, passenger_count long, RatecodeID long, "
                                     "trip_distance double")
    got = {r.request_id: list(r.failed_fields) for r in CL.request_failures(df).collect()}
    assert got[0] == []
    for i, (k, _) in enumerate(bad, start=1):
        assert got[i] == [k]


def test_rule_counts_sum_to_input(spark):
    from tripsight.plans.catalog import raw_trips
    t = raw_trips(spark, "/root/testdata/sf0.001")
    stats = {r["stat"]: r["value"] for r in CL.cleaning_cost(t).collect()}
    dropped = sum(stats[k] for k in C.CLEANING_RULES)
    assert dropped + stats["total_final_rows"] == stats["total_initial_rows"] == t.count()
    # documented counts at sf0.001 (blueprint 7.2)
    assert [stats[k] for k in C.CLEANING_RULES] == [40, 15, 10, 13, 128, 14, 1]
    assert stats["total_final_rows"] == 779


def test_train_plus_test_is_clean(spark):
    from tripsight.plans.catalog import kept_trips
    k = kept_trips(spark, "/root/testdata/sf0.01")
    train, test = CL.split_frames(k)
    assert (train.count(), test.count()) == (5444, 2073)
    assert train.agg(F.max("tpep_pickup_datetime")).first()[0] < test.agg(F.min("tpep_pickup_datetime")).first()[0]


def test_results_do_not_depend_on_session_time_zone(spark):
    from tripsight.plans.catalog import REGISTRY
    names = ["request_validation", "weather_hour_join", "stream_latency_window"]
    before = {n: sorted(map(tuple, REGISTRY[n](spark, "/root/testdata/sf0.001").collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = {n: sorted(map(tuple, REGISTRY[n](spark, "/root/testdata/sf0.001").collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after
