"""Stored sketches: merged days agree with the whole table within the sketches' errors."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripsight.operators import sketches as S
from tripsight.session import scratch_path


@pytest.fixture(scope="module")
def trips(spark):
    rng = np.random.default_rng(4)
    n = 20_000
    rows = [(int(i), int(rng.integers(0, 3000)), None if i % 7 == 0 else f"c{rng.integers(0, 40)}",
             float(rng.exponential()), dt.date(2024, 1, 1 + int(rng.integers(0, 9))), "a" if i % 3 else None)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, zone int, code string, fare double, d date, kind string").cache()


def test_profile_of_any_range(spark, trips):
    path = scratch_path(spark, "sketch")
    S.store(S.profile_by_day(trips, F.col("d"), ["id", "zone", "code", "fare"]), path)
    for first, last in ((None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None), ("2025-01-01", None)):
        part = trips
        if first:
            part = part.where(F.col("d") >= first)
        if last:
            part = part.where(F.col("d") <= last)
        got = {r.column_name: r for r in S.merged_profile(spark, path, first, last).collect()}
        n = part.count()
        assert (not got) if not n else len(got) == 4
        for c, r in got.items():
            exact = part.agg(F.count_distinct(c), F.count_if(F.col(c).isNull())).first()
            assert (r.rows, r.nulls) == (n, exact[1])
            assert abs(r.distinct_estimate - exact[0]) <= 4 * S.distinct_error() * exact[0] + 1


def test_a_day_written_again_replaces_itself(spark, trips):
    path = scratch_path(spark, "sketch")
    S.store(S.profile_by_day(trips, F.col("d"), ["id"]), path)
    day = trips.where("d = date'2024-01-02'")
    S.store(S.profile_by_day(day, F.col("d"), ["id"]), path)
    assert S.merged_profile(spark, path).first().rows == trips.count()
    S.store(S.profile_by_day(day.limit(5), F.col("d"), ["id"]), path)
    assert S.merged_profile(spark, path, "2024-01-02", "2024-01-02").first().rows == 5


def test_quantiles_within_rank_error(spark, trips):
    path = scratch_path(spark, "sketch")
    S.store(S.quantiles_by_day(trips, F.col("d"), ["fare", "zone"], F.col("kind")), path)
    qs = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = S.merged_quantiles(spark, path, qs)
    assert got.count() == 2 * 2 * len(qs)
    group = F.coalesce(F.col("kind"), F.lit("none"))
    for v in ("fare", "zone"):
        asked = got.where(F.col("value_name") == v).withColumn("group", F.coalesce("group", F.lit("none")))
        for r in S.ranks_of(trips, asked, v, group).collect():
            assert r.below - S.rank_error() <= r.q <= r.up_to + S.rank_error()
    # sketches of single days merge to that day's own quantiles
    one = S.merged_quantiles(spark, path, [0.5], "2024-01-04", "2024-01-04").where("value_name = 'fare'").collect()
    for r in one:
        day = trips.where("d = date'2024-01-04'").where(F.col("kind").eqNullSafe(F.lit(r.group)))
        assert r.rows == day.count()
        rank = day.where(F.col("fare") <= r.value).count() / r.rows
        assert abs(rank - 0.5) <= S.rank_error() + 1 / r.rows


def test_empty(spark, trips):
    path = scratch_path(spark, "sketch")
    S.store(S.quantiles_by_day(trips.limit(0), F.col("d"), ["fare"]), path)
    S.store(S.quantiles_by_day(trips, F.col("d"), ["fare"]), path)
    assert S.merged_quantiles(spark, path, [0.5], "2030-01-01").count() == 0
