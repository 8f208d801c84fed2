"""Zone demand panel, seasonal-naive forecast, hour-of-week traffic proxies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.literals import ts_ntz
from .broadcast import bounded_broadcast

PU = "tpep_pickup_datetime"


def zone_demand(trips: DataFrame, zones: DataFrame, start: str, end: str) -> DataFrame:
    """OPT-01: pickups per (zone, hour), zero-filled over zones x hours of the window.

    Counts come from one aggregate over the trips; the (zone, hour) panel is
    generated from the 265-row dimension with ``sequence`` (its size is fixed
    by the window, not by the data), then joined on both keys.
    """
    counts = trips.groupBy(F.col("PULocationID").alias("zone"), F.date_trunc("hour", PU).alias("hour_ts")).agg(
        F.count(F.lit(1)).alias("pickups"))
    hours = F.sequence(ts_ntz(start), ts_ntz(end) - F.expr("interval 1 hour"), F.expr("interval 1 hour"))
    panel = zones.select(F.col("LocationID").alias("zone"), F.explode(hours).alias("hour_ts"))
    return panel.join(counts, ["zone", "hour_ts"], "left").select(
        "zone", "hour_ts", F.coalesce("pickups", F.lit(0)).cast("bigint").alias("pickups"))


def with_lags(panel: DataFrame, lags=(1, 24, 168)) -> DataFrame:
    """Lagged demand per zone (a zone's series is one row per hour of the window)."""
    w = Window.partitionBy("zone").orderBy("hour_ts")
    return panel.select("*", *[F.lag("pickups", k).over(w).alias(f"lag_{k}") for k in lags])


def seasonal_naive_eval(panel: DataFrame, split_at: str, season: int = 24) -> DataFrame:
    """OPT-02 (oracle side): forecast = same hour one season earlier; error on the test hours."""
    lagged = with_lags(panel, (season,))
    test = lagged.where((F.col("hour_ts") >= ts_ntz(split_at)) & F.col(f"lag_{season}").isNotNull())
    e = F.col("pickups") - F.col(f"lag_{season}")
    return test.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.abs(e)).alias("mae"),
                    F.sqrt(F.avg(e * e)).alias("rmse"), F.sum("pickups").alias("actual_pickups"),
                    F.sum(f"lag_{season}").alias("forecast_pickups"))


def hourly_traffic_proxy(train: DataFrame) -> DataFrame:
    """OPT-06: per hour of week, mean pickups per hour and mean implied speed (train only)."""
    speed = F.try_divide(F.col("trip_distance"), F.col("duration_minutes") / 60.0)
    per_hour = train.groupBy(F.to_date(PU).alias("d"), F.weekday(PU).alias("dow"), F.hour(PU).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(speed).alias("s"), F.count(speed).alias("ns"))
    return per_hour.groupBy("dow", "hour").agg(F.avg("n").alias("proxy_pickups_per_hour"),
                                               F.try_divide(F.sum("s"), F.sum("ns")).alias("proxy_mean_speed"))


def attach_traffic_proxy(df: DataFrame, proxy: DataFrame) -> DataFrame:
    """Join the proxy on hour of week (168 rows at most: a broadcast)."""
    p = bounded_broadcast(proxy, 168)
    keyed = df.select("*", F.weekday(PU).alias("dow"), F.hour(PU).alias("hour"))
    return keyed.join(p, ["dow", "hour"], "left")
