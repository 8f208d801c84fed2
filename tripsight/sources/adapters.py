"""Trip-shaped views over the given tables.

There is no trip table in the test data; ``events`` (unique id, one month of
timestamps) stands in for the raw trip file. Every column is a deterministic
function of an event row, written with integer arithmetic and double literals so
that an independent SQL engine derives exactly the same values. The derivation
is a narrow projection: it keeps the scan's partitioning and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.literals import ts_ntz
from .tables import read_table

# Five borough names of the zone adapter, picked by id % 5.
BOROUGHS = ("Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island")
NO_COORD_ZONES = (264, 265)
AIRPORT_ZONES = (1, 132, 138)


def _d(x: float) -> Column:
    return F.lit(float(x))


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw 13-column trip table with a unique ``trip_id``.

    Planted faults: a shared null block with payment code 0, zero and negative
    fares, zero distances, negative and multi-day durations, zone id 266 and
    rate code 99.
    """
    # json_tuple is a generator: the document is parsed once per row, instead of
    # once per reference after the optimizer inlines the projections
    parsed = events.select("event_id", "ts", "user_id", "event_type", "value",
                           F.json_tuple("props", "k").alias("k_txt"))
    b = parsed.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.col("k_txt").cast("bigint").alias("k"),
        ((F.col("event_id") * 7919 + F.col("user_id") * 104729) % 1000003).alias("h"),
    )
    c = b.select(
        "*",
        ((F.col("event_type") == "error") & (F.col("k") < 18)).alias("gap"),
        F.when(F.col("h") % 71 == 0, _d(0.0))
        .otherwise((F.col("h") % 2000).cast("double") / _d(100.0)).alias("dist"),
    )
    rc = (F.when(F.col("gap"), F.lit(None).cast("double"))
          .when(F.col("k") < 80, _d(1.0)).when(F.col("k") < 88, _d(2.0))
          .when(F.col("k") < 92, _d(3.0)).when(F.col("k") < 95, _d(4.0))
          .when(F.col("k") < 98, _d(5.0)).otherwise(_d(99.0)))
    dur_s = (F.when(F.col("h") % 97 == 0, F.lit(-60).cast("bigint"))
             .when(F.col("h") % 89 == 0, F.lit(30000).cast("bigint"))
             .otherwise(F.floor(F.col("dist") * _d(170.0)).cast("bigint") + F.col("h") % 601))
    d = c.select("*", dur_s.alias("dur_s"), rc.alias("rc"))
    return d.select(
        F.col("event_id").alias("trip_id"),
        (F.col("event_id") % 2 + 1).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, dur_s, ts)").alias("tpep_dropoff_datetime"),
        F.when(F.col("gap"), F.lit(None).cast("double"))
        .otherwise((F.col("k") % 8).cast("double")).alias("passenger_count"),
        F.col("dist").alias("trip_distance"),
        F.col("rc").alias("RatecodeID"),
        F.when(F.col("gap"), F.lit(None).cast("string"))
        .when(F.col("k") % 50 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        (F.col("h") % 266 + 1).alias("PULocationID"),
        ((F.col("event_id") * 31 + F.col("user_id") * 17) % 265 + 1).alias("DOLocationID"),
        F.when(F.col("gap"), F.lit(0).cast("bigint"))
        .otherwise(F.col("k") % 2 + 1).alias("payment_type"),
        F.when(F.col("h") % 101 == 0, _d(-10.0))
        .when(F.col("rc") == 2.0, _d(52.0))
        .otherwise(_d(3.0) + _d(2.5) * F.col("dist") + F.col("k").cast("double") / _d(50.0))
        .alias("fare_amount"),
        F.col("value").alias("tip_amount"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events"))


def zones(spark: SparkSession) -> DataFrame:
    """Zone look-up with centroids: 265 rows, the last two without coordinates.

    Columns LocationID, Borough, Zone, service_zone, longitude, latitude.
    Fixed size (265), so it is always safe to broadcast.
    """
    z = F.col("id")
    no_coord = z.isin(*NO_COORD_ZONES)
    borough = (F.when(no_coord, F.lit(None).cast("string"))
               .when(z == 1, F.lit("EWR"))
               .otherwise(F.element_at(F.array(*[F.lit(b) for b in BOROUGHS]), (z % 5 + 1).cast("int"))))
    service = (F.when(no_coord, F.lit(None).cast("string"))
               .when(z.isin(*AIRPORT_ZONES), F.lit("Airports"))
               .when(borough == "Manhattan", F.lit("Yellow Zone"))
               .otherwise(F.lit("Boro Zone")))
    return spark.range(1, 266).select(
        z.alias("LocationID"),
        borough.alias("Borough"),
        F.when(no_coord, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Zone "), z.cast("string"))).alias("Zone"),
        service.alias("service_zone"),
        F.when(no_coord, F.lit(None).cast("double"))
        .otherwise(_d(-74.0) + (z % 15).cast("double") * _d(0.03)).alias("longitude"),
        F.when(no_coord, F.lit(None).cast("double"))
        .otherwise(_d(40.7) + (z % 20).cast("double") * _d(0.02)).alias("latitude"),
    )


def zone_lookup(spark: SparkSession) -> DataFrame:
    """The four-column look-up part of :func:`zones` (no coordinates)."""
    return zones(spark).select("LocationID", "Borough", "Zone", "service_zone")


def zone_vertices(spark: SparkSession) -> DataFrame:
    """One closed five-point trapezoid ring per zone with a polygon (ids 1..263).

    Columns LocationID, ring, seq, x, y. Base half-width ``w`` and top
    half-width ``w/2`` make the area centroid differ from the vertex mean.
    """
    z = F.col("LocationID")
    w = _d(0.004) + (z % 7).cast("double") * _d(0.001)
    hgt = _d(0.003) + (z % 3).cast("double") * _d(0.001)
    x, y = F.col("longitude"), F.col("latitude")
    pts = [(x - w, y - hgt), (x + w, y - hgt), (x + w / _d(2.0), y + hgt), (x - w / _d(2.0), y + hgt), (x - w, y - hgt)]
    ring = F.array(*[F.struct(px.alias("x"), py.alias("y")) for px, py in pts])
    return (zones(spark).where(F.col("longitude").isNotNull())
            .select(z, F.lit(0).cast("bigint").alias("ring"), F.posexplode(ring).alias("seq", "p"))
            .select("LocationID", "ring", F.col("seq").cast("bigint").alias("seq"), "p.x", "p.y"))


def requests_from_trips(t: DataFrame) -> DataFrame:
    """Prediction requests: trip fields, some out of range, dates as strings."""
    tid = F.col("trip_id")
    return t.select(
        tid.alias("request_id"),
        F.col("PULocationID"),
        F.when(tid % 53 == 0, F.lit(0).cast("bigint")).otherwise(F.col("DOLocationID")).alias("DOLocationID"),
        F.when(tid % 97 == 0, F.lit("not-a-date"))
        .otherwise(F.date_format("tpep_pickup_datetime", "yyyy-MM-dd'T'HH:mm:ss")).alias("tpep_pickup_datetime"),
        F.coalesce(F.col("passenger_count"), _d(0.0)).cast("bigint").alias("passenger_count"),
        F.coalesce(F.col("RatecodeID"), _d(99.0)).cast("bigint").alias("RatecodeID"),
        F.col("trip_distance"),
        F.col("VendorID"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_trips(trips(spark, sf_dir))


SCENARIOS = ("unoptimised", "optimised")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-test log: scenario, ts, ok, latency_ms, component."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.element_at(F.array(*[F.lit(s) for s in SCENARIOS]), (F.col("user_id") % 2 + 1).cast("int")).alias("scenario"),
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("latency_ms"),
        F.col("event_type").alias("component"),
    )


def weather(spark: SparkSession, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """One row per hour of the run window: hour_ts, temp_c, precip_mm."""
    hours = F.expr(
        f"sequence(timestamp_ntz'{cfg.month_start}', timestamp_ntz'{cfg.month_end}' - interval 1 hour, interval 1 hour)")
    base = spark.range(1).select(F.explode(hours).alias("hour_ts"))
    n = F.timestamp_diff("HOUR", ts_ntz("1970-01-01 00:00:00"), F.col("hour_ts"))
    return base.select(
        "hour_ts",
        (_d(-5.0) + (n % 24).cast("double") * _d(0.5)).alias("temp_c"),
        F.when(n % 7 == 0, (n % 5).cast("double") * _d(1.5)).otherwise(_d(0.0)).alias("precip_mm"),
    )
