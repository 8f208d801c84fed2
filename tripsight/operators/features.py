"""Calendar, spatial and encoded features; the 29-column feature frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import temporal_columns
from ..functions.geo import haversine_miles, manhattan_miles
from ..functions.stats import MONEY_UNIT, grid_mean
from ..session import scratch_path
from .broadcast import bounded_broadcast

PU = "tpep_pickup_datetime"
ZONE_ROWS = 265  # size of the zone dimension (fixed)


def with_temporal(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """PRJ-04..08: hour, weekday (Mon=0), day, sin/cos, weekend, rush, holiday."""
    return df.select("*", *temporal_columns(F.col(PU), cfg.holidays))


def with_centroids(df: DataFrame, zones: DataFrame) -> DataFrame:
    """JOIN-01: pickup and dropoff centroids by two broadcast LEFT joins (miss -> null)."""
    z = zones.select("LocationID", "latitude", "longitude")
    pu = bounded_broadcast(z.select(F.col("LocationID").alias("_pu_id"), F.col("latitude").alias("pu_lat"),
                                    F.col("longitude").alias("pu_lon")), ZONE_ROWS)
    do = bounded_broadcast(z.select(F.col("LocationID").alias("_do_id"), F.col("latitude").alias("do_lat"),
                                    F.col("longitude").alias("do_lon")), ZONE_ROWS)
    out = (df.join(pu, df["PULocationID"] == pu["_pu_id"], "left")
             .join(do, df["DOLocationID"] == do["_do_id"], "left"))
    return out.drop("_pu_id", "_do_id")


def haversine_col() -> Column:
    return haversine_miles(F.col("pu_lat"), F.col("pu_lon"), F.col("do_lat"), F.col("do_lon"))


def manhattan_col() -> Column:
    return manhattan_miles(F.col("pu_lat"), F.col("pu_lon"), F.col("do_lat"), F.col("do_lon"))


def airport_flag(ratecode: int, zone: int) -> Column:
    c = ((F.col("RatecodeID") == ratecode) | (F.col("PULocationID") == zone) | (F.col("DOLocationID") == zone))
    return F.coalesce(c, F.lit(False)).cast("int")


def with_spatial(df: DataFrame, zones: DataFrame) -> DataFrame:
    """PRJ-09..14 on top of JOIN-01. Unknown coordinates give distance 0 (batch rule)."""
    d = with_centroids(df, zones)
    hav = F.coalesce(haversine_col(), F.lit(0.0))
    return d.select(
        "*",
        hav.alias("haversine_distance"),
        F.coalesce(manhattan_col(), F.lit(0.0)).alias("manhattan_distance"),
        # a zero denominator gives +inf in the reference, clipped to the cap; 0/0 stays missing
        F.when((F.col("trip_distance") + F.lit(C.EPSILON_DISTANCE) == 0) & (hav > 0), F.lit(C.MAX_HAVERSINE_RATIO))
        .otherwise(F.least(F.try_divide(hav, F.col("trip_distance") + F.lit(C.EPSILON_DISTANCE)),
                           F.lit(C.MAX_HAVERSINE_RATIO))).alias("haversine_ratio"),
        F.coalesce(F.col("PULocationID") == F.col("DOLocationID"), F.lit(False)).cast("int").alias("is_same_zone"),
        airport_flag(C.JFK_RATECODE, C.JFK_ZONE).alias("is_jfk"),
        airport_flag(C.NEWARK_RATECODE, C.NEWARK_ZONE).alias("is_newark"),
    )


# --- target encoding (ENC-01/02, JOIN-04) -------------------------------------------

@dataclass
class TargetEncoding:
    """Fitted smoothed-mean encoding of the encoded columns against one target.

    ``maps`` is a written table of one row per (column, category): enc_column, category (double),
    n, cat_mean, encoded. Its joins carry no hint: Spark broadcasts a map whose written size is
    small and shuffles a larger one, so the number of categories needs no bound.
    """

    maps: DataFrame
    global_mean: float | None

    def column_map(self, col: str) -> DataFrame:
        return (self.maps.where(F.col("enc_column") == col)
                .select(F.col("category").alias(f"_{col}_cat"), F.col("encoded").alias(f"{col}_target_enc")))

    def apply(self, df: DataFrame, cols=C.ENCODED_COLUMNS) -> DataFrame:
        fallback = F.lit(self.global_mean).cast("double")
        out = df
        for c in cols:
            m = self.column_map(c)
            out = out.join(m, out[c].cast("double") == m[f"_{c}_cat"], "left").drop(f"_{c}_cat")
            out = out.withColumn(f"{c}_target_enc", F.coalesce(F.col(f"{c}_target_enc"), fallback))
        return out


def fit_target_encoding(train: DataFrame, target: str = "fare_amount", cols=C.ENCODED_COLUMNS,
                        smoothing: float = C.ENCODING_SMOOTHING) -> TargetEncoding:
    """ENC-01: ``(n*mean + m*global)/(n+m)`` fitted on train only (always on fare).

    The global mean is a plain aggregate; the categories of each column are one group-by over a
    pruned scan with map-side combine, so a hot category costs no more than a cold one.
    """
    spark = train.sparkSession
    y = F.col(target)
    gmean = train.agg(grid_mean(y, MONEY_UNIT).alias("g")).first()["g"]
    m, path = F.lit(float(smoothing)), scratch_path(spark, "target-encoding")
    smoothed = (F.col("n") * F.col("cat_mean") + m * F.lit(gmean).cast("double")) / (F.col("n") + m)
    fitted = None
    for c in cols:
        one = (train.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("double").alias("category"))
               .agg(F.count(y).alias("n"), grid_mean(y, MONEY_UNIT).alias("cat_mean"))
               .select(F.lit(c).alias("enc_column"), "category", "n", "cat_mean", smoothed.alias("encoded")))
        fitted = one if fitted is None else fitted.unionByName(one)
    fitted.write.parquet(path)
    return TargetEncoding(maps=spark.read.schema(fitted.schema).parquet(path), global_mean=gmean)


def build_features(df: DataFrame, zones: DataFrame, enc: TargetEncoding,
                   cfg: C.RunConfig = C.DEFAULT, keep=()) -> DataFrame:
    """PRJ-15: the 29 features in contract order (pickup time dropped), plus ``keep``."""
    t = with_temporal(df, cfg)
    s = with_spatial(t, zones)
    e = enc.apply(s)
    return e.select(*keep, *C.FEATURE_ORDER)


def serving_input(req: DataFrame) -> DataFrame:
    """PRJ-16: request columns to the trip shape; a missing vendor defaults to 2."""
    vendor = F.col("VendorID") if "VendorID" in req.columns else F.lit(None)
    return req.withColumn("VendorID", F.coalesce(vendor.cast("bigint"), F.lit(C.DEFAULT_VENDOR_ID).cast("bigint")))
