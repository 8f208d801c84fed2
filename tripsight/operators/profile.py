"""Profiles of the trip table: columns, null block, duplicates, targets, time, zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.stats import MINUTE_UNIT, MONEY_UNIT, grid_mean, pairwise_corr, sample_skewness
from .broadcast import bounded_broadcast
from .quantiles import quantile_columns, quantiles

PU = "tpep_pickup_datetime"
TARGET_UNITS = {"fare_amount": MONEY_UNIT, "duration_minutes": MINUTE_UNIT, "trip_distance": MONEY_UNIT}


def _stack(one: DataFrame, rows: list[list[str]], names: list[str]) -> DataFrame:
    body = ", ".join(", ".join(r) for r in rows)
    return one.selectExpr(f"stack({len(rows)}, {body}) as ({', '.join(names)})")


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """AGG-01: type, nulls, null %, distinct non-null values per column (one pass)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"nn{i}"))
        nd = F.approx_count_distinct(F.col(c)) if approx else F.count_distinct(F.col(c))
        aggs.append(nd.alias(f"nd{i}"))
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = [[f"{i + 1}L", f"'{c}'", f"'{types[c]}'", f"_n - nn{i}", f"nd{i}", "_n"] for i, c in enumerate(df.columns)]
    out = _stack(one, rows, ["position", "column_name", "dtype", "nulls", "distinct_values", "_n"])
    return out.select("position", "column_name", "dtype", "nulls",
                      F.try_divide(F.col("nulls") * 100.0, F.col("_n")).alias("null_pct"), "distinct_values")


def null_block_audit(df: DataFrame, block_col: str = "passenger_count",
                     partners=("RatecodeID", "store_and_fwd_flag")) -> DataFrame:
    """AGG-02: is the null block one set of rows, and does payment code 0 mark it."""
    blk = F.col(block_col).isNull()
    aggs = [F.count_if(blk).alias("block_rows"),
            F.try_divide(F.count_if(blk) * 100.0, F.count(F.lit(1))).alias("block_pct")]
    for p in partners:
        aggs.append(F.coalesce(F.bool_and(blk == F.col(p).isNull()), F.lit(True)).alias(f"same_mask_{p}"))
    aggs += [F.coalesce(F.bool_and(F.when(blk, F.col("payment_type") == 0)), F.lit(True)).alias("block_all_payment_0"),
             F.count_if((F.col("payment_type") == 0) & ~blk).alias("payment_0_outside_block")]
    return df.agg(*aggs)


def null_block_vendors(df: DataFrame, block_col: str = "passenger_count") -> DataFrame:
    """AGG-02: vendor mix inside the null block."""
    return df.where(F.col(block_col).isNull()).groupBy("VendorID").agg(F.count(F.lit(1)).alias("rows"))


def duplicate_rate(df: DataFrame, cols=None) -> DataFrame:
    """AGG-03: exact duplicate rows (null-safe grouping, like pandas ``duplicated``).

    The group-by combines map-side, so a row repeated a billion times costs
    one partial row per task.
    """
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").alias("rows"), F.sum(F.col("_c") - 1).alias("duplicate_rows")).select(
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.try_divide(F.col("duplicate_rows") * 100.0, F.col("rows")).alias("duplicate_pct"))


def describe(df: DataFrame, cols=("fare_amount", "duration_minutes", "trip_distance"),
             probs=(0.01, 0.25, 0.5, 0.75, 0.95, 0.99), approx: bool = False) -> DataFrame:
    """AGG-04: count, mean, sample std, min, percentiles, max per column (long form)."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), grid_mean(F.col(c), TARGET_UNITS.get(c, MONEY_UNIT)).alias(f"m{i}"),
                 F.stddev_samp(c).alias(f"s{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [[f"'{c}'", f"n{i}", f"m{i}", f"s{i}", f"cast(lo{i} as double)", f"cast(hi{i} as double)"]
            for i, c in enumerate(cols)]
    base = _stack(one, rows, ["column_name", "count", "mean", "std", "min", "max"])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("_s")).select("_s.*")
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    qs = quantile_columns(long, "v", probs, names, groups=["column_name"], approx=approx)
    return base.join(bounded_broadcast(qs, len(cols)), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *names, "max")


def log_target_skew(df: DataFrame, cols=("fare_amount", "duration_minutes", "trip_distance")) -> DataFrame:
    """AGG-05 / PRJ-19: bias-adjusted skew raw, of log1p(clip at 0), of log1p over positives."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [sample_skewness(x).alias(f"r{i}"),
                 sample_skewness(F.log1p(F.greatest(x, F.lit(0.0)))).alias(f"l{i}"),
                 sample_skewness(F.log1p(F.when(x > 0, x))).alias(f"p{i}")]
    one = df.agg(*aggs)
    return _stack(one, [[f"'{c}'", f"r{i}", f"l{i}", f"p{i}"] for i, c in enumerate(cols)],
                  ["column_name", "raw_skew", "log1p_skew", "log1p_positive_skew"])


def profile_by_hour(frame: DataFrame, approx: bool = False) -> DataFrame:
    """AGG-06: per pickup hour, mean fare and duration, median speed, trips."""
    means = frame.groupBy("hour").agg(grid_mean(F.col("fare_amount")).alias("mean_fare"),
                                      grid_mean(F.col("duration_minutes"), MINUTE_UNIT).alias("mean_duration"),
                                      F.count(F.lit(1)).alias("trips"))
    med = quantile_columns(frame, "speed_mph", [0.5], ["median_speed_mph"], groups=["hour"],
                           approx=approx)
    return means.join(bounded_broadcast(med, 24), "hour", "left").select(
        F.col("hour").cast("int").alias("hour"), "mean_fare", "mean_duration", "median_speed_mph", "trips")


def profile_by(frame: DataFrame, key: str, with_trips: bool = True) -> DataFrame:
    """AGG-07 / AGG-08: mean fare and duration (and trips) per key."""
    aggs = [grid_mean(F.col("fare_amount")).alias("mean_fare"),
            grid_mean(F.col("duration_minutes"), MINUTE_UNIT).alias("mean_duration")]
    if with_trips:
        aggs.append(F.count(F.lit(1)).alias("trips"))
    return frame.groupBy(key).agg(*aggs)


def hourly_peak_trough(in_month: DataFrame, days: float) -> DataFrame:
    """AGG-09: mean pickups per hour of day over the window's days; peak, trough, ratio."""
    per_hour = in_month.groupBy(F.hour(PU).alias("hour")).agg((F.count(F.lit(1)) / F.lit(float(days))).alias("rate"))
    # 24 rows: ties resolve to the earliest hour, like idxmax/idxmin
    one = per_hour.agg(
        F.max_by("hour", F.struct(F.col("rate"), -F.col("hour"))).alias("peak_hour"),
        F.max("rate").alias("peak_per_hour"),
        F.min_by("hour", F.struct(F.col("rate"), F.col("hour"))).alias("trough_hour"),
        F.min("rate").alias("trough_per_hour"),
        F.sum("rate").alias("rides_per_day"))
    return one.select(F.col("peak_hour").cast("int").alias("peak_hour"), "peak_per_hour",
                      F.col("trough_hour").cast("int").alias("trough_hour"), "trough_per_hour",
                      F.try_divide(F.col("peak_per_hour"), F.col("trough_per_hour")).alias("peak_trough_ratio"),
                      "rides_per_day")


def ratecode_name(code: Column) -> Column:
    """PRJ-23: rate-code label with '?' for unknown codes."""
    m = F.create_map(*[x for k, v in C.RATECODE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, code.cast("int")), F.lit("?"))


def ratecode_profile(frame: DataFrame, min_trips: int = 0) -> DataFrame:
    """AGG-10: trips, mean fare, duration, distance per rate code (null code dropped)."""
    g = frame.where(F.col("RatecodeID").isNotNull()).groupBy("RatecodeID").agg(
        F.count(F.lit(1)).alias("trips"), grid_mean(F.col("fare_amount")).alias("mean_fare"),
        grid_mean(F.col("duration_minutes"), MINUTE_UNIT).alias("mean_duration"),
        grid_mean(F.col("trip_distance")).alias("mean_distance"))
    g = g.where(F.col("trips") > min_trips)
    return g.select("RatecodeID", ratecode_name(F.col("RatecodeID")).alias("name"), "trips", "mean_fare",
                    "mean_duration", "mean_distance").orderBy(F.desc("trips"), "RatecodeID")


def feature_correlations(frame: DataFrame, features, targets=("fare_amount", "duration_minutes")) -> DataFrame:
    """AGG-11: pairwise-complete Pearson correlation of each feature with each target."""
    aggs = [pairwise_corr(F.col(f).cast("double"), F.col(t)).alias(f"c_{i}_{j}")
            for i, f in enumerate(features) for j, t in enumerate(targets)]
    one = frame.agg(*aggs)
    rows = [[f"'{f}'"] + [f"c_{i}_{j}" for j in range(len(targets))] for i, f in enumerate(features)]
    return _stack(one, rows, ["feature"] + [f"corr_{t}" for t in targets])


def histogram(df: DataFrame, cols=("fare_amount", "duration_minutes"), bins: int = 80) -> DataFrame:
    """AGG-13: equal-width histograms (raw and log1p), right edge in the last bin, empty bins kept."""
    parts = []
    for c in cols:
        parts.append(F.struct(F.lit(c).alias("target"), F.lit("raw").alias("scale"), F.col(c).alias("x")))
        parts.append(F.struct(F.lit(c).alias("target"), F.lit("log1p").alias("scale"), F.log1p(F.col(c)).alias("x")))
    long = df.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*").where(F.col("x").isNotNull())
    rng = long.groupBy("target", "scale").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    nkeys = 2 * len(cols)
    rng_b = bounded_broadcast(rng, nkeys)
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    idx = F.least(F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))),
                  F.lit(bins - 1))
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(idx)
    counts = long.join(rng_b, ["target", "scale"]).groupBy("target", "scale", idx.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"))
    # bin dimension generated from the 4 range rows (no join of data with data)
    dim = rng.select("target", "scale", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    dim = dim.select("target", "scale", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                     (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"))
    out = dim.join(counts, ["target", "scale", "bin"], "left").select(
        "target", "scale", "bin", "bin_lo", "bin_hi", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))
    w = Window.partitionBy("target", "scale")
    return out.withColumn("share_of_mode", F.try_divide(F.col("rows").cast("double"), F.max("rows").over(w)))


def target_headline(in_month: DataFrame, approx: bool = False) -> DataFrame:
    """AGG-14: fare median / p99 / max and duration median."""
    long = in_month.select(F.explode(F.array(
        F.struct(F.lit("fare").alias("k"), F.col("fare_amount").alias("v")),
        F.struct(F.lit("duration").alias("k"), F.col("duration_minutes").alias("v")))).alias("_s")).select("_s.*")
    q = quantiles(long, "v", [0.5, 0.99, 1.0], ["k"], approx=approx)
    pick = lambda k, p: F.max(F.when((F.col("k") == k) & (F.col("p") == p), F.col("q")))
    return q.agg(pick("fare", 0.5).alias("fare_median"), pick("fare", 0.99).alias("fare_p99"),
                 pick("fare", 1.0).alias("fare_max"), pick("duration", 0.5).alias("duration_median"))


def zone_coverage(frame: DataFrame, zones: DataFrame) -> DataFrame:
    """AGG-15: id ranges, distinct pickup zones, zones and boroughs in the look-up."""
    t = frame.select(F.col("PULocationID").alias("pu"), F.col("DOLocationID").alias("do"),
                     F.lit(None).cast("bigint").alias("zone"), F.lit(None).cast("string").alias("borough"))
    z = zones.select(F.lit(None).cast("bigint").alias("pu"), F.lit(None).cast("bigint").alias("do"),
                     F.col("LocationID").alias("zone"), F.col("Borough").alias("borough"))
    both = t.unionByName(z)  # one aggregate over both inputs instead of joining two 1-row results
    return both.agg(F.min("pu").alias("pu_min"), F.max("pu").alias("pu_max"), F.min("do").alias("do_min"),
                    F.max("do").alias("do_max"), F.count_distinct("pu").alias("pickup_zones_used"),
                    F.count("zone").alias("zones_in_lookup"), F.count_distinct("borough").alias("boroughs"))


def top_pickup_zones(frame: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """SRT-03 + JOIN-05: top-n pickup zones by trips with name, borough, mean fare.

    One aggregate gives count and mean per zone; the top-n is a
    TakeOrderedAndProject (no global sort), then a join to the 265-row look-up.
    """
    g = frame.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trips"),
                                         grid_mean(F.col("fare_amount")).alias("mean_fare"))
    top = g.orderBy(F.desc("trips"), "PULocationID").limit(n)
    z = bounded_broadcast(zones.select(F.col("LocationID").alias("PULocationID"), "Zone", "Borough"), 265)
    out = top.join(z, "PULocationID", "left").select(
        "PULocationID", "trips", F.coalesce("Zone", F.lit("-")).alias("zone"),
        F.coalesce("Borough", F.lit("-")).alias("borough"), "mean_fare")
    return out.orderBy(F.desc("trips"), "PULocationID")
