"""SQL-expressible predictors, regression metrics, residual slices, folds, leaderboard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.literals import ts_ntz
from ..functions.stats import MINUTE_UNIT, MONEY_UNIT, grid_mean
from ..session import scratch_path
from .broadcast import bounded_broadcast

PU = "tpep_pickup_datetime"
TARGET_KEYS = {"fare": "fare_amount", "duration": "duration_minutes"}
UNITS = {"fare_amount": MONEY_UNIT, "duration_minutes": MINUTE_UNIT}
EPS = 2.220446049250313e-16


# --- predictors ------------------------------------------------------------------------

@dataclass
class MeanPredictor:
    """MOD-01: the train mean of each target (two numbers)."""

    means: dict

    @classmethod
    def fit(cls, train: DataFrame) -> "MeanPredictor":
        row = train.agg(*[grid_mean(F.col(t), UNITS[t]).alias(k) for k, t in TARGET_KEYS.items()]).first()
        return cls({k: row[k] for k in TARGET_KEYS})

    def predict(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[F.lit(self.means[k]).cast("double").alias(f"pred_{k}") for k in TARGET_KEYS])


@dataclass
class ZoneMeanPredictor:
    """Smoothed pickup-zone mean of each target, fitted on train (m = 10).

    For fare this is exactly the ``PULocationID`` target encoding; unseen zones
    get the train mean. The map is a written table of one row per zone, joined
    without a hint: Spark decides on a broadcast by its written size.
    """

    maps: DataFrame           # PULocationID, pred_fare, pred_duration
    means: dict
    smoothing: float = C.ENCODING_SMOOTHING

    @classmethod
    def fit(cls, train: DataFrame, smoothing: float = C.ENCODING_SMOOTHING) -> "ZoneMeanPredictor":
        spark = train.sparkSession
        g = MeanPredictor.fit(train).means
        m = F.lit(float(smoothing))
        aggs = [F.count(F.lit(1)).alias("n")]
        aggs += [grid_mean(F.col(t), UNITS[t]).alias(f"mean_{k}") for k, t in TARGET_KEYS.items()]
        fitted = train.groupBy("PULocationID").agg(*aggs).select(
            "PULocationID",
            *[((F.col("n") * F.col(f"mean_{k}") + m * F.lit(g[k])) / (F.col("n") + m)).alias(f"pred_{k}")
              for k in TARGET_KEYS])
        path = scratch_path(spark, "zone-means")
        fitted.write.parquet(path)
        return cls(spark.read.schema(fitted.schema).parquet(path), g, smoothing)

    def predict(self, df: DataFrame) -> DataFrame:
        mp = self.maps.withColumnRenamed("PULocationID", "_zone")
        out = df.join(mp, df["PULocationID"] == mp["_zone"], "left").drop("_zone")
        for k in TARGET_KEYS:
            out = out.withColumn(f"pred_{k}", F.coalesce(F.col(f"pred_{k}"), F.lit(self.means[k]).cast("double")))
        return out


def with_residuals(pred: DataFrame) -> DataFrame:
    """PRJ-26: residual and absolute residual per target."""
    cols = []
    for k, t in TARGET_KEYS.items():
        r = F.col(t) - F.col(f"pred_{k}")
        cols += [r.alias(f"res_{k}"), F.abs(r).alias(f"abs_res_{k}")]
    return pred.select("*", *cols)


# --- metrics (AGG-21/22) ----------------------------------------------------------------

def metric_columns(y: Column, yhat: Column, eps_mape: bool = False) -> list[Column]:
    e = y - yhat
    if eps_mape:
        mape = F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))) * 100.0
    else:
        mape = F.coalesce(F.avg(F.when(y != 0, F.abs(e / y))) * 100.0, F.lit(0.0))
    n = F.count(y).cast("double")
    # SS_tot from the (merge-stable) population variance; no second pass over the rows
    r2 = F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * n)
    return [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), mape.alias("mape_pct"), r2.alias("r2"),
            F.count(y).alias("rows")]


def regression_metrics(pred: DataFrame, model: str, eps_mape: bool = False) -> DataFrame:
    """One row per target: model, target, mae, rmse, mape_pct, r2, rows (one pass for both)."""
    parts = []
    one_aggs = []
    for i, (k, t) in enumerate(TARGET_KEYS.items()):
        for c, name in zip(metric_columns(F.col(t), F.col(f"pred_{k}"), eps_mape),
                           ("mae", "rmse", "mape_pct", "r2", "rows")):
            one_aggs.append(c.alias(f"{name}_{i}"))
        parts.append(f"'{k}', mae_{i}, rmse_{i}, mape_pct_{i}, r2_{i}, rows_{i}")
    one = pred.agg(*one_aggs)
    out = one.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (target, mae, rmse, mape_pct, r2, rows)")
    return out.select(F.lit(model).alias("model"), "*")


# --- residual slices (AGG-16..20) ------------------------------------------------------

def distance_bucket(d: Column) -> Column:
    """PRJ-24: right-closed bins (0,2], (2,10], (10,1000]; outside -> null."""
    expr = None
    for lo, hi, label in C.DISTANCE_BINS:
        cond = (d > lo) & (d <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bucket_dimension(spark) -> DataFrame:
    rows = [(i, label) for i, (_, _, label) in enumerate(C.DISTANCE_BINS)]
    return spark.createDataFrame(rows, "bucket_order int, distance_bucket string")


def slice_frame(res: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds the four slicing keys: hour, pickup borough ('Unknown' default), bucket, code."""
    z = bounded_broadcast(zones.select(F.col("LocationID").alias("_z"), F.col("Borough").alias("_b")), 265)
    res = res.drop("pickup_hour", "pu_borough", "distance_bucket")  # model outputs may carry the hour already
    out = res.join(z, res["PULocationID"] == z["_z"], "left")
    return out.select("*", F.hour(PU).alias("pickup_hour"), F.coalesce("_b", F.lit("Unknown")).alias("pu_borough"),
                      distance_bucket(F.col("trip_distance")).alias("distance_bucket")).drop("_z", "_b")


def _slice_aggs(with_mean_res: bool = True) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("trips"), F.avg("abs_res_fare").alias("fare_mae")]
    if with_mean_res:
        aggs.append(F.avg("res_fare").alias("fare_mean_res"))
    aggs.append(F.avg("abs_res_duration").alias("dur_mae"))
    if with_mean_res:
        aggs.append(F.avg("res_duration").alias("dur_mean_res"))
    return aggs


def residuals_by(sl: DataFrame, key: str) -> DataFrame:
    """AGG-16/17/19: trips, MAE and mean residual per key (null keys dropped)."""
    return sl.where(F.col(key).isNotNull()).groupBy(key).agg(*_slice_aggs())


def residuals_by_distance(sl: DataFrame) -> DataFrame:
    """AGG-18 + JOIN-07: every bucket reported, empty ones with 0 trips."""
    agg = sl.where(F.col("distance_bucket").isNotNull()).groupBy("distance_bucket").agg(*_slice_aggs(False))
    dim = bounded_broadcast(bucket_dimension(sl.sparkSession), len(C.DISTANCE_BINS))
    return dim.join(agg, "distance_bucket", "left").select(
        "bucket_order", "distance_bucket", F.coalesce("trips", F.lit(0)).cast("bigint").alias("trips"),
        "fare_mae", "dur_mae")


def residual_slices(sl: DataFrame) -> DataFrame:
    """AGG-20: all four slices from ONE grouping-sets pass, tagged by slice name."""
    keyed = sl.select(F.col("pickup_hour").cast("string").alias("hour"), F.col("pu_borough").alias("borough"),
                      F.col("distance_bucket"), F.col("RatecodeID").cast("string").alias("ratecode"),
                      "res_fare", "abs_res_fare", "res_duration", "abs_res_duration")
    keys = ["hour", "borough", "distance_bucket", "ratecode"]
    g = keyed.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("_gid"), *_slice_aggs())
    full = (1 << len(keys)) - 1
    name = F.coalesce(*[F.when(F.col("_gid") == (full & ~(1 << (len(keys) - 1 - i))), F.lit(k))
                        for i, k in enumerate(keys)])
    value = F.coalesce(*[F.when(F.col("_gid") == (full & ~(1 << (len(keys) - 1 - i))), F.col(k))
                         for i, k in enumerate(keys)])
    out = g.select(name.alias("slice"), value.alias("slice_key"), "trips", "fare_mae", "fare_mean_res", "dur_mae",
                   "dur_mean_res").where(F.col("slice_key").isNotNull())
    # distance buckets without trips are still reported
    dim = bucket_dimension(sl.sparkSession).select(F.lit("distance_bucket").alias("slice"),
                                                   F.col("distance_bucket").alias("slice_key"))
    empty = dim.join(out, ["slice", "slice_key"], "left_anti").select(
        "slice", "slice_key", F.lit(0).cast("bigint").alias("trips"), *[F.lit(None).cast("double").alias(c) for c in
                                                                         ("fare_mae", "fare_mean_res", "dur_mae",
                                                                          "dur_mean_res")])
    return out.unionByName(empty)


# --- forward-only folds (MOD-07 / SRT-02) -----------------------------------------------

FOLD_COLS = ("rows", "test_start", "test_fold")

def fold_cuts(df: DataFrame, n_splits: int, time_col: str, id_col: str) -> tuple[int, list[tuple]]:
    """Row count and, for each fold, (rows before its test window, first time, first id).

    Hourly counts place every cut in an hour, then counts by second inside those hours place it
    in a second; only the rows of those seconds are ranked. The driver sees one row per cut.
    """
    n = df.count()
    size = n // (n_splits + 1)
    if not size:
        return n, []
    ranks = [n - (n_splits - f) * size for f in range(n_splits)]
    cuts = [(r, None, r) for r in ranks]  # (global rank, span that holds it, rank inside the span)
    rows = df
    for unit in ("hour", "second"):
        spans = rows.groupBy(F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz").alias("_s"))
        counts = spans.agg(F.count(F.lit(1)).alias("_c"))
        # one row per hour of the data, or per second of at most n_splits hours
        w = Window.partitionBy(F.date_trunc("hour", "_s")).orderBy("_s") if unit == "second" else Window.orderBy("_s")
        ends = counts.withColumn("_end", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        found = []
        for rank, span, inner in cuts:
            here = ends if span is None else ends.where(F.date_trunc("hour", "_s").cast("timestamp_ntz") == ts_ntz(span))
            r = here.where(F.col("_end") > inner).orderBy("_s").first()
            found.append((rank, r["_s"], inner - (r["_end"] - r["_c"])))
        cuts = found
        keep = F.lit(False)
        for span in {s for _, s, _ in cuts}:
            keep = keep | (F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz") == ts_ntz(span))
        rows = rows.where(keep)
    out = []
    for rank, span, inner in cuts:
        second = rows.where(F.date_trunc("second", F.col(time_col)).cast("timestamp_ntz") == ts_ntz(span))
        # times inside a second: a million at most
        counts = second.groupBy(time_col).agg(F.count(F.lit(1)).alias("_c"))
        ends = counts.withColumn("_end", F.sum("_c").over(Window.orderBy(time_col).rowsBetween(
            Window.unboundedPreceding, 0)))
        r = ends.where(F.col("_end") > inner).orderBy(time_col).first()
        same = second.where(F.col(time_col) == F.lit(r[time_col]))
        out.append((rank, r[time_col], nth_id(same, id_col, inner - (r["_end"] - r["_c"]))))
    return n, out


#: Ids that are sorted at once, and parts into which a larger range of ids is counted.
IDS_SORTED, ID_PARTS = 10_000, 4_096


def nth_id(rows: DataFrame, id_col: str, rank: int) -> int:
    """The id of rank ``rank`` (from 0) among ``rows``: counts by range, down to a range of few rows.

    However many rows share a time, no task sorts more than ``IDS_SORTED`` of them.
    """
    lo, hi, n = rows.agg(F.min(id_col), F.max(id_col), F.count(F.lit(1))).first()
    while n > IDS_SORTED and lo < hi:
        width = max(1, -(-(hi - lo + 1) // ID_PARTS))
        part = F.expr(f"({id_col} - ({lo}L)) div {width}L")
        inside = rows.where(F.col(id_col).between(lo, hi))
        counts = sorted((r["_p"], r["_c"]) for r in inside.groupBy(part.alias("_p")).agg(
            F.count(F.lit(1)).alias("_c")).collect())  # at most ID_PARTS rows
        for p, c in counts:
            if rank < c:
                lo, hi, n = lo + p * width, min(hi, lo + (p + 1) * width - 1), c
                break
            rank -= c
    if lo == hi:
        return lo
    return rows.where(F.col(id_col).between(lo, hi)).select(id_col).orderBy(id_col).limit(rank + 1).agg(
        F.max(id_col)).first()[0]


def fold_assignment(df: DataFrame, n_splits: int = 3, order=(PU, "trip_id")) -> DataFrame:
    """The fold whose test window holds each row, by pickup time (id breaks ties).

    Fold size is n // (k+1) (``TimeSeriesSplit``); fold f tests rows
    [n - (k-f)*size, n - (k-f-1)*size) and trains on every earlier row, that is on
    ``test_fold`` null or less than f. Folds follow from comparing each row with
    the k cut keys: no global sort, no second read of the rows.
    """
    time_col, id_col = order
    n, cuts = fold_cuts(df, n_splits, time_col, id_col)
    fold, start = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for f, (rank, at, key) in enumerate(cuts):
        reached = (F.col(time_col) > ts_ntz(at)) | ((F.col(time_col) == ts_ntz(at)) & (F.col(id_col) >= F.lit(key)))
        fold = F.when(reached, F.lit(f)).otherwise(fold)
        start = F.when(reached, F.lit(rank)).otherwise(start)
    return df.withColumns({"rows": F.lit(n).cast("bigint"), "test_start": start, "test_fold": fold})


def before_fold(assigned: DataFrame, f: int) -> DataFrame:
    """Training rows of fold ``f``: everything before its test window."""
    return assigned.where(F.col("test_fold").isNull() | (F.col("test_fold") < f)).drop(*FOLD_COLS)


def fold_summary(assigned: DataFrame, n_splits: int = 3) -> DataFrame:
    """Per fold: train rows, test rows, last train pickup and first/last test pickup."""
    per_fold = assigned.where(F.col("test_fold").isNotNull()).groupBy("test_fold").agg(
        F.count(F.lit(1)).alias("test_rows"), F.min("test_start").alias("test_start"),
        F.min(PU).alias("test_first_pickup"), F.max(PU).alias("test_last_pickup"))
    return per_fold.select(F.col("test_fold").alias("fold"), F.col("test_start").alias("train_rows"), "test_rows",
                           "test_first_pickup", "test_last_pickup")


def fold_sizes(assigned: DataFrame) -> DataFrame:
    """Per fold: train rows, test rows, and the first and last (pickup, id) key of its test window."""
    key = F.struct(F.col(PU).alias("at"), F.col("trip_id").alias("id"))
    g = assigned.where(F.col("test_fold").isNotNull()).groupBy(F.col("test_fold").alias("fold")).agg(
        F.min("test_start").alias("train_rows"), F.count(F.lit(1)).alias("test_rows"),
        F.min(key).alias("lo"), F.max(key).alias("hi"))
    return g.select("fold", "train_rows", "test_rows", F.col("lo.at").alias("first_pickup"),
                    F.col("lo.id").alias("first_id"), F.col("hi.at").alias("last_pickup"), F.col("hi.id").alias("last_id"))


# --- leaderboard (SRT-06/07) ------------------------------------------------------------

def leaderboard(metrics: DataFrame) -> DataFrame:
    """Rank models per target by MAE (ties share a rank)."""
    w = Window.partitionBy("target").orderBy("mae")
    return metrics.withColumn("rank", F.rank().over(w))


def winner(board: DataFrame, metric: str = "mae") -> DataFrame:
    """Best model per target by ``metric``; improvement over the runner-up in percent."""
    w = Window.partitionBy("target").orderBy(F.col(metric), F.col("model"))
    ranked = board.select("target", "model", metric, F.row_number().over(w).alias("_rn"),
                          F.lead(metric).over(w).alias("_next"))
    return ranked.where("_rn = 1").select(
        "target", "model", F.col(metric).alias(f"best_{metric}"), F.col("_next").alias(f"runner_up_{metric}"),
        F.try_divide((F.col("_next") - F.col(metric)) * 100.0, F.col("_next")).alias("improvement_pct"))
