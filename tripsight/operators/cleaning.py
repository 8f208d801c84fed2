"""Duration, cleaning rules with counted cost, leakage-safe projection, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import minutes_between
from ..functions.literals import ts_ntz

PU, DO = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def with_duration(df: DataFrame) -> DataFrame:
    """PRJ-01: ``duration_minutes`` = dropoff - pickup in fractional minutes."""
    return df.withColumn("duration_minutes", minutes_between(F.col(PU), F.col(DO)))


def _ok(cond: Column) -> Column:
    # a missing value fails the rule (pandas compares NaN as False)
    return F.coalesce(cond, F.lit(False))


def cleaning_rules(cfg: C.RunConfig = C.DEFAULT, null_safe: bool = True) -> list[tuple[str, Column]]:
    """FLT-01..07: (stat key, keep-condition) in rule order.

    ``null_safe`` turns a missing value into a failed rule (pandas compares NaN
    as False); a WHERE clause already drops NULL, so the filter path uses the
    bare predicates, which the scan can push down to parquet statistics.
    """
    ts = F.col(PU)
    ok = _ok if null_safe else (lambda c: c)
    return [
        ("out_of_bound_timestamps", ok((ts >= ts_ntz(cfg.month_start)) & (ts < ts_ntz(cfg.month_end)))),
        ("invalid_durations", ok(F.col("duration_minutes").between(C.MIN_DURATION, C.MAX_DURATION))),
        ("invalid_fares", ok(F.col("fare_amount").between(C.MIN_FARE, C.MAX_FARE))),
        ("invalid_trip_distances", ok(F.col("trip_distance").between(C.MIN_DISTANCE, C.MAX_DISTANCE))),
        ("invalid_passenger_counts", ok(F.col("passenger_count").between(C.MIN_PASSENGERS, C.MAX_PASSENGERS))),
        ("invalid_ratecodes", ok(F.col("RatecodeID").isin(*C.VALID_RATECODES))),
        ("invalid_location_ids", ok(F.col("PULocationID").between(C.MIN_LOCATION_ID, C.MAX_LOCATION_ID)
                                    & F.col("DOLocationID").between(C.MIN_LOCATION_ID, C.MAX_LOCATION_ID))),
    ]


def speed_rule(max_mph: float = 100.0, null_safe: bool = True) -> tuple[str, Column]:
    """OPT-05: implied speed plausibility as an eighth rule (off by default)."""
    mph = F.try_divide(F.col("trip_distance"), F.col("duration_minutes") / 60.0)
    return ("implausible_speeds", _ok(mph <= max_mph) if null_safe else mph <= max_mph)


def first_failing_rule(rules: list[tuple[str, Column]]) -> Column:
    """Index (1-based) of the first rule a row fails; 0 when it passes all.

    Sequential cleaning counts each dropped row under the first rule it fails,
    so one ``when`` chain attributes every row in a single scan.
    """
    expr = None
    for i, (_, keep) in enumerate(rules, start=1):
        expr = F.when(~keep, F.lit(i)) if expr is None else expr.when(~keep, F.lit(i))
    return expr.otherwise(F.lit(0))


def clean(df: DataFrame, cfg: C.RunConfig = C.DEFAULT, extra_rules=()) -> DataFrame:
    """Rows passing every rule (a plain conjunction, so filters can reach the scan)."""
    conds = [keep for _, keep in cleaning_rules(cfg, null_safe=False)] + [k for _, k in extra_rules]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.where(cond)


def cleaning_cost(df: DataFrame, cfg: C.RunConfig = C.DEFAULT, extra_rules=()) -> DataFrame:
    """FLT-08: rows dropped per rule (sequential), totals and retention, one pass.

    A single global aggregate of conditional counts: every task emits one
    partial row, so the cost does not depend on key skew or data size.
    """
    rules = cleaning_rules(cfg) + list(extra_rules)
    names = [n for n, _ in rules]
    tagged = df.select(first_failing_rule(rules).alias("_rule"))
    aggs = [F.count_if(F.col("_rule") == i).alias(n) for i, n in enumerate(names, start=1)]
    aggs += [F.count(F.lit(1)).alias("total_initial_rows"),
             F.count_if(F.col("_rule") == 0).alias("total_final_rows")]
    one = tagged.agg(*aggs)
    one = one.select(
        *names, "total_initial_rows", "total_final_rows",
        (F.col("total_initial_rows") - F.col("total_final_rows")).alias("total_dropped_rows"),
        F.try_divide(F.col("total_final_rows") * 100.0, F.col("total_initial_rows")).alias("retention_rate_pct"),
    )
    keys = names + ["total_initial_rows", "total_final_rows", "total_dropped_rows", "retention_rate_pct"]
    stack = ", ".join(f"{i}L, '{k}', cast(`{k}` as double)" for i, k in enumerate(keys, start=1))
    return one.selectExpr(f"stack({len(keys)}, {stack}) as (stat_order, stat, value)")


def leakage_safe(df: DataFrame, keys=()) -> DataFrame:
    """PRJ-02: keep allowed features + targets (present ones) in contract order.

    ``keys`` (row ids such as ``trip_id``) are carried after the contract columns.
    """
    keep = [c for c in C.ALLOWED_FEATURES + C.TARGETS if c in df.columns]
    out = df.select(*keep, *keys)
    leaked = sorted(set(out.columns) & set(C.BANNED_COLUMNS))
    if leaked:
        raise AssertionError(f"LEAKAGE ERROR: banned columns survived: {leaked}")
    return out


def validate_feature_contract(columns) -> None:
    """PRJ-03: raise listing sorted banned or target columns among features."""
    bad = sorted((set(columns) & set(C.BANNED_COLUMNS)) | (set(columns) & set(C.TARGETS)))
    if bad:
        raise ValueError(f"Feature contract violated; forbidden columns present: {bad}")


def eda_outlier_rules(cfg: C.RunConfig = C.DEFAULT) -> list[tuple[str, Column]]:
    """FLT-09: the nine independent notebook rules (True = outlier)."""
    dur, fare, dist, pax, ts = (F.col("duration_minutes"), F.col("fare_amount"), F.col("trip_distance"),
                                F.col("passenger_count"), F.col(PU))
    hit = lambda c: F.coalesce(c, F.lit(False))
    return [
        ("duration <= 0", hit(dur <= 0)),
        ("duration > 360 min", hit(dur > C.EDA_MAX_DURATION)),
        ("fare <= 0", hit(fare <= 0)),
        ("fare > 500", hit(fare > C.EDA_MAX_FARE)),
        ("distance == 0", hit(dist == 0)),
        ("distance > 100 mi", hit(dist > C.EDA_MAX_DISTANCE)),
        ("passenger_count == 0", hit(pax == 0)),
        ("passenger_count > 6", hit(pax > C.EDA_MAX_PASSENGERS)),
        # closed at both ends, unlike the cleaning month; a missing time is outside
        ("pickup outside month", ~hit(ts.between(ts_ntz(cfg.month_start), ts_ntz(cfg.month_end)))),
    ]


def any_eda_outlier(cfg: C.RunConfig = C.DEFAULT) -> Column:
    cond = F.lit(False)
    for _, c in eda_outlier_rules(cfg):
        cond = cond | c
    return cond


def eda_clean(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """Notebook analysis frame: rows hit by none of the nine rules."""
    return df.where(~any_eda_outlier(cfg))


def outlier_rules_union(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """FLT-09: rows and percent per independent rule, plus the union row; one pass."""
    rules = eda_outlier_rules(cfg)
    aggs = [F.count_if(c).alias(f"r{i}") for i, (_, c) in enumerate(rules)]
    aggs += [F.count_if(any_eda_outlier(cfg)).alias("r_union"), F.count(F.lit(1)).alias("n")]
    one = df.agg(*aggs)
    parts = [f"{i + 1}L, '{name}', r{i}" for i, (name, _) in enumerate(rules)]
    parts.append(f"{len(rules) + 1}L, 'UNION (any rule)', r_union")
    out = one.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (rule_order, rule, rows)", "n")
    return out.select("rule_order", "rule", "rows",
                      F.try_divide(F.col("rows") * 100.0, F.col("n")).alias("pct"))


def with_split(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """FLT-10: ``split`` = train before the boundary, test at or after it."""
    return df.withColumn("split", F.when(F.col(PU) < ts_ntz(cfg.split_at), F.lit("train"))
                         .when(F.col(PU) >= ts_ntz(cfg.split_at), F.lit("test")))


def split_frames(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> tuple[DataFrame, DataFrame]:
    b = ts_ntz(cfg.split_at)
    return df.where(F.col(PU) < b), df.where(F.col(PU) >= b)


def split_summary(split_df: DataFrame) -> DataFrame:
    """FLT-11: rows, share, first and last pickup per side."""
    from pyspark.sql import Window
    g = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                      F.min(PU).alias("first_pickup"), F.max(PU).alias("last_pickup"))
    # two rows after the aggregate: the window over them is trivially small
    return g.withColumn("share_pct", F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()))


def split_overlap(split_df: DataFrame) -> DataFrame:
    """FLT-12: last train pickup, first test pickup and whether they overlap.

    Conditional aggregates in one pass instead of two aggregates joined.
    """
    one = split_df.agg(
        F.max(F.when(F.col("split") == "train", F.col(PU))).alias("train_last_pickup"),
        F.min(F.when(F.col("split") == "test", F.col(PU))).alias("test_first_pickup"),
    )
    return one.withColumn("overlap", F.coalesce(F.col("train_last_pickup") >= F.col("test_first_pickup"),
                                                F.lit(False)))


def assert_no_overlap(train: DataFrame, test: DataFrame) -> None:
    """FLT-12 guard: raise when the periods overlap (skipped if a side is empty)."""
    tr = train.agg(F.max(PU)).first()[0]
    te = test.agg(F.min(PU)).first()[0]
    if tr is not None and te is not None and tr >= te:
        raise ValueError(f"Train and test periods overlap: train ends {tr}, test starts {te}")


def require_columns(df: DataFrame, cols) -> None:
    """FLT-19: raise when a required (target) column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def out_of_window_by_year(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """FLT-18: pickups outside the (closed) window, counted by year."""
    ts = F.col(PU)
    out = df.where(~F.coalesce(ts.between(ts_ntz(cfg.month_start), ts_ntz(cfg.month_end)), F.lit(False)))
    return out.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_pickup"), F.max(ts).alias("last_pickup"))


def sanity_window_corr(in_month: DataFrame) -> DataFrame:
    """FLT-14 + AGG-12: correlations raw vs inside the loose sanity window."""
    from ..functions.stats import pairwise_corr
    m = (F.col("fare_amount").between(*C.SANITY_FARE)
         & F.col("trip_distance").between(*C.SANITY_DISTANCE)
         & F.col("duration_minutes").between(*C.SANITY_DURATION))
    m = F.coalesce(m, F.lit(False))
    dist, fare, pax = F.col("trip_distance"), F.col("fare_amount"), F.col("passenger_count")
    return in_month.agg(
        pairwise_corr(dist, fare).alias("corr_distance_fare_raw"),
        pairwise_corr(F.when(m, dist), F.when(m, fare)).alias("corr_distance_fare_sane"),
        pairwise_corr(F.when(m, pax), F.when(m, fare)).alias("corr_passenger_fare_sane"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(m).alias("sane_rows"),
    ).withColumn("sane_pct", F.try_divide(F.col("sane_rows") * 100.0, F.col("rows")))


def in_month(df: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    ts = F.col(PU)
    return df.where((ts >= ts_ntz(cfg.month_start)) & (ts < ts_ntz(cfg.month_end)))


# --- request validation (FLT-15) -------------------------------------------------

ISO_SECONDS = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})$"


def parse_pickup(s: Column) -> Column:
    """ISO text (yyyy-MM-ddTHH:mm:ss) to TIMESTAMP_NTZ; anything else, or an impossible
    date, gives NULL instead of failing. No session time zone is involved: one pattern
    check, then fixed-position fields."""
    part = lambda pos, n: F.substring(s, pos, n).cast("int")
    return F.when(s.rlike(ISO_SECONDS), F.try_make_timestamp_ntz(
        part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), part(18, 2).cast("decimal(16,6)")))


def request_failures(req: DataFrame) -> DataFrame:
    """Adds ``pickup_ts``, ``failed_fields`` (names in field order) and ``valid``."""
    ts = parse_pickup(F.col("tpep_pickup_datetime"))
    checks = [
        ("PULocationID", F.col("PULocationID").between(C.MIN_LOCATION_ID, C.MAX_LOCATION_ID)),
        ("DOLocationID", F.col("DOLocationID").between(C.MIN_LOCATION_ID, C.MAX_LOCATION_ID)),
        ("tpep_pickup_datetime", ts.isNotNull()),
        ("passenger_count", F.col("passenger_count").between(C.MIN_PASSENGERS, C.MAX_PASSENGERS)),
        ("RatecodeID", F.col("RatecodeID").between(*C.REQUEST_RATECODE_RANGE)),
        ("trip_distance", (F.col("trip_distance") > 0.0) & (F.col("trip_distance") <= C.REQUEST_MAX_DISTANCE)),
    ]
    arr = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks])
    failed = F.filter(arr, lambda x: x.isNotNull())
    return (req.withColumn("pickup_ts", ts)
            .withColumn("failed_fields", failed)
            .withColumn("valid", F.size("failed_fields") == 0))
