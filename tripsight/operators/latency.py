"""Load-test reports over a request log (AGG-23..25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.stats import decimal_mean
from .quantiles import quantile_columns

PCTS = (0.5, 0.9, 0.95, 0.99)
PCT_NAMES = ("p50_ms", "p90_ms", "p95_ms", "p99_ms")


def _first_key(log: DataFrame):
    """Order of requests: by time, the smallest request id first among equal times.

    One decimal holds both (a struct key would force a sort aggregate).
    """
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).cast("decimal(38,0)")
    if "request_id" not in log.columns:
        return at
    return (at.cast("decimal(18,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
            + F.col("request_id").cast("decimal(19,0)"))


def latency_report(log: DataFrame) -> DataFrame:
    """Per scenario: counts, throughput, cold start, mean, population std, min, percentiles, max, SLO.

    Statistics are over successful requests; the verdict checks cold start and
    p50/p95/p99 against the budget (throughput is reported, not judged).
    """
    ok = log.where("ok")
    base = log.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if("ok").alias("success"),
        F.count_if(~F.col("ok")).alias("errors"),
        (F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).cast("double") / 1.0e6).alias("elapsed_s"),
        F.min_by("latency_ms", _first_key(log)).alias("cold_start_ms"))
    stats = ok.groupBy("scenario").agg(
        decimal_mean(F.col("latency_ms")).alias("mean_ms"), F.stddev_pop("latency_ms").alias("std_ms"),
        F.min("latency_ms").alias("min_ms"), F.max("latency_ms").alias("max_ms"))
    # scenarios come from the data (no proven bound): no broadcast hints, AQE
    # turns these joins of per-scenario aggregates into broadcasts after measuring
    pct = quantile_columns(ok, "latency_ms", PCTS, PCT_NAMES, groups=["scenario"])
    out = base.join(stats, "scenario", "left").join(pct, "scenario", "left")
    b = C.LATENCY_BUDGET_MS
    sla = ((F.col("cold_start_ms") <= b["cold_start_ms"]) & (F.col("p50_ms") <= b["p50_ms"])
           & (F.col("p95_ms") <= b["p95_ms"]) & (F.col("p99_ms") <= b["p99_ms"]))
    return out.select("scenario", "total_requests", "success", "errors", "elapsed_s",
                      F.try_divide(F.col("success").cast("double"), F.col("elapsed_s")).alias("throughput_rps"),
                      "cold_start_ms", "mean_ms", "std_ms", "min_ms", *PCT_NAMES, "max_ms",
                      F.coalesce(sla, F.lit(False)).alias("sla_passed"))


def latency_components(log: DataFrame, components) -> DataFrame:
    """Mean latency per component, one column per listed component; requests of others are counted in ``unlisted``."""
    known = F.col("component").isin(*components)
    return log.groupBy("scenario").agg(
        *[decimal_mean(F.when(F.col("component") == c, F.col("latency_ms"))).alias(c) for c in components],
        F.count_if(~F.coalesce(known, F.lit(False))).alias("unlisted"))


def before_after(report: DataFrame, before: str, after: str) -> DataFrame:
    """Relative change of each report metric from scenario ``before`` to ``after`` (2-row input)."""
    metrics = ["mean_ms", "p50_ms", "p95_ms", "p99_ms", "max_ms", "cold_start_ms", "throughput_rps"]
    pick = lambda s, m: F.max(F.when(F.col("scenario") == s, F.col(m)))
    one = report.agg(*[pick(before, m).alias(f"b_{m}") for m in metrics],
                     *[pick(after, m).alias(f"a_{m}") for m in metrics])
    rows = ", ".join(f"'{m}', b_{m}, a_{m}" for m in metrics)
    long = one.selectExpr(f"stack({len(metrics)}, {rows}) as (metric, before, after)")
    # lower is better for latencies, higher for throughput
    imp = F.when(F.col("metric") == "throughput_rps", F.try_divide((F.col("after") - F.col("before")) * 100.0,
                                                                   F.col("before"))) \
        .otherwise(F.try_divide((F.col("before") - F.col("after")) * 100.0, F.col("before")))
    return long.withColumn("improvement_pct", imp)
