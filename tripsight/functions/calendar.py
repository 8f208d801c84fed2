"""Calendar parts of the pickup time."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def weekday_mon0(ts: Column) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(ts)


def is_rush_hour(hour: Column, weekday: Column) -> Column:
    am = hour.between(*C.AM_RUSH)
    pm = hour.between(*C.PM_RUSH)
    return ((weekday < 5) & (am | pm)).cast("int")


def is_holiday(ts: Column, holidays) -> Column:
    cond = F.lit(False)
    for m, d in holidays:
        cond = cond | ((F.month(ts) == m) & (F.dayofmonth(ts) == d))
    return cond.cast("int")


def cyclic(x: Column, period: float):
    ang = F.lit(2.0 * math.pi) * x / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def temporal_columns(ts: Column, holidays) -> list[Column]:
    """The ten calendar features in contract order."""
    hour = F.hour(ts)
    dow = weekday_mon0(ts)
    sh, ch = cyclic(hour.cast("double"), 24.0)
    sd, cd = cyclic(dow.cast("double"), 7.0)
    return [
        hour.cast("int").alias("pickup_hour"),
        dow.cast("int").alias("pickup_dayofweek"),
        F.dayofmonth(ts).cast("int").alias("pickup_day"),
        sh.alias("sin_hour"), ch.alias("cos_hour"),
        sd.alias("sin_dayofweek"), cd.alias("cos_dayofweek"),
        (dow >= 5).cast("int").alias("is_weekend"),
        is_rush_hour(hour, dow).alias("is_rush_hour"),
        is_holiday(ts, holidays).alias("is_holiday"),
    ]


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes at microsecond precision (may be negative)."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(6.0e7)
