"""Typed literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_ntz(s: str) -> Column:
    """A TIMESTAMP_NTZ literal (no session-zone shift)."""
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


EPOCH = "1970-01-01 00:00:00"


def ntz_to_instant(c: Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ read as UTC -> TIMESTAMP, whatever the session time zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", ts_ntz(EPOCH), c))


def instant_to_ntz(c: Column) -> Column:
    """TIMESTAMP -> its UTC wall clock as TIMESTAMP_NTZ (inverse of ``ntz_to_instant``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), ts_ntz(EPOCH))
