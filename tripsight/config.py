"""Contract lists, thresholds and windows.

Everything in the block marked FIXED VALUES must equal the values the
reference pipeline uses, otherwise cleaning counts, features and metrics
drift. The run windows (month, split boundary, holiday) are parameters:
the defaults point at the synthetic trip month of the test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference pipeline)
# ---------------------------------------------------------------------------
ALLOWED_FEATURES = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "RatecodeID",
    "trip_distance",
    "VendorID",
)
TARGETS = ("fare_amount", "duration_minutes")
BANNED_COLUMNS = (
    "tpep_dropoff_datetime",
    "total_amount",
    "tip_amount",
    "tolls_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "payment_type",
    "store_and_fwd_flag",
)
MIN_FARE, MAX_FARE = 2.50, 500.0
MIN_DURATION, MAX_DURATION = 0.5, 360.0
MIN_DISTANCE, MAX_DISTANCE = 0.01, 150.0
MIN_PASSENGERS, MAX_PASSENGERS = 1, 9
VALID_RATECODES = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)
MIN_LOCATION_ID, MAX_LOCATION_ID = 1, 265
EARTH_RADIUS_MILES = 3958.8
MILES_PER_DEGREE = 69.0
MAX_HAVERSINE_RATIO = 10.0
EPSILON_DISTANCE = 0.001
JFK_ZONE, NEWARK_ZONE = 132, 1
JFK_RATECODE, NEWARK_RATECODE = 2, 3
AM_RUSH = (7, 9)
PM_RUSH = (16, 19)
ENCODING_SMOOTHING = 10.0
DEFAULT_VENDOR_ID = 2
FARE_FLOOR, DURATION_FLOOR = 2.50, 0.5
SEED = 42
# rule keys of the sequential cleaning, in rule order
CLEANING_RULES = (
    "out_of_bound_timestamps",
    "invalid_durations",
    "invalid_fares",
    "invalid_trip_distances",
    "invalid_passenger_counts",
    "invalid_ratecodes",
    "invalid_location_ids",
)
# request validation (serving schema)
REQUEST_FIELDS = (
    "PULocationID",
    "DOLocationID",
    "tpep_pickup_datetime",
    "passenger_count",
    "RatecodeID",
    "trip_distance",
)
REQUEST_RATECODE_RANGE = (1, 6)
REQUEST_MAX_DISTANCE = 150.0
# rate-code names of the notebook profile
RATECODE_NAMES = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated",
    6: "Group ride",
    99: "Undocumented (99)",
}
# zone-pair distance estimate of the prediction form
ESTIMATE_MIN_MILES, ESTIMATE_MAX_MILES, ESTIMATE_DEFAULT_MILES = 0.1, 150.0, 3.0
# latency budget of the load report (script values)
LATENCY_BUDGET_MS = {"cold_start_ms": 50.0, "p50_ms": 5.0, "p95_ms": 15.0, "p99_ms": 30.0}
# notebook outlier rules: thresholds
EDA_MAX_DURATION, EDA_MAX_FARE, EDA_MAX_DISTANCE, EDA_MAX_PASSENGERS = 360.0, 500.0, 100.0, 6
# loose sanity window of the slide figures
SANITY_FARE, SANITY_DISTANCE, SANITY_DURATION = (2.5, 250.0), (0.1, 100.0), (1.0, 360.0)
# display window before histograms
DISPLAY_FARE, DISPLAY_DURATION = (0.01, 100.0), (0.5, 120.0)
# distance buckets (right-closed), labels as printed
DISTANCE_BINS = ((0.0, 2.0, "Short (<2 mi)"), (2.0, 10.0, "Medium (2-10 mi)"), (10.0, 1000.0, "Long (>10 mi)"))
# importance review threshold
IMPORTANCE_FLAG = 0.65
# prediction-time parity tolerances
PARITY_TOLERANCE = {"fare": 0.05, "duration": 0.1}
# ---------------------------------------------------------------------------

FEATURE_ORDER = (
    "PULocationID", "DOLocationID", "passenger_count", "RatecodeID", "trip_distance", "VendorID",
    "pickup_hour", "pickup_dayofweek", "pickup_day", "sin_hour", "cos_hour",
    "sin_dayofweek", "cos_dayofweek", "is_weekend", "is_rush_hour", "is_holiday",
    "pu_lat", "pu_lon", "do_lat", "do_lon",
    "haversine_distance", "manhattan_distance", "haversine_ratio", "is_same_zone", "is_jfk", "is_newark",
    "PULocationID_target_enc", "DOLocationID_target_enc", "RatecodeID_target_enc",
)
ENCODED_COLUMNS = ("PULocationID", "DOLocationID", "RatecodeID")


@dataclass(frozen=True)
class RunConfig:
    """Windows of one run. Defaults: the month of the synthetic trip table."""

    month_start: str = "2024-01-01 00:00:00"
    month_end: str = "2024-01-30 00:00:00"   # half-open
    split_at: str = "2024-01-22 00:00:00"
    holidays: tuple = ((1, 15),)              # (month, day)
    smoothing: float = ENCODING_SMOOTHING
    seed: int = SEED
    model_version: str = "tripsight-0.1.0"
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "RunConfig":
        return replace(self, **kw)


DEFAULT = RunConfig()
