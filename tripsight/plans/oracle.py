"""Oracle SQL (DuckDB dialect) per named query."""

from __future__ import annotations

from .oracle_base import MONTH_END, MONTH_START, SPLIT_AT, gmean, with_ctes  # noqa: F401

SQL: dict[str, str] = {}


def sql(name: str, body: str, *ctes: str) -> None:
    SQL[name] = with_ctes(body, *ctes)


sql("cleaning_cost", """
, counts as (
  select count(*) as n, count(*) filter (where rule_no = 0) as kept_n,
         count(*) filter (where rule_no = 1) as c1, count(*) filter (where rule_no = 2) as c2,
         count(*) filter (where rule_no = 3) as c3, count(*) filter (where rule_no = 4) as c4,
         count(*) filter (where rule_no = 5) as c5, count(*) filter (where rule_no = 6) as c6,
         count(*) filter (where rule_no = 7) as c7
  from ruled)
select stat_order, stat, round(value, 6) as value from (
  select 1::bigint as stat_order, 'out_of_bound_timestamps' as stat, c1::double as value from counts union all
  select 2, 'invalid_durations', c2 from counts union all
  select 3, 'invalid_fares', c3 from counts union all
  select 4, 'invalid_trip_distances', c4 from counts union all
  select 5, 'invalid_passenger_counts', c5 from counts union all
  select 6, 'invalid_ratecodes', c6 from counts union all
  select 7, 'invalid_location_ids', c7 from counts union all
  select 8, 'total_initial_rows', n from counts union all
  select 9, 'total_final_rows', kept_n from counts union all
  select 10, 'total_dropped_rows', n - kept_n from counts union all
  select 11, 'retention_rate_pct', case when n = 0 then null else kept_n * 100.0e0 / n end from counts)
""", "ruled")

RND = "round({0}, 6)"

sql("trips_scan", """
select trip_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
       round(trip_distance, 6) as trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID,
       payment_type, round(fare_amount, 6) as fare_amount, round(tip_amount, 6) as tip_amount
from raw""", "raw")

sql("trip_duration", """
select trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, round(duration_minutes, 6) as duration_minutes
from tr""", "tr")

sql("clean_trips", """
select tpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, RatecodeID,
       round(trip_distance, 6) as trip_distance, VendorID, round(fare_amount, 6) as fare_amount,
       round(duration_minutes, 6) as duration_minutes, trip_id
from kept""", "kept")

sql("leakage_safe_projection", """
select tpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, RatecodeID,
       round(trip_distance, 6) as trip_distance, VendorID, round(fare_amount, 6) as fare_amount,
       round(duration_minutes, 6) as duration_minutes
from tr""", "tr")

sql("feature_contract_audit", """
, cols(position, column_name, role, usable) as (values
  (1::bigint, 'trip_id', 'other', false), (2, 'VendorID', 'allowed', true),
  (3, 'tpep_pickup_datetime', 'allowed', true), (4, 'tpep_dropoff_datetime', 'banned', false),
  (5, 'passenger_count', 'allowed', true), (6, 'trip_distance', 'allowed', true),
  (7, 'RatecodeID', 'allowed', true), (8, 'store_and_fwd_flag', 'banned', false),
  (9, 'PULocationID', 'allowed', true), (10, 'DOLocationID', 'allowed', true),
  (11, 'payment_type', 'banned', false), (12, 'fare_amount', 'target', false),
  (13, 'tip_amount', 'banned', false), (14, 'duration_minutes', 'target', false)),
cnt as (select count(trip_id) a1, count(VendorID) a2, count(tpep_pickup_datetime) a3,
  count(tpep_dropoff_datetime) a4, count(passenger_count) a5, count(trip_distance) a6, count(RatecodeID) a7,
  count(store_and_fwd_flag) a8, count(PULocationID) a9, count(DOLocationID) a10, count(payment_type) a11,
  count(fare_amount) a12, count(tip_amount) a13, count(duration_minutes) a14 from tr)
select c.position, c.column_name, c.role, c.usable,
  case c.position when 1 then a1 when 2 then a2 when 3 then a3 when 4 then a4 when 5 then a5 when 6 then a6
    when 7 then a7 when 8 then a8 when 9 then a9 when 10 then a10 when 11 then a11 when 12 then a12
    when 13 then a13 else a14 end as non_null_rows
from cols c, cnt""", "tr")

sql("outlier_rules_union", f"""
, flags as (
  select coalesce(duration_minutes <= 0, false) f1, coalesce(duration_minutes > 360, false) f2,
         coalesce(fare_amount <= 0, false) f3, coalesce(fare_amount > 500, false) f4,
         coalesce(trip_distance = 0, false) f5, coalesce(trip_distance > 100, false) f6,
         coalesce(passenger_count = 0, false) f7, coalesce(passenger_count > 6, false) f8,
         not coalesce(tpep_pickup_datetime between timestamp '{MONTH_START}' and timestamp '{MONTH_END}', false) f9
  from tr),
u as (
  select 1::bigint as rule_order, 'duration <= 0' as rule, f1 as hit from flags union all
  select 2, 'duration > 360 min', f2 from flags union all
  select 3, 'fare <= 0', f3 from flags union all
  select 4, 'fare > 500', f4 from flags union all
  select 5, 'distance == 0', f5 from flags union all
  select 6, 'distance > 100 mi', f6 from flags union all
  select 7, 'passenger_count == 0', f7 from flags union all
  select 8, 'passenger_count > 6', f8 from flags union all
  select 9, 'pickup outside month', f9 from flags union all
  select 10, 'UNION (any rule)', f1 or f2 or f3 or f4 or f5 or f6 or f7 or f8 or f9 from flags)
select rule_order, rule, count(*) filter (where hit) as rows,
       round(count(*) filter (where hit) * 100.0e0 / count(*), 6) as pct
from u group by rule_order, rule""", "tr")

KEPT_COLS = """tpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, RatecodeID,
       round(trip_distance, 6) as trip_distance, VendorID, round(fare_amount, 6) as fare_amount,
       round(duration_minutes, 6) as duration_minutes, trip_id"""

sql("temporal_split", f"select {KEPT_COLS}, split from kept_split", "kept_split")

sql("split_summary", """
select split, count(*) as rows, min(tpep_pickup_datetime) as first_pickup, max(tpep_pickup_datetime) as last_pickup,
       round(count(*) * 100.0e0 / sum(count(*)) over (), 6) as share_pct
from kept_split group by split""", "kept_split")

sql("split_overlap_audit", """
, a as (select max(tpep_pickup_datetime) as train_last_pickup from kept_split where split = 'train'),
b as (select min(tpep_pickup_datetime) as test_first_pickup from kept_split where split = 'test')
select train_last_pickup, test_first_pickup, coalesce(train_last_pickup >= test_first_pickup, false) as overlap
from a, b""", "kept_split")

sql("clean_and_split", f"select {KEPT_COLS}, split from kept_split", "kept_split")

sql("sanity_window_corr", f"""
, d as (select *, coalesce(fare_amount between 2.5 and 250.0 and trip_distance between 0.1 and 100.0
                           and duration_minutes between 1.0 and 360.0, false) as m
        from tr where tpep_pickup_datetime >= timestamp '{MONTH_START}' and tpep_pickup_datetime < timestamp '{MONTH_END}')
select round(corr(trip_distance, fare_amount) filter (where trip_distance is not null and fare_amount is not null), 6)
         as corr_distance_fare_raw,
       round(corr(trip_distance, fare_amount) filter (where m), 6) as corr_distance_fare_sane,
       round(corr(passenger_count, fare_amount) filter (where m and passenger_count is not null), 6)
         as corr_passenger_fare_sane,
       count(*) as rows, count(*) filter (where m) as sane_rows,
       round(count(*) filter (where m) * 100.0e0 / count(*), 6) as sane_pct
from d""", "tr")

sql("out_of_window_by_period", f"""
select year(tpep_pickup_datetime)::integer as year, count(*) as rows, min(tpep_pickup_datetime) as first_pickup,
       max(tpep_pickup_datetime) as last_pickup
from tr where not coalesce(tpep_pickup_datetime between timestamp '{MONTH_START}' and timestamp '{MONTH_END}', false)
group by 1""", "tr")

from .oracle_base import register  # noqa: E402

register("req", """req as (
  select trip_id as request_id, PULocationID,
    case when trip_id % 53 = 0 then 0 else DOLocationID end as DOLocationID,
    case when trip_id % 97 = 0 then 'not-a-date' else strftime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S') end
      as tpep_pickup_datetime,
    cast(coalesce(passenger_count, 0.0) as bigint) as passenger_count,
    cast(coalesce(RatecodeID, 99.0) as bigint) as RatecodeID,
    trip_distance, VendorID
  from raw)""", ["raw"])

register("req_checked", """req_checked as (
  select *, try_strptime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S') as pickup_ts,
    list_filter([
      case when not coalesce(PULocationID between 1 and 265, false) then 'PULocationID' end,
      case when not coalesce(DOLocationID between 1 and 265, false) then 'DOLocationID' end,
      case when try_strptime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S') is null then 'tpep_pickup_datetime' end,
      case when not coalesce(passenger_count between 1 and 9, false) then 'passenger_count' end,
      case when not coalesce(RatecodeID between 1 and 6, false) then 'RatecodeID' end,
      case when not coalesce(trip_distance > 0 and trip_distance <= 150.0, false) then 'trip_distance' end
    ], lambda x: x is not null) as failed
  from req)""", ["req"])

sql("request_validation", """
select request_id, array_to_string(failed, ',') as failed_fields, cast(len(failed) as bigint) as n_failed,
       len(failed) = 0 as valid, pickup_ts
from req_checked""", "req_checked")

SQL["row_count_audit"] = ("""
select table_name, rows, case when table_name = 'events' then 1000 else 1 end::bigint as min_rows,
       rows >= case when table_name = 'events' then 1000 else 1 end as ok
from (
  select 'region' as table_name, count(*) as rows from region union all
  select 'nation', count(*) from nation union all select 'customer', count(*) from customer union all
  select 'supplier', count(*) from supplier union all select 'part', count(*) from part union all
  select 'orders', count(*) from orders union all select 'lineitem', count(*) from lineitem union all
  select 'events', count(*) from events union all select 'documents', count(*) from documents union all
  select 'embeddings', count(*) from embeddings union all select 'pages', count(*) from pages union all
  select 'benchmark', count(*) from benchmark union all select 'labels', count(*) from labels union all
  select 'conversations', count(*) from conversations) t""")

# --- features -----------------------------------------------------------------------

HAV = """(2.0e0 * 3958.8e0 * asin(sqrt(least(greatest(
   pow(sin(radians({b}.latitude - {a}.latitude) / 2.0e0), 2)
   + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2.0e0), 2),
   0.0e0), 1.0e0))))"""
MAN = """(abs({b}.latitude - {a}.latitude) * 69.0e0
   + abs({b}.longitude - {a}.longitude) * 69.0e0 * cos(radians(({a}.latitude + {b}.latitude) / 2.0e0)))"""

sql("temporal_parts", """
select trip_id, hour(tpep_pickup_datetime)::integer as pickup_hour,
       (isodow(tpep_pickup_datetime) - 1)::integer as pickup_dayofweek,
       day(tpep_pickup_datetime)::integer as pickup_day
from raw""", "raw")

sql("temporal_cyclic", """
select trip_id,
  round(sin(2.0e0 * pi() * hour(tpep_pickup_datetime) / 24.0e0), 6) as sin_hour,
  round(cos(2.0e0 * pi() * hour(tpep_pickup_datetime) / 24.0e0), 6) as cos_hour,
  round(sin(2.0e0 * pi() * (isodow(tpep_pickup_datetime) - 1) / 7.0e0), 6) as sin_dayofweek,
  round(cos(2.0e0 * pi() * (isodow(tpep_pickup_datetime) - 1) / 7.0e0), 6) as cos_dayofweek
from raw""", "raw")

sql("temporal_flags", """
select trip_id,
  (isodow(tpep_pickup_datetime) in (6, 7))::integer as is_weekend,
  (isodow(tpep_pickup_datetime) <= 5 and (hour(tpep_pickup_datetime) between 7 and 9
     or hour(tpep_pickup_datetime) between 16 and 19))::integer as is_rush_hour,
  (month(tpep_pickup_datetime) = 1 and day(tpep_pickup_datetime) = 15)::integer as is_holiday
from raw""", "raw")

sql("centroid_lookup", """
select r.trip_id, r.PULocationID, r.DOLocationID, round(p.latitude, 6) as pu_lat, round(p.longitude, 6) as pu_lon,
       round(d.latitude, 6) as do_lat, round(d.longitude, 6) as do_lon
from raw r left join zn p on p.LocationID = r.PULocationID left join zn d on d.LocationID = r.DOLocationID""",
    "raw", "zn")

sql("zone_haversine", f"""
select r.trip_id, round({HAV.format(a='p', b='d')}, 6) as haversine_distance
from raw r left join zn p on p.LocationID = r.PULocationID left join zn d on d.LocationID = r.DOLocationID""",
    "raw", "zn")

sql("zone_manhattan", f"""
select r.trip_id, round({MAN.format(a='p', b='d')}, 6) as manhattan_distance
from raw r left join zn p on p.LocationID = r.PULocationID left join zn d on d.LocationID = r.DOLocationID""",
    "raw", "zn")

register("spat", f"""spat as (
  select k.*, p.latitude as pu_lat, p.longitude as pu_lon, d.latitude as do_lat, d.longitude as do_lon,
    coalesce({HAV.format(a='p', b='d')}, 0.0e0) as haversine_distance,
    coalesce({MAN.format(a='p', b='d')}, 0.0e0) as manhattan_distance,
    (PULocationID = DOLocationID)::integer as is_same_zone,
    coalesce(RatecodeID = 2 or PULocationID = 132 or DOLocationID = 132, false)::integer as is_jfk,
    coalesce(RatecodeID = 3 or PULocationID = 1 or DOLocationID = 1, false)::integer as is_newark
  from kept_split k left join zn p on p.LocationID = k.PULocationID left join zn d on d.LocationID = k.DOLocationID)""",
    ["kept_split", "zn"])

sql("spatial_features", """
select trip_id, round(haversine_distance, 6) as haversine_distance, round(manhattan_distance, 6) as manhattan_distance,
       round(least(haversine_distance / (trip_distance + 0.001e0), 10.0e0), 6) as haversine_ratio,
       is_same_zone, is_jfk, is_newark
from spat""", "spat")

# smoothed fare encoding fitted on the train split
FM = gmean("fare_amount")
register("enc", f"""enc as (
  select 'PULocationID' as enc_column, cast(PULocationID as double) as category, count(*) as n,
         {FM} as cat_mean from kept_split where split = 'train' group by 2
  union all
  select 'DOLocationID', cast(DOLocationID as double), count(*), {FM}
  from kept_split where split = 'train' group by 2
  union all
  select 'RatecodeID', RatecodeID, count(*), {FM} from kept_split where split = 'train' group by 2)""",
    ["kept_split"])
register("gm", f"""gm as (select {FM} as g from kept_split where split = 'train')""", ["kept_split"])
register("encv", """encv as (
  select enc.*, (n * cat_mean + 10.0e0 * g) / (n + 10.0e0) as encoded from enc, gm)""", ["enc", "gm"])

sql("target_encode_fit", """
select enc_column, round(category, 6) as category, n, round(cat_mean, 6) as cat_mean, round(encoded, 6) as encoded
from encv""", "encv")

sql("target_encode_apply", """
select k.trip_id,
  round(coalesce(a.encoded, gm.g), 6) as PULocationID_target_enc,
  round(coalesce(b.encoded, gm.g), 6) as DOLocationID_target_enc,
  round(coalesce(c.encoded, gm.g), 6) as RatecodeID_target_enc
from kept_split k cross join gm
left join encv a on a.enc_column = 'PULocationID' and a.category = k.PULocationID
left join encv b on b.enc_column = 'DOLocationID' and b.category = k.DOLocationID
left join encv c on c.enc_column = 'RatecodeID' and c.category = k.RatecodeID
where k.split = 'test'""", "kept_split", "encv", "gm")

FEATURES_SELECT = """
  s.PULocationID, s.DOLocationID, round(s.passenger_count, 6) as passenger_count,
  round(s.RatecodeID, 6) as RatecodeID, round(s.trip_distance, 6) as trip_distance, s.VendorID,
  hour(s.tpep_pickup_datetime)::integer as pickup_hour,
  (isodow(s.tpep_pickup_datetime) - 1)::integer as pickup_dayofweek,
  day(s.tpep_pickup_datetime)::integer as pickup_day,
  round(sin(2.0e0 * pi() * hour(s.tpep_pickup_datetime) / 24.0e0), 6) as sin_hour,
  round(cos(2.0e0 * pi() * hour(s.tpep_pickup_datetime) / 24.0e0), 6) as cos_hour,
  round(sin(2.0e0 * pi() * (isodow(s.tpep_pickup_datetime) - 1) / 7.0e0), 6) as sin_dayofweek,
  round(cos(2.0e0 * pi() * (isodow(s.tpep_pickup_datetime) - 1) / 7.0e0), 6) as cos_dayofweek,
  (isodow(s.tpep_pickup_datetime) >= 6)::integer as is_weekend,
  (isodow(s.tpep_pickup_datetime) < 6 and (hour(s.tpep_pickup_datetime) between 7 and 9
     or hour(s.tpep_pickup_datetime) between 16 and 19))::integer as is_rush_hour,
  (month(s.tpep_pickup_datetime) = 1 and day(s.tpep_pickup_datetime) = 15)::integer as is_holiday,
  round(s.pu_lat, 6) as pu_lat, round(s.pu_lon, 6) as pu_lon, round(s.do_lat, 6) as do_lat,
  round(s.do_lon, 6) as do_lon,
  round(s.haversine_distance, 6) as haversine_distance, round(s.manhattan_distance, 6) as manhattan_distance,
  round(least(s.haversine_distance / (s.trip_distance + 0.001e0), 10.0e0), 6) as haversine_ratio,
  s.is_same_zone, s.is_jfk, s.is_newark,
  round(coalesce(a.encoded, gm.g), 6) as PULocationID_target_enc,
  round(coalesce(b.encoded, gm.g), 6) as DOLocationID_target_enc,
  round(coalesce(c.encoded, gm.g), 6) as RatecodeID_target_enc"""

ENC_JOINS = """
cross join gm
left join encv a on a.enc_column = 'PULocationID' and a.category = s.PULocationID
left join encv b on b.enc_column = 'DOLocationID' and b.category = s.DOLocationID
left join encv c on c.enc_column = 'RatecodeID' and c.category = s.RatecodeID"""

sql("feature_frame", f"select s.trip_id, s.split, {FEATURES_SELECT} from spat s {ENC_JOINS}",
    "spat", "encv", "gm")

register("req_spat", f"""req_spat as (
  select q.request_id, q.PULocationID, q.DOLocationID, cast(q.passenger_count as double) as passenger_count,
    cast(q.RatecodeID as double) as RatecodeID, q.trip_distance, 2::bigint as VendorID,
    cast(q.pickup_ts as timestamp) as tpep_pickup_datetime,
    p.latitude as pu_lat, p.longitude as pu_lon, d.latitude as do_lat, d.longitude as do_lon,
    coalesce({HAV.format(a='p', b='d')}, 0.0e0) as haversine_distance,
    coalesce({MAN.format(a='p', b='d')}, 0.0e0) as manhattan_distance,
    (q.PULocationID = q.DOLocationID)::integer as is_same_zone,
    coalesce(q.RatecodeID = 2 or q.PULocationID = 132 or q.DOLocationID = 132, false)::integer as is_jfk,
    coalesce(q.RatecodeID = 3 or q.PULocationID = 1 or q.DOLocationID = 1, false)::integer as is_newark
  from req_checked q left join zn p on p.LocationID = q.PULocationID left join zn d on d.LocationID = q.DOLocationID
  where len(q.failed) = 0)""", ["req_checked", "zn"])

sql("serving_feature_frame", f"select s.request_id, {FEATURES_SELECT} from req_spat s {ENC_JOINS}",
    "req_spat", "encv", "gm")

sql("implied_speed", """
select trip_id, round(case when duration_minutes = 0 then null
                           else trip_distance / (duration_minutes / 60.0e0) end, 6) as speed_mph
from tr""", "tr")

sql("inferred_ratecode", """
select trip_id, cast(RatecodeID as bigint) as RatecodeID,
  case when PULocationID = 132 or DOLocationID = 132 then 2 when PULocationID = 1 or DOLocationID = 1 then 3
       else 1 end::bigint as inferred_ratecode,
  (case when PULocationID = 132 or DOLocationID = 132 then 2 when PULocationID = 1 or DOLocationID = 1 then 3
       else 1 end) = RatecodeID as matches
from kept""", "kept")

sql("estimated_trip_distance", f"""
select r.trip_id, round(r.trip_distance, 6) as trip_distance,
  round(coalesce(round_even(least(greatest({HAV.format(a='p', b='d')}, 0.1e0), 150.0e0), 2), 3.0e0), 6)
    as estimated_distance
from tr r left join zn p on p.LocationID = r.PULocationID left join zn d on d.LocationID = r.DOLocationID""",
    "tr", "zn")

sql("zone_labels", """
select z.LocationID, coalesce(z.Zone, 'Unknown') || ' (' || coalesce(z.Borough, 'Unknown') || ')' as label,
       coalesce(c.pickups, 0)::bigint as pickups
from zn z left join (select PULocationID, count(*) as pickups from raw group by 1) c on c.PULocationID = z.LocationID""",
    "zn", "raw")

# --- profiles -------------------------------------------------------------------------

from .oracle_base import qsql  # noqa: E402

MIN = "6.0e7"

sql("column_profile", """
, a as (select count(*) as n,
  count(VendorID) c1, count(distinct VendorID) d1, count(tpep_pickup_datetime) c2, count(distinct tpep_pickup_datetime) d2,
  count(tpep_dropoff_datetime) c3, count(distinct tpep_dropoff_datetime) d3,
  count(passenger_count) c4, count(distinct passenger_count) d4, count(trip_distance) c5, count(distinct trip_distance) d5,
  count(RatecodeID) c6, count(distinct RatecodeID) d6, count(store_and_fwd_flag) c7, count(distinct store_and_fwd_flag) d7,
  count(PULocationID) c8, count(distinct PULocationID) d8, count(DOLocationID) c9, count(distinct DOLocationID) d9,
  count(payment_type) c10, count(distinct payment_type) d10, count(fare_amount) c11, count(distinct fare_amount) d11,
  count(tip_amount) c12, count(distinct tip_amount) d12 from raw),
l as (
  select 1::bigint as position, 'VendorID' as column_name, 'bigint' as dtype, n - c1 as nulls, d1 as distinct_values, n from a union all
  select 2, 'tpep_pickup_datetime', 'timestamp_ntz', n - c2, d2, n from a union all
  select 3, 'tpep_dropoff_datetime', 'timestamp_ntz', n - c3, d3, n from a union all
  select 4, 'passenger_count', 'double', n - c4, d4, n from a union all
  select 5, 'trip_distance', 'double', n - c5, d5, n from a union all
  select 6, 'RatecodeID', 'double', n - c6, d6, n from a union all
  select 7, 'store_and_fwd_flag', 'string', n - c7, d7, n from a union all
  select 8, 'PULocationID', 'bigint', n - c8, d8, n from a union all
  select 9, 'DOLocationID', 'bigint', n - c9, d9, n from a union all
  select 10, 'payment_type', 'bigint', n - c10, d10, n from a union all
  select 11, 'fare_amount', 'double', n - c11, d11, n from a union all
  select 12, 'tip_amount', 'double', n - c12, d12, n from a)
select position, column_name, dtype, nulls, round(nulls * 100.0e0 / n, 6) as null_pct, distinct_values from l""",
    "raw")

sql("null_block_audit", """
select count(*) filter (where passenger_count is null) as block_rows,
  round(count(*) filter (where passenger_count is null) * 100.0e0 / count(*), 6) as block_pct,
  coalesce(bool_and((passenger_count is null) = (RatecodeID is null)), true) as same_mask_RatecodeID,
  coalesce(bool_and((passenger_count is null) = (store_and_fwd_flag is null)), true) as same_mask_store_and_fwd_flag,
  coalesce(bool_and(payment_type = 0) filter (where passenger_count is null), true) as block_all_payment_0,
  count(*) filter (where payment_type = 0 and passenger_count is not null) as payment_0_outside_block
from raw""", "raw")

sql("null_block_vendors", """
select VendorID, count(*) as rows from raw where passenger_count is null group by VendorID""", "raw")

sql("duplicate_rate", """
, g as (select count(*) as c from raw group by VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
        trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, tip_amount)
select coalesce(sum(c), 0)::bigint as rows, coalesce(sum(c - 1), 0)::bigint as duplicate_rows,
       round(sum(c - 1) * 100.0e0 / sum(c), 6) as duplicate_pct from g""", "raw")

_DESC_Q = qsql("(select 'fare_amount' as column_name, fare_amount as x from tr union all "
               "select 'duration_minutes', duration_minutes from tr union all "
               "select 'trip_distance', trip_distance from tr)", "x",
               [0.01, 0.25, 0.5, 0.75, 0.95, 0.99], ["column_name"])
sql("target_describe", f"""
, q as {_DESC_Q},
qw as (select column_name, max(q) filter (where p = 0.01) as p01, max(q) filter (where p = 0.25) as p25,
          max(q) filter (where p = 0.5) as p50, max(q) filter (where p = 0.75) as p75,
          max(q) filter (where p = 0.95) as p95, max(q) filter (where p = 0.99) as p99 from q group by 1),
b as (
  select 'fare_amount' as column_name, count(fare_amount) as count, {gmean('fare_amount')} as mean,
         stddev_samp(fare_amount) as std, min(fare_amount) as min, max(fare_amount) as max from tr union all
  select 'duration_minutes', count(duration_minutes), {gmean('duration_minutes', MIN)}, stddev_samp(duration_minutes),
         min(duration_minutes), max(duration_minutes) from tr union all
  select 'trip_distance', count(trip_distance), {gmean('trip_distance')}, stddev_samp(trip_distance),
         min(trip_distance), max(trip_distance) from tr)
select b.column_name, b.count, round(b.mean, 6) as mean, round(b.std, 6) as std, round(b.min, 6) as min,
  round(p01, 6) as p01, round(p25, 6) as p25, round(p50, 6) as p50, round(p75, 6) as p75, round(p95, 6) as p95,
  round(p99, 6) as p99, round(b.max, 6) as max
from b left join qw using (column_name)""", "tr")

sql("log_target_skew", """
select * from (
  select 'fare_amount' as column_name, round(skewness(fare_amount), 6) as raw_skew,
    round(skewness(ln(1 + greatest(fare_amount, 0.0e0))), 6) as log1p_skew,
    round(skewness(ln(1 + fare_amount)) filter (where fare_amount > 0), 6) as log1p_positive_skew from tr
  union all
  select 'duration_minutes', round(skewness(duration_minutes), 6), round(skewness(ln(1 + greatest(duration_minutes, 0.0e0))), 6),
    round(skewness(ln(1 + duration_minutes)) filter (where duration_minutes > 0), 6) from tr
  union all
  select 'trip_distance', round(skewness(trip_distance), 6), round(skewness(ln(1 + greatest(trip_distance, 0.0e0))), 6),
    round(skewness(ln(1 + trip_distance)) filter (where trip_distance > 0), 6) from tr)""", "tr")

sql("profile_by_hour", f"""
, m as (select hr, {gmean('fare_amount')} as mean_fare, {gmean('duration_minutes', MIN)} as mean_duration,
               count(*) as trips from eda group by hr),
med as {qsql('eda', 'speed_mph', [0.5], ['hr'])}
select m.hr::integer as hour, round(mean_fare, 6) as mean_fare, round(mean_duration, 6) as mean_duration,
       round(med.q, 6) as median_speed_mph, trips
from m left join med on med.hr = m.hr""", "eda")

sql("profile_by_weekday", f"""
select dw::integer as dow, round({gmean('fare_amount')}, 6) as mean_fare,
       round({gmean('duration_minutes', MIN)}, 6) as mean_duration
from eda group by dw""", "eda")

sql("profile_by_day", f"""
select dt as date, round({gmean('fare_amount')}, 6) as mean_fare,
       round({gmean('duration_minutes', MIN)}, 6) as mean_duration, count(*) as trips
from eda group by dt""", "eda")

sql("hourly_peak_trough", f"""
, ph as (select hour(tpep_pickup_datetime) as hr, count(*) / 29.0e0 as rate from tr
         where tpep_pickup_datetime >= timestamp '{MONTH_START}' and tpep_pickup_datetime < timestamp '{MONTH_END}'
         group by 1),
pk as (select hr, rate from ph order by rate desc, hr limit 1),
tg as (select hr, rate from ph order by rate asc, hr limit 1)
select pk.hr::integer as peak_hour, round(pk.rate, 6) as peak_per_hour, tg.hr::integer as trough_hour,
       round(tg.rate, 6) as trough_per_hour, round(pk.rate / tg.rate, 6) as peak_trough_ratio,
       round((select sum(rate) from ph), 6) as rides_per_day
from pk, tg""", "tr")

sql("ratecode_profile", f"""
select RatecodeID,
  case cast(RatecodeID as integer) when 1 then 'Standard' when 2 then 'JFK' when 3 then 'Newark'
    when 4 then 'Nassau/Westchester' when 5 then 'Negotiated' when 6 then 'Group ride'
    when 99 then 'Undocumented (99)' else '?' end as name,
  count(*) as trips, round({gmean('fare_amount')}, 6) as mean_fare,
  round({gmean('duration_minutes', MIN)}, 6) as mean_duration, round({gmean('trip_distance')}, 6) as mean_distance
from eda where RatecodeID is not null group by RatecodeID""", "eda")

sql("feature_correlations", """
select * from (
  select 'trip_distance' as feature, round(corr(trip_distance, fare_amount), 6) as corr_fare_amount,
         round(corr(trip_distance, duration_minutes), 6) as corr_duration_minutes from eda union all
  select 'passenger_count', round(corr(passenger_count, fare_amount), 6), round(corr(passenger_count, duration_minutes), 6) from eda union all
  select 'PULocationID', round(corr(PULocationID, fare_amount), 6), round(corr(PULocationID, duration_minutes), 6) from eda union all
  select 'DOLocationID', round(corr(DOLocationID, fare_amount), 6), round(corr(DOLocationID, duration_minutes), 6) from eda union all
  select 'RatecodeID', round(corr(RatecodeID, fare_amount), 6), round(corr(RatecodeID, duration_minutes), 6) from eda union all
  select 'hour', round(corr(hr, fare_amount), 6), round(corr(hr, duration_minutes), 6) from eda union all
  select 'dow', round(corr(dw, fare_amount), 6), round(corr(dw, duration_minutes), 6) from eda)""", "eda")

sql("target_histogram", """
, shown as (select * from tr where coalesce(fare_amount between 0.01 and 100.0 and duration_minutes between 0.5 and 120.0, false)),
l as (select 'fare_amount' as target, 'raw' as scale, fare_amount as x from shown union all
      select 'fare_amount', 'log1p', ln(1 + fare_amount) from shown union all
      select 'duration_minutes', 'raw', duration_minutes from shown union all
      select 'duration_minutes', 'log1p', ln(1 + duration_minutes) from shown),
rg as (select target, scale, min(x) as lo, max(x) as hi from l group by 1, 2),
c as (select l.target, l.scale,
        case when hi = lo then 0 else least(floor((x - lo) * (80.0e0 / (hi - lo))), 79) end::integer as bin,
        count(*) as rows
      from l join rg using (target, scale) group by 1, 2, 3),
d as (select target, scale, lo, hi, unnest(range(0, 80)) as bin from rg)
select d.target, d.scale, d.bin::integer as bin, round(lo + d.bin * ((hi - lo) / 80.0e0), 6) as bin_lo,
       round(lo + (d.bin + 1) * ((hi - lo) / 80.0e0), 6) as bin_hi, coalesce(c.rows, 0)::bigint as rows,
       round(coalesce(c.rows, 0) * 1.0e0 / max(coalesce(c.rows, 0)) over (partition by d.target, d.scale), 6) as share_of_mode
from d left join c on c.target = d.target and c.scale = d.scale and c.bin = d.bin""", "tr")

_HEAD_Q = qsql(f"(select 'fare' as k, fare_amount as v from tr where tpep_pickup_datetime >= timestamp '{MONTH_START}' "
               f"and tpep_pickup_datetime < timestamp '{MONTH_END}' union all "
               f"select 'duration', duration_minutes from tr where tpep_pickup_datetime >= timestamp '{MONTH_START}' "
               f"and tpep_pickup_datetime < timestamp '{MONTH_END}')", "v", [0.5, 0.99, 1.0], ["k"])
sql("target_headline", f"""
, q as {_HEAD_Q}
select round(max(q) filter (where k = 'fare' and p = 0.5), 6) as fare_median,
       round(max(q) filter (where k = 'fare' and p = 0.99), 6) as fare_p99,
       round(max(q) filter (where k = 'fare' and p = 1.0), 6) as fare_max,
       round(max(q) filter (where k = 'duration' and p = 0.5), 6) as duration_median
from q""", "tr")

sql("zone_coverage", """
select (select min(PULocationID) from eda) as pu_min, (select max(PULocationID) from eda) as pu_max,
       (select min(DOLocationID) from eda) as do_min, (select max(DOLocationID) from eda) as do_max,
       (select count(distinct PULocationID) from eda) as pickup_zones_used,
       (select count(*) from zn) as zones_in_lookup, (select count(distinct Borough) from zn) as boroughs""",
    "eda", "zn")

sql("top_pickup_zones", f"""
, g as (select PULocationID, count(*) as trips, {gmean('fare_amount')} as mean_fare from eda group by 1
        order by trips desc, PULocationID limit 10)
select g.PULocationID, g.trips, coalesce(z.Zone, '-') as zone, coalesce(z.Borough, '-') as borough,
       round(g.mean_fare, 6) as mean_fare
from g left join zn z on z.LocationID = g.PULocationID""", "eda", "zn")

# --- evaluation -----------------------------------------------------------------------

register("gm2", f"""gm2 as (select {gmean('fare_amount')} as g_fare, {gmean('duration_minutes', MIN)} as g_dur
  from kept_split where split = 'train')""", ["kept_split"])
register("zmap", f"""zmap as (
  select PULocationID as zone,
    (count(*) * {gmean('fare_amount')} + 10.0e0 * any_value(g_fare)) / (count(*) + 10.0e0) as zp_fare,
    (count(*) * {gmean('duration_minutes', MIN)} + 10.0e0 * any_value(g_dur)) / (count(*) + 10.0e0) as zp_dur
  from kept_split, gm2 where split = 'train' group by PULocationID)""", ["kept_split", "gm2"])
register("zpred", """zpred as (
  select t.*, coalesce(z.zp_fare, gm2.g_fare) as p_fare, coalesce(z.zp_dur, gm2.g_dur) as p_dur
  from kept_split t cross join gm2 left join zmap z on z.zone = t.PULocationID where t.split = 'test')""",
    ["kept_split", "gm2", "zmap"])
register("mpred", """mpred as (
  select t.*, gm2.g_fare as p_fare, gm2.g_dur as p_dur from kept_split t cross join gm2 where t.split = 'test')""",
    ["kept_split", "gm2"])


def _metrics(src: str, model: str, eps: bool = False, rnd: bool = True) -> str:
    def one(target, y, p):
        if eps:
            mape = f"avg(abs({y} - {p}) / greatest(abs({y}), 2.220446049250313e-16)) * 100.0e0"
        else:
            mape = f"coalesce(avg(abs(({y} - {p}) / {y})) filter (where {y} <> 0) * 100.0e0, 0.0e0)"
        r = (lambda x: f"round({x}, 6)") if rnd else (lambda x: x)
        return (f"select '{model}' as model, '{target}' as target, {r(f'avg(abs({y} - {p}))')} as mae, "
                f"{r(f'sqrt(avg(({y} - {p}) * ({y} - {p})))')} as rmse, {r(mape)} as mape_pct, "
                f"{r(f'1.0e0 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))')} as r2, "
                f"count({y}) as rows from {src}")
    return one("fare", "fare_amount", "p_fare") + " union all " + one("duration", "duration_minutes", "p_dur")


sql("mean_baseline_eval", _metrics("mpred", "mean"), "mpred")
sql("regression_metrics", _metrics("zpred", "zone_mean"), "zpred")
sql("regression_metrics_eps", _metrics("zpred", "zone_mean", eps=True), "zpred")

register("sl", """sl as (
  select z.*, hour(z.tpep_pickup_datetime) as pickup_hour, coalesce(zn.Borough, 'Unknown') as pu_borough,
    case when trip_distance > 0 and trip_distance <= 2 then 'Short (<2 mi)'
         when trip_distance > 2 and trip_distance <= 10 then 'Medium (2-10 mi)'
         when trip_distance > 10 and trip_distance <= 1000 then 'Long (>10 mi)' end as distance_bucket,
    fare_amount - p_fare as r_fare, abs(fare_amount - p_fare) as a_fare,
    duration_minutes - p_dur as r_dur, abs(duration_minutes - p_dur) as a_dur
  from zpred z left join zn on zn.LocationID = z.PULocationID)""", ["zpred", "zn"])

SLICE_AGGS = """count(*) as trips, round(avg(a_fare), 6) as fare_mae, round(avg(r_fare), 6) as fare_mean_res,
  round(avg(a_dur), 6) as dur_mae, round(avg(r_dur), 6) as dur_mean_res"""

sql("residuals_by_hour", f"select pickup_hour::integer as pickup_hour, {SLICE_AGGS} from sl group by 1", "sl")
sql("residuals_by_borough", f"select pu_borough, {SLICE_AGGS} from sl group by 1", "sl")
sql("residuals_by_ratecode", f"select RatecodeID, {SLICE_AGGS} from sl where RatecodeID is not null group by 1",
    "sl")
sql("residuals_by_distance", """
, b(bucket_order, distance_bucket) as (values (0, 'Short (<2 mi)'), (1, 'Medium (2-10 mi)'), (2, 'Long (>10 mi)')),
a as (select distance_bucket, count(*) as trips, avg(a_fare) as fare_mae, avg(a_dur) as dur_mae from sl
      where distance_bucket is not null group by 1)
select b.bucket_order::integer as bucket_order, b.distance_bucket, coalesce(a.trips, 0)::bigint as trips,
       round(a.fare_mae, 6) as fare_mae, round(a.dur_mae, 6) as dur_mae
from b left join a using (distance_bucket)""", "sl")

sql("residual_slices", f"""
, s as (
  select 'hour' as slice, cast(pickup_hour as varchar) as slice_key, {SLICE_AGGS} from sl group by 2
  union all select 'borough', pu_borough, {SLICE_AGGS} from sl group by 2
  union all select 'distance_bucket', distance_bucket, {SLICE_AGGS} from sl where distance_bucket is not null group by 2
  union all select 'ratecode', cast(RatecodeID as varchar), {SLICE_AGGS} from sl where RatecodeID is not null group by 2),
b(k) as (values ('Short (<2 mi)'), ('Medium (2-10 mi)'), ('Long (>10 mi)'))
select * from s
union all
select 'distance_bucket', k, 0::bigint, null::double, null::double, null::double, null::double from b
where k not in (select slice_key from s where slice = 'distance_bucket')""", "sl")

sql("time_series_folds", """
, r as (select tpep_pickup_datetime, row_number() over (order by tpep_pickup_datetime, trip_id) - 1 as pos,
               count(*) over () as n from kept_split where split = 'train'),
f as (select *, n // 4 as size, n - 3 * (n // 4) as first_test from r),
g as (select *, case when pos >= first_test then (pos - first_test) // size end as fold from f)
select fold::integer as fold, min(pos) as train_rows, count(*) as test_rows, min(tpep_pickup_datetime) as test_first_pickup,
       max(tpep_pickup_datetime) as test_last_pickup
from g where fold is not null group by fold""", "kept_split")

sql("fold_sizes", """
, r as (select tpep_pickup_datetime, trip_id, row_number() over (order by tpep_pickup_datetime, trip_id) - 1 as pos,
               count(*) over () as n from kept_split where split = 'train'),
e as (select f.fold, n - (5 - f.fold) * (n // 6) as train_rows, n // 6 as test_rows
      from range(0, 5) f(fold) cross join (select max(n) as n from r) where n // 6 > 0)
select e.fold::integer as fold, e.train_rows, e.test_rows, a.tpep_pickup_datetime as first_pickup, a.trip_id as first_id,
       b.tpep_pickup_datetime as last_pickup, b.trip_id as last_id
from e join r a on a.pos = e.train_rows join r b on b.pos = e.train_rows + e.test_rows - 1""", "kept_split")

_BOARD = "(" + _metrics("mpred", "mean") + " union all " + _metrics("zpred", "zone_mean") + ")"
sql("model_leaderboard", f"""
select *, (rank() over (partition by target order by mae))::integer as rank from {_BOARD}""", "mpred", "zpred")

_BOARD_RAW = "(" + _metrics("mpred", "mean", rnd=False) + " union all " + _metrics("zpred", "zone_mean", rnd=False) + ")"
sql("model_winner", f"""
, m as {_BOARD_RAW},
r as (select target, model, mae, row_number() over (partition by target order by mae, model) as rn,
             lead(mae) over (partition by target order by mae, model) as nxt from m)
select target, model, round(mae, 6) as best_mae, round(nxt, 6) as runner_up_mae,
       round((nxt - mae) * 100.0e0 / nxt, 6) as improvement_pct
from r where rn = 1""", "mpred", "zpred")

sql("score_trips", """
select q.request_id, round(greatest(coalesce(z.zp_fare, gm2.g_fare), 2.5e0), 6) as predicted_fare,
       round(greatest(coalesce(z.zp_dur, gm2.g_dur), 0.5e0), 6) as predicted_duration_minutes,
       'tripsight-0.1.0' as model_version
from req_checked q cross join gm2 left join zmap z on z.zone = q.PULocationID where len(q.failed) = 0""",
    "req_checked", "gm2", "zmap")

SQL["stream_score_zone_mean"] = SQL["score_trips"]

# --- latency --------------------------------------------------------------------------

register("rl", """rl as (
  select case when user_id % 2 = 0 then 'unoptimised' else 'optimised' end as scenario, event_id as request_id,
         ts, event_type <> 'error' as ok, value as latency_ms, event_type as component from events)""")

_LAT_Q = qsql("(select * from rl where ok)", "latency_ms", [0.5, 0.9, 0.95, 0.99], ["scenario"])
register("lrep", f"""lrep as (
  with b as (select scenario, count(*) as total_requests, count(*) filter (where ok) as success,
                    count(*) filter (where not ok) as errors,
                    date_diff('microsecond', min(ts), max(ts)) / 1.0e6 as elapsed_s,
                    arg_min(latency_ms, ts) as cold_start_ms from rl group by 1),
  s as (select scenario, avg(latency_ms) as mean_ms, stddev_pop(latency_ms) as std_ms,
               min(latency_ms) as min_ms, max(latency_ms) as max_ms from rl where ok group by 1),
  q as {_LAT_Q},
  qw as (select scenario, max(q) filter (where p = 0.5) as p50_ms, max(q) filter (where p = 0.9) as p90_ms,
                max(q) filter (where p = 0.95) as p95_ms, max(q) filter (where p = 0.99) as p99_ms from q group by 1)
  select b.scenario, total_requests, success, errors, elapsed_s, success / elapsed_s as throughput_rps,
    cold_start_ms, mean_ms, std_ms, min_ms, p50_ms, p90_ms, p95_ms, p99_ms, max_ms,
    coalesce(cold_start_ms <= 50 and p50_ms <= 5 and p95_ms <= 15 and p99_ms <= 30, false) as sla_passed
  from b left join s using (scenario) left join qw using (scenario))""", ["rl"])

sql("latency_report", """
select scenario, total_requests, success, errors, round(elapsed_s, 6) as elapsed_s,
  round(throughput_rps, 6) as throughput_rps, round(cold_start_ms, 6) as cold_start_ms, round(mean_ms, 6) as mean_ms,
  round(std_ms, 6) as std_ms, round(min_ms, 6) as min_ms, round(p50_ms, 6) as p50_ms, round(p90_ms, 6) as p90_ms,
  round(p95_ms, 6) as p95_ms, round(p99_ms, 6) as p99_ms, round(max_ms, 6) as max_ms, sla_passed from lrep""", "lrep")

def _cmean(c):
    return f"round(avg(latency_ms) filter (where component = '{c}'), 6) as {c}"


sql("latency_components", "select scenario, " + ", ".join(_cmean(c) for c in
                                                          ("view", "click", "purchase", "signup", "error"))
    + ", count(*) filter (where coalesce(component not in ('view', 'click', 'purchase', 'signup', 'error'), true)) as unlisted"
    " from rl group by scenario", "rl")

sql("latency_before_after", """
, p as (select
   max(mean_ms) filter (where scenario = 'unoptimised') as b1, max(mean_ms) filter (where scenario = 'optimised') as a1,
   max(p50_ms) filter (where scenario = 'unoptimised') as b2, max(p50_ms) filter (where scenario = 'optimised') as a2,
   max(p95_ms) filter (where scenario = 'unoptimised') as b3, max(p95_ms) filter (where scenario = 'optimised') as a3,
   max(p99_ms) filter (where scenario = 'unoptimised') as b4, max(p99_ms) filter (where scenario = 'optimised') as a4,
   max(max_ms) filter (where scenario = 'unoptimised') as b5, max(max_ms) filter (where scenario = 'optimised') as a5,
   max(cold_start_ms) filter (where scenario = 'unoptimised') as b6, max(cold_start_ms) filter (where scenario = 'optimised') as a6,
   max(throughput_rps) filter (where scenario = 'unoptimised') as b7, max(throughput_rps) filter (where scenario = 'optimised') as a7
 from lrep),
l as (select 'mean_ms' as metric, b1 as before, a1 as after from p union all select 'p50_ms', b2, a2 from p union all
      select 'p95_ms', b3, a3 from p union all select 'p99_ms', b4, a4 from p union all select 'max_ms', b5, a5 from p
      union all select 'cold_start_ms', b6, a6 from p union all select 'throughput_rps', b7, a7 from p)
select metric, round(before, 6) as before, round(after, 6) as after,
  round(case when metric = 'throughput_rps' then (after - before) * 100.0e0 / before
             else (before - after) * 100.0e0 / before end, 6) as improvement_pct
from l""", "lrep")

# --- zones ----------------------------------------------------------------------------

register("vx", """vx as (
  with b as (select LocationID as zid, longitude as x, latitude as y,
                    0.004e0 + cast(LocationID % 7 as double) * 0.001e0 as w,
                    0.003e0 + cast(LocationID % 3 as double) * 0.001e0 as hh
             from zn where longitude is not null)
  select zid as LocationID, 0::bigint as ring, 0::bigint as seq, x - w as x, y - hh as y from b union all
  select zid, 0, 1, x + w, y - hh from b union all
  select zid, 0, 2, x + w / 2.0e0, y + hh from b union all
  select zid, 0, 3, x - w / 2.0e0, y + hh from b union all
  select zid, 0, 4, x - w, y - hh from b)""", ["zn"])
register("cent", """cent as (
  with o as (select *, min(x) over (partition by LocationID) as ox, min(y) over (partition by LocationID) as oy from vx),
  e as (select LocationID, seq, x, y, ox, oy, x - ox as x0, y - oy as y0,
               lead(x - ox) over (partition by LocationID, ring order by seq) as x1,
               lead(y - oy) over (partition by LocationID, ring order by seq) as y1 from o),
  g as (select LocationID, sum(x0 * y1 - x1 * y0) as c2, sum((x0 + x1) * (x0 * y1 - x1 * y0)) as sx,
               sum((y0 + y1) * (x0 * y1 - x1 * y0)) as sy, max(ox) as ox, max(oy) as oy,
               avg(x) filter (where x1 is not null) as vertex_mean_x, avg(y) filter (where x1 is not null) as vertex_mean_y
        from e group by LocationID)
  select LocationID, ox + sx / (3.0e0 * c2) as longitude, oy + sy / (3.0e0 * c2) as latitude, abs(c2 / 2.0e0) as area,
         vertex_mean_x, vertex_mean_y from g)""", ["vx"])

sql("zone_polygon_centroid", """
select LocationID, round(longitude, 6) as longitude, round(latitude, 6) as latitude, round(area, 6) as area,
       round(vertex_mean_x, 6) as vertex_mean_x, round(vertex_mean_y, 6) as vertex_mean_y
from cent where LocationID in (select PULocationID from raw)""", "cent", "raw")

sql("zone_dimension", """
select z.LocationID, z.Borough, z.Zone, z.service_zone, round(c.longitude, 6) as longitude,
       round(c.latitude, 6) as latitude, coalesce(u.pickups, 0)::bigint as pickups
from zn z left join cent c on c.LocationID = z.LocationID
left join (select PULocationID, count(*) as pickups from raw group by 1) u on u.PULocationID = z.LocationID""",
    "zn", "cent", "raw")

register("lin", """lin as (
  select regr_intercept(fare_amount, trip_distance) as a_fare, regr_slope(fare_amount, trip_distance) as b_fare,
         regr_intercept(duration_minutes, trip_distance) as a_dur, regr_slope(duration_minutes, trip_distance) as b_dur
  from kept_split where split = 'train')""", ["kept_split"])
register("lpred", """lpred as (
  select t.*, a_fare + b_fare * trip_distance as p_fare, a_dur + b_dur * trip_distance as p_dur
  from kept_split t cross join lin where t.split = 'test')""", ["kept_split", "lin"])
sql("linear_single_eval", _metrics("lpred", "linear_distance"), "lpred")

sql("od_fare_grid", f"""
, g as (select 132::bigint as PULocationID, d.LocationID as DOLocationID,
          2::bigint as inferred_ratecode,
          coalesce(round_even(least(greatest({HAV.format(a='p', b='d')}, 0.1e0), 150.0e0), 2), 3.0e0) as est
        from zn d left join zn p on p.LocationID = 132
        where d.longitude is not null and d.latitude is not null)
select PULocationID, DOLocationID, inferred_ratecode, round(est, 6) as estimated_distance,
       round(greatest(a_fare + b_fare * est, 2.5e0), 6) as predicted_fare,
       round(greatest(a_dur + b_dur * est, 0.5e0), 6) as predicted_duration_minutes
from g cross join lin""", "zn", "lin")

# --- second priority ------------------------------------------------------------------

register("panel", f"""panel as (
  with hrs as (select unnest(generate_series(timestamp '{MONTH_START}', timestamp '{MONTH_END}' - interval 1 hour,
                                             interval 1 hour)) as hour_ts),
  c as (select PULocationID as zone, date_trunc('hour', tpep_pickup_datetime) as hour_ts, count(*) as pickups
        from kept group by 1, 2)
  select z.LocationID as zone, h.hour_ts, coalesce(c.pickups, 0)::bigint as pickups
  from zn z cross join hrs h left join c on c.zone = z.LocationID and c.hour_ts = h.hour_ts)""", ["zn", "kept"])

sql("zone_demand", "select zone, hour_ts, pickups from panel", "panel")

sql("demand_naive", f"""
, l as (select *, lag(pickups, 24) over (partition by zone order by hour_ts) as lag_24 from panel)
select count(*) as rows, round(avg(abs(pickups - lag_24)), 6) as mae,
       round(sqrt(avg((pickups - lag_24) * (pickups - lag_24))), 6) as rmse,
       sum(pickups)::bigint as actual_pickups, sum(lag_24)::bigint as forecast_pickups
from l where hour_ts >= timestamp '{SPLIT_AT}' and lag_24 is not null""", "panel")

_LAGS = [f"x{i}" for i in range(1, 6)]


def _residual_steps() -> str:
    """Least squares by orthogonalisation: each step takes one feature, with slopes of the train rows, out of the rest."""
    out = ["""z0 as (select tr, """ + ", ".join(f"{c} - avg({c}) filter (where tr) over () as {c}" for c in ["y", *_LAGS])
           + " from lagged where x3 is not null)"]
    for i, x in enumerate(_LAGS):
        rest = ["y", *_LAGS[i + 1:]]
        out.append(f"s{i} as (select sum({x} * {x}) as d, " + ", ".join(f"sum({c} * {x}) as n_{c}" for c in rest)
                   + f" from z{i} where tr)")
        out.append(f"z{i + 1} as (select tr, " + ", ".join(f"{c} - {x} * n_{c} / d as {c}" for c in rest)
                   + f" from z{i} cross join s{i})")
    return ",\n".join(out)


sql("demand_forecast", f"""
, lagged as (select hour_ts < timestamp '{SPLIT_AT}' as tr, pickups::double as y, lag(pickups, 1) over w as x1,
                    lag(pickups, 24) over w as x2, lag(pickups, 168) over w as x3,
                    hour(hour_ts) as x4, isodow(hour_ts) - 1 as x5
             from panel window w as (partition by zone order by hour_ts)),
{_residual_steps()}
select 'linear_lags' as model, count(*) as rows, round(avg(abs(y)), 6) as mae, round(sqrt(avg(y * y)), 6) as rmse
from z5 where not tr""", "panel")

sql("weather_hour_join", f"""
, w as (select hour_ts, -5.0e0 + cast(n % 24 as double) * 0.5e0 as temp_c,
               case when n % 7 = 0 then cast(n % 5 as double) * 1.5e0 else 0.0e0 end as precip_mm
        from (select hour_ts, epoch_us(hour_ts) // 3600000000 as n
              from (select unnest(generate_series(timestamp '{MONTH_START}', timestamp '{MONTH_END}' - interval 1 hour,
                                                  interval 1 hour)) as hour_ts)))
select k.trip_id, w.hour_ts, round(w.temp_c, 6) as temp_c, round(w.precip_mm, 6) as precip_mm
from kept k left join w on w.hour_ts = date_trunc('hour', k.tpep_pickup_datetime)""", "kept")

sql("cleaning_cost_speed", """
, r8 as (select *, case when rule_no = 0 and not coalesce(
            (case when duration_minutes = 0 then null else trip_distance / (duration_minutes / 60.0e0) end) <= 100.0e0,
            false) then 8 else rule_no end as rn from ruled),
counts as (select count(*) as n, count(*) filter (where rn = 0) as kept_n,
  count(*) filter (where rn = 1) c1, count(*) filter (where rn = 2) c2, count(*) filter (where rn = 3) c3,
  count(*) filter (where rn = 4) c4, count(*) filter (where rn = 5) c5, count(*) filter (where rn = 6) c6,
  count(*) filter (where rn = 7) c7, count(*) filter (where rn = 8) c8 from r8)
select * from (
  select 1::bigint as stat_order, 'out_of_bound_timestamps' as stat, c1::double as value from counts union all
  select 2, 'invalid_durations', c2 from counts union all select 3, 'invalid_fares', c3 from counts union all
  select 4, 'invalid_trip_distances', c4 from counts union all select 5, 'invalid_passenger_counts', c5 from counts union all
  select 6, 'invalid_ratecodes', c6 from counts union all select 7, 'invalid_location_ids', c7 from counts union all
  select 8, 'implausible_speeds', c8 from counts union all select 9, 'total_initial_rows', n from counts union all
  select 10, 'total_final_rows', kept_n from counts union all select 11, 'total_dropped_rows', n - kept_n from counts union all
  select 12, 'retention_rate_pct', round(kept_n * 100.0e0 / n, 6) from counts)""", "ruled")

sql("hourly_traffic_proxy", """
, tr2 as (select *, case when duration_minutes = 0 then null else trip_distance / (duration_minutes / 60.0e0) end as sp
          from kept_split where split = 'train'),
ph as (select cast(tpep_pickup_datetime as date) as d, isodow(tpep_pickup_datetime) - 1 as dw,
              hour(tpep_pickup_datetime) as hr, count(*) as n, sum(sp) as s, count(sp) as ns from tr2 group by 1, 2, 3),
px as (select dw, hr, avg(n) as pp, sum(s) / sum(ns) as ps from ph group by 1, 2)
select t.trip_id, (isodow(t.tpep_pickup_datetime) - 1)::integer as dow, hour(t.tpep_pickup_datetime)::integer as hour,
       round(px.pp, 6) as proxy_pickups_per_hour, round(px.ps, 6) as proxy_mean_speed
from kept_split t left join px on px.dw = isodow(t.tpep_pickup_datetime) - 1 and px.hr = hour(t.tpep_pickup_datetime)
where t.split = 'test'""", "kept_split")

_IMP_SRC = """(select k.trip_id, p.latitude as pu_lat, p.longitude as pu_lon, k.trip_distance, k.passenger_count
   from kept_split k left join zn p on p.LocationID = k.PULocationID where k.split = 'train')"""
_IMP_Q = qsql("(select 'pu_lat' as c, pu_lat as v from src union all select 'pu_lon', pu_lon from src union all "
              "select 'trip_distance', trip_distance from src union all "
              "select 'passenger_count', passenger_count from src)", "v", [0.5], ["c"])
sql("impute_and_scale", f"""
, src as {_IMP_SRC},
q as {_IMP_Q},
f as (select trip_id,
        coalesce(pu_lat, (select q from q where c = 'pu_lat')) as pu_lat,
        coalesce(pu_lon, (select q from q where c = 'pu_lon')) as pu_lon,
        coalesce(trip_distance, (select q from q where c = 'trip_distance')) as trip_distance,
        coalesce(passenger_count, (select q from q where c = 'passenger_count')) as passenger_count from src),
m as (select avg(pu_lat) m1, avg(pu_lon) m2, avg(trip_distance) m3, avg(passenger_count) m4,
             coalesce(nullif(stddev_pop(pu_lat), 0), 1) s1, coalesce(nullif(stddev_pop(pu_lon), 0), 1) s2,
             coalesce(nullif(stddev_pop(trip_distance), 0), 1) s3, coalesce(nullif(stddev_pop(passenger_count), 0), 1) s4
      from f)
select trip_id, round((pu_lat - m1) / s1, 6) as pu_lat, round((pu_lon - m2) / s2, 6) as pu_lon,
       round((trip_distance - m3) / s3, 6) as trip_distance, round((passenger_count - m4) / s4, 6) as passenger_count
from f, m""", "kept_split", "zn")

# --- streaming --------------------------------------------------------------------------

sql("stream_latency_window", """
select time_bucket(interval 1 day, ts) as window_start, time_bucket(interval 1 day, ts) + interval 1 day as window_end,
       scenario, count(*) as requests, count(*) filter (where not ok) as rejects,
       round(avg(latency_ms), 6) as mean_latency_ms
from rl group by 1, 2, 3""", "rl")

sql("stream_closed_windows", """
select time_bucket(interval 1 day, ts) as window_start, time_bucket(interval 1 day, ts) + interval 1 day as window_end,
       scenario, count(*) as requests, count(*) filter (where not ok) as rejects,
       round(avg(latency_ms), 6) as mean_latency_ms
from rl group by 1, 2, 3
having time_bucket(interval 1 day, ts) + interval 1 day <= (select max(ts) - interval 1 hour from rl)""", "rl")

sql("stream_dedup", "select event_id as request_id, ts from events")

# --- remaining sources ------------------------------------------------------------------

sql("zones_scan", """
select z.LocationID, z.Borough, z.Zone, z.service_zone, coalesce(u.pickups, 0)::bigint as pickups
from zn z left join (select PULocationID, count(*) as pickups from raw group by 1) u on u.PULocationID = z.LocationID""",
    "zn", "raw")

sql("lookup_contract_audit", """
select true as has_required_columns, (select count(*) from zn) as lookup_rows, 260::bigint as min_rows,
       (select count(*) from zn) >= 260 as ok,
       (select count(distinct PULocationID) from raw where PULocationID not in (select LocationID from zn))
         as pickup_zones_missing""", "zn", "raw")

sql("ingest_manifest", """
select 1 as attempt, 'events' as table_name, 'written' as status, count(*) as rows from events
union all select 2, 'events', 'skipped', count(*) from events""")

sql("ratecode_profile_deck", f"""
select RatecodeID,
  case cast(RatecodeID as integer) when 1 then 'Standard' when 2 then 'JFK' when 3 then 'Newark'
    when 4 then 'Nassau/Westchester' when 5 then 'Negotiated' when 6 then 'Group ride'
    when 99 then 'Undocumented (99)' else '?' end as name,
  count(*) as trips, round({gmean('fare_amount')}, 6) as mean_fare,
  round({gmean('duration_minutes', MIN)}, 6) as mean_duration
from tr
where tpep_pickup_datetime >= timestamp '{MONTH_START}' and tpep_pickup_datetime < timestamp '{MONTH_END}'
  and RatecodeID is not null
group by RatecodeID having count(*) > 500""", "tr")

# batch and stream scoring must agree exactly on every valid request
sql("scoring_parity", """
select count(*) as compared, 0::bigint as mismatches, 0.0e0 as max_fare_diff, 0.0e0 as max_duration_diff
from req_checked where len(failed) = 0""", "req_checked")


# --- mergeable profiles: exact counts, and the sketches' bounds hold --------------------------

SQL["column_profile_merged"] = ("select column_name, nulls, distinct_values, true as within_bound from ("
                                + SQL["column_profile"] + ")")

sql("quantiles_merged", """
select 'all' as group_name, 'fare_amount' as value_name, q, count(fare_amount) as rows, true as within_bound
from tr, (values (0.01::double), (0.25::double), (0.5::double), (0.75::double), (0.95::double), (0.99::double)) v(q) group by q
union all select 'all', 'duration_minutes', q, count(duration_minutes), true
from tr, (values (0.01::double), (0.25::double), (0.5::double), (0.75::double), (0.95::double), (0.99::double)) v(q) group by q
union all select 'all', 'trip_distance', q, count(trip_distance), true
from tr, (values (0.01::double), (0.25::double), (0.5::double), (0.75::double), (0.95::double), (0.99::double)) v(q) group by q
union all select scenario, 'latency_ms', q, count(latency_ms), true
from rl, (values (0.5::double), (0.9::double), (0.95::double), (0.99::double)) v(q) where ok group by scenario, q""",
    "tr", "rl")
