"""DuckDB text of the adapters, written independently of the DataFrame code.

Each oracle query is ``WITH <adapters> <body>``; only the CTEs a body names are
included. Floats are rounded to 6 decimals once, at the end of each query.
"""

from __future__ import annotations

import re

MONTH_START = "2024-01-01 00:00:00"
MONTH_END = "2024-01-30 00:00:00"
SPLIT_AT = "2024-01-22 00:00:00"

CTES: dict[str, str] = {}

CTES["ev_b"] = """ev_b as (
  select event_id, ts, user_id, event_type, value,
         cast(json_extract(props, '$.k') as bigint) as k,
         (event_id*7919 + user_id*104729) % 1000003 as h
  from events)"""

CTES["ev_c"] = """ev_c as (
  select *, (event_type = 'error' and k < 18) as gap,
         case when h % 71 = 0 then 0.0e0 else cast(h % 2000 as double)/100.0e0 end as dist
  from ev_b)"""

CTES["ev_d"] = """ev_d as (
  select *,
    case when h % 97 = 0 then -60 when h % 89 = 0 then 30000
         else cast(floor(dist*170.0e0) as bigint) + h % 601 end as dur_s,
    case when gap then null when k < 80 then 1.0e0 when k < 88 then 2.0e0 when k < 92 then 3.0e0
         when k < 95 then 4.0e0 when k < 98 then 5.0e0 else 99.0e0 end as rc
  from ev_c)"""

CTES["raw"] = """raw as (
  select event_id as trip_id, 1 + event_id % 2 as VendorID, ts as tpep_pickup_datetime,
    ts + to_seconds(dur_s) as tpep_dropoff_datetime,
    case when gap then null else cast(k % 8 as double) end as passenger_count,
    dist as trip_distance, rc as RatecodeID,
    case when gap then null when k % 50 = 0 then 'Y' else 'N' end as store_and_fwd_flag,
    1 + h % 266 as PULocationID, 1 + (event_id*31 + user_id*17) % 265 as DOLocationID,
    case when gap then 0 else 1 + k % 2 end as payment_type,
    case when h % 101 = 0 then -10.0e0 when rc = 2.0e0 then 52.0e0
         else 3.0e0 + 2.5e0*dist + cast(k as double)/50.0e0 end as fare_amount,
    value as tip_amount
  from ev_d)"""

# trips with duration in fractional minutes
CTES["tr"] = """tr as (
  select *, cast(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) as double) / 6.0e7
            as duration_minutes
  from raw)"""

# rule number of the first failed cleaning rule (0 = kept)
CTES["ruled"] = f"""ruled as (
  select *, case
    when not coalesce(tpep_pickup_datetime >= timestamp '{MONTH_START}' and tpep_pickup_datetime < timestamp '{MONTH_END}', false) then 1
    when not coalesce(duration_minutes >= 0.5e0 and duration_minutes <= 360.0e0, false) then 2
    when not coalesce(fare_amount >= 2.5e0 and fare_amount <= 500.0e0, false) then 3
    when not coalesce(trip_distance >= 0.01e0 and trip_distance <= 150.0e0, false) then 4
    when not coalesce(passenger_count >= 1 and passenger_count <= 9, false) then 5
    when not coalesce(RatecodeID in (1.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0, 6.0e0), false) then 6
    when not coalesce(PULocationID between 1 and 265 and DOLocationID between 1 and 265, false) then 7
    else 0 end as rule_no
  from tr)"""

CTES["kept"] = """kept as (
  select tpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, RatecodeID,
         trip_distance, VendorID, fare_amount, duration_minutes, trip_id
  from ruled where rule_no = 0)"""

CTES["kept_split"] = f"""kept_split as (
  select *, case when tpep_pickup_datetime < timestamp '{SPLIT_AT}' then 'train' else 'test' end as split
  from kept)"""

# notebook analysis frame: none of the nine independent rules hit
CTES["eda"] = f"""eda as (
  select *, hour(tpep_pickup_datetime) as hr, isodow(tpep_pickup_datetime) - 1 as dw,
         cast(tpep_pickup_datetime as date) as dt,
         trip_distance / (duration_minutes / 60.0e0) as speed_mph
  from tr
  where not (coalesce(duration_minutes <= 0, false) or coalesce(duration_minutes > 360, false)
          or coalesce(fare_amount <= 0, false) or coalesce(fare_amount > 500, false)
          or coalesce(trip_distance = 0, false) or coalesce(trip_distance > 100, false)
          or coalesce(passenger_count = 0, false) or coalesce(passenger_count > 6, false)
          or not coalesce(tpep_pickup_datetime between timestamp '{MONTH_START}' and timestamp '{MONTH_END}', false)))"""

CTES["zn"] = """zn as (
  select range as LocationID,
    case when range in (264, 265) then null when range = 1 then 'EWR'
         else ['Manhattan', 'Queens', 'Brooklyn', 'Bronx', 'Staten Island'][range % 5 + 1] end as Borough,
    case when range in (264, 265) then null else 'Zone ' || cast(range as varchar) end as Zone,
    case when range in (264, 265) then null when range in (1, 132, 138) then 'Airports'
         when range % 5 = 0 and range <> 1 then 'Yellow Zone' else 'Boro Zone' end as service_zone,
    case when range in (264, 265) then null else -74.0e0 + cast(range % 15 as double) * 0.03e0 end as longitude,
    case when range in (264, 265) then null else 40.7e0 + cast(range % 20 as double) * 0.02e0 end as latitude
  from range(1, 266))"""

DEPS = {
    "ev_c": ["ev_b"], "ev_d": ["ev_c"], "raw": ["ev_d"], "tr": ["raw"], "ruled": ["tr"],
    "kept": ["ruled"], "kept_split": ["kept"], "eda": ["tr"],
}


def gmean(x: str, unit: str = "1000.0e0") -> str:
    """Mean from the exact integer sum of x on a 1/unit grid."""
    return f"(cast(sum(cast(round(({x}) * {unit}) as bigint)) as double) / {unit} / cast(count({x}) as double))"


def register(name: str, text: str, deps=()) -> None:
    CTES[name] = text
    DEPS[name] = list(deps)


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def _rewrite_round(text: str) -> str:
    """``round(expr, 6)`` -> ``floor(expr*1e6 + 0.5)/1e6`` (same IEEE steps as the Spark side)."""
    out, i = [], 0
    pat = re.compile(r"(?<![A-Za-z_])round\(")
    while True:
        m = pat.search(text, i)
        if not m:
            out.append(text[i:])
            return "".join(out)
        out.append(text[i:m.start()])
        depth, j, last_comma = 1, m.end(), None
        while depth:
            ch = text[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = j
            j += 1
        inner = text[m.end():j - 1]
        if last_comma is None or text[last_comma + 1:j - 1].strip() != "6":
            out.append("round(" + _rewrite_round(inner) + ")")
        else:
            expr = _rewrite_round(text[m.end():last_comma])
            out.append(f"(case when isnan(({expr})::double) or abs({expr}) >= 1e12 then ({expr})::double "
                       f"else floor(({expr}) * 1000000.0e0 + 0.5e0) / 1000000.0e0 end)")
        i = j


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    if not names:
        names = tuple(n for n in CTES if re.search(rf"\b{n}\b", body))
    order = _closure(names)
    if not order:
        return _rewrite_round(body)
    head = "with " + ",\n".join(CTES[n] for n in order)
    return _rewrite_round(head + (body if body.lstrip().startswith(",") else "\n" + body))


def qsql(src: str, value: str, probs, groups=()) -> str:
    """Quantiles by explicit ranks: (groups..., p, q) with numpy's linear lerp."""
    g = list(groups)
    gsel = "".join(f"{c}, " for c in g)
    part = f"partition by {', '.join(g)}" if g else ""
    pv = ", ".join(f"({float(p)!r}::double)" for p in probs)
    join_g = " and ".join([f"r.{c} = a.{c}" for c in g] + [f"r.{c} = b.{c}" for c in g]) or "true"
    return f"""(
  with r0 as (select {gsel}cast({value} as double) as v from {src} where {value} is not null and not isnan({value})),
  r as (select {gsel}v, row_number() over ({part} order by v) - 1 as pos, count(*) over ({part}) as n from r0),
  ps(p) as (values {pv}),
  w as (select distinct {gsel}n, p, (n - 1)::double * p as h from r, ps)
  select {''.join(f'w.{c}, ' for c in g)}w.p,
    case when w.h - floor(w.h) < 0.5 then a.v + (b.v - a.v) * (w.h - floor(w.h))
         else b.v - (b.v - a.v) * (1.0e0 - (w.h - floor(w.h))) end as q
  from w join r a on a.pos = floor(w.h) {''.join(f'and a.{c} = w.{c} ' for c in g)}
         join r b on b.pos = ceil(w.h) {''.join(f'and b.{c} = w.{c} ' for c in g)})"""
