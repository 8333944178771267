"""SQL twins of the fixture views, as common table expressions for the checks.

Written independently of the DataFrame code: plain joins over fully expanded rows.
"""

from __future__ import annotations

import re

from tramloom.plans.tpch_feed import AGENCY_SETTINGS


def _setting(position: int) -> str:
    whens = " ".join(f"when {k} then '{s[position]}'" for k, s in AGENCY_SETTINGS.items())
    return f"case r_regionkey {whens} end"


def _trip_id(key: str) -> str:
    return (
        f"case when ({key} % 5) in (1, 3) then 'A' || ({key} % 10) || '_' || ({key} // 5) "
        f"else 'T' || ({key} // 5) end"
    )


_CLOCK = (
    r"^\s*([+-]?0+|[+]?0*[1-9]|[+]?0*[1-3][0-9]|[+]?0*4[0-7])"
    r":([+-]?0+|[+]?0*[1-9]|[+]?0*[1-5][0-9]):([+-]?0+|[+]?0*[1-9]|[+]?0*[1-5][0-9])\s*$"
)


def clock_code(text: str) -> str:
    parts = [f"try_cast(split_part({text}, ':', {i}) as integer)" for i in (1, 2, 3)]
    return (
        f"case when regexp_matches({text}, '{_CLOCK}') "
        f"then {parts[0]} * 3600 + {parts[1]} * 60 + {parts[2]} "
        f"when coalesce(trim({text}), '') = '' then -1 else -2 end"
    )


def period(hour: str) -> str:
    return (
        f"case when {hour} >= 6 and {hour} < 10 then 'AM Peak' "
        f"when {hour} >= 10 and {hour} < 16 then 'Midday' "
        f"when {hour} >= 16 and {hour} < 20 then 'PM Peak' "
        f"when {hour} >= 20 and {hour} < 24 then 'Evening' else 'Overnight' end"
    )


def relationship(event_type: str) -> str:
    return (
        f"case {event_type} when 'click' then 'SCHEDULED' when 'view' then 'SCHEDULED' "
        f"when 'purchase' then 'ADDED' when 'signup' then 'CANCELED' end"
    )


def stamp(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds})::bigint * 1000000), '%Y-%m-%d %H:%M:%S')"


_TEXT = "printf('%02d:%02d:%02d', ({s}) // 3600, (({s}) // 60) % 60, ({s}) % 60)"
_ARRIVAL = "(14400 + (l_partkey * 37 + l_linenumber * 600 + l_suppkey * 11) % 86400)"
_DEPARTURE = f"({_ARRIVAL} + l_quantity::bigint - 5)"

CTES = {
    "ag": f"""select r_name as agency_id, r_regionkey as region, {_setting(1)} as mode,
        {_setting(0)} as timezone from region""",
    "ord": """select o.*, r_name as agency_id, r_regionkey as region, o_orderdate::date as day,
        date_trunc('week', o_orderdate)::date as week,
        left(o_orderpriority, 1) || '-' || strftime(date_trunc('week', o_orderdate), '%Y%m%d')
          as service_id
        from orders o join region on r_regionkey = o_orderkey % 5""",
    "routes_t": """select r_name as agency_id, (n_nationkey // 5)::varchar as route_id,
        case when n_nationkey // 5 = 3 then '' else 'R' || (n_nationkey // 5) end as short_name,
        case when n_nationkey // 5 <> 4 then n_name end as long_name,
        ((n_nationkey // 5) % 4)::bigint as route_type
        from nation join region on r_regionkey = n_regionkey""",
    "stops_t": """select r_name as agency_id, s_suppkey::varchar as stop_id,
        case when s_acctbal >= 0 then s_name end as stop_name,
        case when s_acctbal >= 500 then s_nationkey // 5 + (s_suppkey % 97 + 1) / 98.0::double
          end as stop_lat,
        case when s_acctbal >= 500 then s_nationkey % 5 + (s_suppkey % 89 + 1) / 90.0::double
          end as stop_lon,
        case when r_regionkey in (0, 1) then case when s_suppkey % 10 = 0 then 1 end else 0 end
          as location_type,
        case when r_regionkey in (0, 1) and s_suppkey % 10 <> 0 then
          case when s_acctbal > 9500 then 'X' || s_suppkey
          else (s_suppkey - s_suppkey % 10)::varchar end else '' end as parent_station
        from supplier cross join region""",
    "trips_t": f"""select agency_id, {_trip_id('o_orderkey')} as trip_id,
        case when o_totalprice > 499000 then '9' else (c_nationkey // 5)::varchar end as route_id,
        case when o_totalprice < 2000 then 'NONE' else service_id end as service_id,
        case o_orderstatus when 'F' then 0 when 'O' then 1 end as direction_id
        from ord join customer on c_custkey = o_custkey""",
    "stop_times_t": f"""select r_name as agency_id,
        case when l_discount = 0.09 and l_tax = 0.07 and l_quantity = 49
          then 'void-' || l_linenumber else {_trip_id('l_orderkey')} end as trip_id,
        case when l_discount = 0.1 and l_quantity = 50 then 'gone-' || l_linenumber
          else l_suppkey::varchar end as stop_id,
        (l_linenumber * 100000000 + (l_partkey * 7919 + l_suppkey * 104729
          + floor(l_extendedprice * 100 + 0.5)::bigint) % 100000000)::integer as stop_sequence,
        case when l_tax = 0 and l_returnflag in ('A', 'N') then ''
          when l_discount = 0.1 and l_tax = 0.08 then left({_TEXT.format(s=_ARRIVAL)}, 5)
          else {_TEXT.format(s=_ARRIVAL)} end as arrival_time,
        case when l_tax = 0 and l_returnflag in ('A', 'R') then ''
          else {_TEXT.format(s=_DEPARTURE)} end as departure_time
        from lineitem join region on r_regionkey = l_orderkey % 5""",
    "calendar_t": """select agency_id, service_id, week,
        list(distinct isodow(day) - 1) as days from ord where region in (0, 1)
        group by agency_id, service_id, week""",
    "day_status": """select region, agency_id, service_id, day, min(o_orderstatus) as status
        from ord group by all""",
    "calendar_dates_t": """select agency_id, service_id, day, 1 as kind from day_status
          where region not in (0, 1) or isodow(day) = 7
        union all select agency_id, service_id, day, 2 from day_status where status = 'P'""",
    "service_dates": """select agency_id, service_id, day as service_date from (
          select agency_id, service_id, (week + i::integer)::date as day from (
            select *, unnest(range(0, 6)) as i from calendar_t) where list_contains(days, i)
          union select agency_id, service_id, day from calendar_dates_t where kind = 1)
        where (agency_id, service_id, day) not in (
          select (agency_id, service_id, day) from calendar_dates_t where kind = 2)""",
    "cells": f"""select *, {clock_code('arrival_time')} as a, {clock_code('departure_time')} as d
        from stop_times_t""",
    "calls": """select *, case when least(a, d) = -2 then 'malformed'
          when greatest(a, d) = -1 then 'absent' else 'ok' end as state,
        case when a >= 0 then a else d end as arrival,
        case when d >= 0 then d else a end as departure from cells""",
    "zone_days": """select agency_id, service_date, timezone,
          epoch(timezone(timezone, service_date::timestamp + interval 12 hour))::bigint - 43200
            as day_start
        from (select distinct agency_id, service_date from service_dates)
        join ag using (agency_id)""",
    "facts0": """select service_date, c.agency_id, route_id, trip_id, stop_id, stop_sequence,
          direction_id, day_start + arrival as arr, day_start + departure as dep,
          greatest(departure - arrival, 0) as dwell_seconds,
          (arrival >= 86400)::integer as overnight,
          extract(hour from timezone(timezone, to_timestamp(day_start + arrival)))::integer
            as local_hour,
          c.agency_id || ':' || route_id as route_key, c.agency_id || ':' || stop_id as stop_key
        from calls c join trips_t using (agency_id, trip_id)
        join service_dates using (agency_id, service_id)
        join zone_days using (agency_id, service_date) where state = 'ok'""",
    "facts": f"select *, {period('local_hour')} as service_period from facts0",
    "routes_d": """select agency_id || ':' || route_id as route_key, agency_id, mode, route_id,
          route_type, nullif(short_name, '') as route_short_name, long_name as route_long_name,
          coalesce(nullif(short_name, ''), nullif(long_name, ''), route_id) as display_name
        from routes_t join ag using (agency_id)""",
    "stops_l": """select s.*, agency_id || ':' || stop_id as stop_key,
          coalesce(location_type, 0) = 1 as is_station,
          case when parent_station <> '' then agency_id || ':' || parent_station end
            as parent_station_key,
          agency_id || ':' || coalesce(nullif(parent_station, ''), stop_id) as station_key
        from stops_t s""",
    "edges": """select n_name as borough, r_name as municipality,
          n_nationkey % 5 + c[i][1] as x1, n_nationkey // 5 + c[i][2] as y1,
          n_nationkey % 5 + c[i % 4 + 1][1] as x2, n_nationkey // 5 + c[i % 4 + 1][2] as y2
        from (select n_nationkey, n_name, r_name, unnest(range(1, 5)) as i,
          [[0.05::double, 0.1], [0.9, 0.02], [0.97, 0.85], [0.2, 0.95]] as c
          from nation join region on r_regionkey = n_regionkey)""",
    "places": """select stop_lat, stop_lon, min(borough) as borough, min(municipality) as
          municipality from (
          select stop_lat, stop_lon, borough, municipality from
            (select distinct stop_lat, stop_lon from stops_t where stop_lat is not null) p, edges
          where (y1 > stop_lat) <> (y2 > stop_lat)
            and stop_lon < x1 + (stop_lat - y1) * (x2 - x1) / (y2 - y1)
          group by all having count(*) % 2 = 1) group by all""",
    "stops_d": """select l.*, coalesce(borough, 'Unknown') as borough,
          coalesce(municipality, 'Unknown') as municipality,
          coalesce(n.name, l.station_key) as station_name
        from stops_l l left join places using (stop_lat, stop_lon)
        left join (select stop_key as station_key, stop_name as name from stops_l) n
          on n.station_key = l.station_key""",
    "calendar_d": """select service_date, case when is_holiday then 'Holiday'
            when isodow(service_date) >= 6 then 'Weekend' else 'Weekday' end as day_type,
          is_holiday, year(service_date) as year, month(service_date) as month,
          isodow(service_date) - 1 as day_of_week
        from (select distinct service_date, strftime(service_date, '%m-%d')
          in ('01-01', '07-04', '12-25') as is_holiday from service_dates)""",
    "wide": """select f.service_date, f.trip_id, f.agency_id as fact_agency, f.route_key,
          f.stop_key, f.dwell_seconds, f.overnight, f.local_hour, f.service_period,
          coalesce(f.direction_id, -1) as direction_id,
          coalesce(r.agency_id, 'Unknown') as agency_id, coalesce(r.mode, 'Unknown') as mode,
          coalesce(r.display_name, 'Unknown') as display_name,
          coalesce(s.borough, 'Unknown') as borough,
          coalesce(s.municipality, 'Unknown') as municipality,
          coalesce(s.station_name, 'Unknown') as station_name,
          coalesce(s.stop_id, 'Unknown') as stop_id, year, month, day_type
        from facts f left join routes_d r on r.route_key = f.route_key
        left join stops_d s on s.stop_key = f.stop_key
        left join calendar_d c on c.service_date = f.service_date""",
    "observed": f"""select lpad(event_id::varchar, 16, '0') as event_id,
          (ts - interval 4 hour)::date as service_date, 'N' || user_id % 5 as agency_id,
          'N' || user_id % 5 || ':' || (user_id // 5) % 5 as route_key,
          'N' || user_id % 5 || ':' || regexp_extract(props, '[0-9]+')::bigint % 20 as stop_key,
          case when user_id % 3 < 2 then user_id % 3 end as direction_id, ts,
          floor(epoch(ts))::bigint as second,
          case when event_type is distinct from 'signup' then trunc(value * 6 - 120)::integer end
            as delay_seconds, event_type = 'signup' as is_cancelled,
          {relationship('event_type')} as schedule_relationship, user_id::varchar as vehicle_id
        from events""",
    "measured": """select * from observed where schedule_relationship = 'SCHEDULED'
          and not is_cancelled and delay_seconds is not null""",
    "upd": f"""select e.agency_id, coalesce(f.service_date, e.ts::date) as service_date,
          case when e.event_id % 5 in (1, 3) then 'RT_x_' || split_part(e.trip_id, '_', 2)
            else e.trip_id end || case when value > 200 then '-extra' else '' end as trip_id,
          coalesce(f.stop_id, (regexp_extract(props, '[0-9]+')::bigint % 20)::varchar)
            || case when e.event_id % 5 in (1, 3) then
              case when user_id % 2 = 0 then 'N' else 'S' end else '' end as stop_id,
          e.ts as polled_at, case when event_type is distinct from 'signup'
            then coalesce(f.arr + trunc(value * 6 - 120)::bigint, floor(epoch(e.ts))::bigint)
            end as actual,
          {relationship('event_type')} as schedule_relationship,
          event_type = 'signup' as is_cancelled, user_id::varchar as vehicle_id
        from (select ev.*, r_name as agency_id, {_trip_id('event_id')} as trip_id
          from events ev join region on event_id % 5 = r_regionkey) e
        left join facts f on f.agency_id = e.agency_id and f.trip_id = e.trip_id""",
    "upd_latest": """select * from upd qualify row_number() over (
          partition by agency_id, service_date, trip_id, stop_id
          order by polled_at desc, actual desc nulls last,
            schedule_relationship desc nulls last, is_cancelled desc, vehicle_id desc) = 1""",
    "call_keys": """select *, case when agency_id in ('AMERICA', 'EUROPE')
            then split_part(trip_id, '_', -1) else trip_id end as match_trip,
          md5(service_date || '|' || agency_id || '|' || trip_id || '|' || stop_sequence) as call
        from facts""",
    "upd_keys": """select *, case when agency_id in ('AMERICA', 'EUROPE')
            then split_part(trip_id, '_', -1) else trip_id end as match_trip,
          case when agency_id in ('AMERICA', 'EUROPE')
            then regexp_replace(stop_id, '[NS]$', '') else stop_id end as match_stop
        from upd_latest""",
    "cand": """select agency_id, service_date, match_trip, stop_id as match_stop,
          count(*) as n, min(call) as call, min(arr) as arr from call_keys group by all""",
    "matched": """select u.*, n, call, arr, case when n is null then 'unmatched'
            when n = 1 then 'matched' else 'ambiguous' end as match_status
        from upd_keys u left join cand using (agency_id, service_date, match_trip, match_stop)""",
    "best": """select * from matched where match_status = 'matched' qualify row_number() over (
          partition by call order by polled_at desc, actual desc nulls last,
            schedule_relationship desc nulls last, is_cancelled desc, vehicle_id desc) = 1""",
    "stop_ev": """select k.* exclude (match_trip), b.actual, b.schedule_relationship,
          b.is_cancelled, b.vehicle_id, b.actual - k.arr as delay_seconds
        from call_keys k left join best b on b.call = k.call""",
    "poll": f"""select user_id as vehicle, ts::date as service_date, ts,
          floor(epoch(ts))::bigint as second,
          (regexp_extract(props, '[0-9]+')::bigint % 3)::integer as zone,
          {relationship('event_type')} as schedule_relationship,
          epoch_us(ts) - floor(value * 10)::bigint * 1000000 as header_us from events""",
}


def with_ctes(body: str) -> str:
    """The query with the common table expressions it uses, directly or indirectly."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    order = [n for n in CTES if n in needed]
    parts = ", ".join(f"{n} as materialized ({CTES[n]})" for n in order)
    return f"with {parts} {body}" if parts else body
