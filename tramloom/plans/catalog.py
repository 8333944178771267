"""Every registered query with its SQL twin.

Results are rendered to plain types (text dates, rounded doubles) so that both
engines print the same values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.functions import clock, keys
from tramloom.operators import calendar as cal
from tramloom.operators import cube as cubes
from tramloom.operators import dimensions as dims
from tramloom.operators import realtime as rt
from tramloom.operators import schedule, validate
from tramloom.plans import oracle, tpch_feed as fx
from tramloom.plans.build import Cube
from tramloom.session import prepare, shared_dir
from tramloom.sources import dataset
from tramloom.streaming import events as live
from tramloom.streaming import matching
from tramloom.streaming import replay as late_rows
from tramloom.streaming import stateful
from tramloom.streaming import windows as live_windows
from tramloom.streaming.replay import replay
from tramloom.streaming.settings import StreamSettings
from tramloom.streaming.sinks import BatchFolders, KeptTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its twin."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql if sql.startswith("with ") else oracle.with_ctes(sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    columns: list[Column] = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int").cast("bigint")
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 4)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def text(column: str) -> Column:
    """A nullable number as text, so that an absent one stays absent everywhere."""
    return F.col(column).cast("string").alias(column)


# --- shared inputs --------------------------------------------------------


_built: dict[tuple[str, str, str], str] = {}
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """The shuffles of a job in here are removed with it and not kept beside those of the next."""
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.resolve_schedule(
        fx.feed(spark, sf_dir), fx.agencies(spark, sf_dir), zones=fx.ZONES)


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A table built once per session in the shared folder, as a cube opens a dataset."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        rows = build(spark, sf_dir)
        with _shuffles_removed(spark):
            rows.write.parquet(path)
        _built[key] = path
    return spark.read.parquet(_built[key])


#: Calls in a partition of their own before they become a row a date.
_CALLS_A_TASK = 50_000


def _services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "services", lambda spark, sf_dir: schedule.service_days(
        _service_dates(spark, sf_dir), fx.agencies(spark, sf_dir), fx.ZONES))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled calls, stored with their service and without its dates."""
    return _stored(spark, sf_dir, "calls", lambda spark, sf_dir: schedule.calls_by_service(
        fx.feed(spark, sf_dir), _services(spark, sf_dir)))


def _dated_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.dated(_calls(spark, sf_dir), _services(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.fact_rows(_dated_calls(spark, sf_dir), fx.ZONES)


def _parts(spark: SparkSession, calls: DataFrame) -> int:
    """Partitions for the calls; their number is in the files' footers."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-calls.count() // _CALLS_A_TASK))


def _spread_facts(spark: SparkSession, sf_dir: str) -> cubes.Spread:
    calls, services = _calls(spark, sf_dir), _services(spark, sf_dir)

    def by(column: str) -> DataFrame:
        keyed = schedule.with_stop_key(calls) if column == "stop_key" else calls
        laid = keyed.repartition(_parts(spark, calls), column)
        return schedule.fact_rows(schedule.dated(laid, services), fx.ZONES)

    dated = schedule.dated(calls, services)
    return cubes.Spread(
        schedule.fact_rows(dated, fx.ZONES), by, schedule.span_rows(dated, fx.ZONES), _parts(spark, calls))


def _service_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.feed(spark, sf_dir)
    return cal.expand_calendar(feed.calendar, feed.calendar_dates)


def _calendar(dates: DataFrame) -> DataFrame:
    holidays = dims.fixed_date_holidays(dates, [(1, 1), (7, 4), (12, 25)])
    return dims.calendar_dimension(dates, holidays)


def _dimensions(spark: SparkSession, sf_dir: str) -> cubes.Dimensions:
    feed = fx.feed(spark, sf_dir)
    return cubes.Dimensions.of(
        dims.route_dimension(feed, fx.agencies(spark, sf_dir)),
        dims.stop_dimension(feed, fx.boundaries(spark, sf_dir)),
        _calendar(cal.expand_calendar(feed.calendar, feed.calendar_dates)),
    )


def _cube(spark: SparkSession, sf_dir: str) -> Cube:
    return Cube(_spread_facts(spark, sf_dir), _dimensions(spark, sf_dir))


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The updates, made from the calls of the trips that are reported."""
    calls = _calls(spark, sf_dir)
    laid = calls.repartition(_parts(spark, calls), "agency_id", "trip_id")
    return fx.updates(spark, sf_dir, laid, _services(spark, sf_dir))


_MATCH_KEY = ("agency_id", "match_trip")

def _bucketed(spark: SparkSession, sf_dir: str, name: str, parts: int, build: Callable[[], DataFrame]) -> DataFrame:
    """A table built once per session, in ``parts`` buckets by match key, so that who matches shuffles none of it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        table = f"{name}_{uuid.uuid4().hex}"
        rows = build()
        with _shuffles_removed(spark):
            rows.write.bucketBy(parts, *_MATCH_KEY).option("path", f"{shared_dir(spark)}/{table}").saveAsTable(table)
        _built[key] = table
    return spark.table(_built[key])


def _keyed_calls(spark: SparkSession, sf_dir: str, stops: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The calls without their dates by agency and match key, with it, and in how many partitions.

    ``stops`` (by stop_key) has further columns for the calls.
    """
    feed, agencies = fx.feed(spark, sf_dir), fx.agencies(spark, sf_dir)
    parts = _parts(spark, feed.stop_times)
    keyed = _bucketed(spark, sf_dir, "keyed_calls", parts, lambda: rt.with_match_keys(
        schedule.calls_by_service(feed, _services(spark, sf_dir), agencies, parts), agencies, realtime=False))
    if stops is None:
        return keyed, parts
    more = sorted(c for c in stops.columns if c != "stop_key")
    # Where stops are too many to be sent to the calls, only trips and stops travel, there and back.
    own = schedule.with_stop_key(keyed)
    called = _bucketed(spark, sf_dir, "_".join(["called", *more]), parts, lambda: own.select(
        *_MATCH_KEY, "stop_key").distinct().join(stops, "stop_key").repartition(parts, *_MATCH_KEY))
    return own.join(called, [*_MATCH_KEY, "stop_key"], "left").drop("stop_key"), parts


def _by_match_key(spark: SparkSession, sf_dir: str, stops: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``_keyed_calls`` with their dates."""
    keyed, parts = _keyed_calls(spark, sf_dir, stops)
    return schedule.dated(keyed, _services(spark, sf_dir)), parts


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The updates as messages, made where the calls lie."""
    calls, parts = _keyed_calls(spark, sf_dir)
    rules = fx.agencies(spark, sf_dir).select("agency_id", "trip_id_match").distinct()

    def laid(reported: DataFrame) -> DataFrame:
        keyed = reported.join(rules, "agency_id").withColumn(
            "match_trip", keys.trip_match_key(F.col("trip_id"), F.col("trip_id_match"))).drop("trip_id_match")
        return keyed.repartition(parts, *_MATCH_KEY)

    return fx.messages(spark, sf_dir, calls, _services(spark, sf_dir), laid)


def _filled(
    spark: SparkSession, sf_dir: str, stops: DataFrame | None = None, headways: bool = False
) -> DataFrame:
    """The facts with their realtime columns, and with the columns of ``stops`` if there are any.

    Headways are worked out only for who asks for them.
    """
    calls, parts = _by_match_key(spark, sf_dir)

    def observed() -> DataFrame:
        return rt.observed_by_call(calls, _messages(spark, sf_dir), fx.agencies(spark, sf_dir), parts, headways=False)

    # The way to the stops and back begins when the messages' shuffles are gone.
    seen = rt.with_gaps(_bucketed(spark, sf_dir, "seen", parts, observed), parts) if headways else observed()
    if stops is None:
        return rt.filled_calls(calls, seen, fx.ZONES)
    more = tuple(c for c in stops.columns if c != "stop_key")
    return rt.filled_calls(_by_match_key(spark, sf_dir, stops)[0], seen, fx.ZONES, more)


def _delay_cube(spark: SparkSession, sf_dir: str, headways: bool = False) -> Cube:
    facts = _filled(spark, sf_dir, headways=headways)
    spread = cubes.Spread(
        facts, lambda column: facts.repartition(column),
        with_stops=lambda stops: _filled(spark, sf_dir, stops, headways))
    return Cube(spread, _dimensions(spark, sf_dir))


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.polls(fx.as_events(fx.table(spark, sf_dir, "events")))


# --- scalar functions -----------------------------------------------------


@query("parse_gtfs_time", """
    select t as clock, case when code >= 0 then 'ok' when code = -1 then 'absent'
        else 'malformed' end as state, case when code >= 0 then code end::varchar as seconds,
      case when code >= 0 then printf('%02d:%02d:%02d', code // 3600, (code // 60) % 60, code % 60)
        end as formatted, (code >= 86400)::bigint as rolls_over, n
    from (select arrival_time as t, a as code, count(*) as n from cells group by all)""")
def _parse_gtfs_time(spark, sf_dir):
    cells = fx.feed(spark, sf_dir).stop_times.groupBy(F.col("arrival_time").alias("clock")).agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("code", clock.clock_code(F.col("clock")))
    code = F.col("code")
    seconds = F.when(code >= 0, code)
    return cells.select(
        "clock", clock.code_state(code).alias("state"), seconds.cast("string").alias("seconds"),
        clock.format_clock(seconds).alias("formatted"),
        clock.rolls_over(code).alias("rolls_over"), "n",
    )


@query("resolve_instant", f"""
    select agency_id, service_date::varchar as service_date, s::bigint as clock_seconds,
      {oracle.stamp('day_start + s')} as instant,
      extract(hour from timezone(timezone, to_timestamp(day_start + s)))::bigint as local_hour
    from zone_days, (values (0), (9000), (25200), (91800)) v(s)""")
def _resolve_instant(spark, sf_dir):
    days = cal.active_dates(_service_dates(spark, sf_dir)).join(
        fx.agencies(spark, sf_dir).select("agency_id", "timezone"), "agency_id"
    ).withColumn("clock_seconds", F.explode(F.array(*map(F.lit, (0, 9000, 25200, 91800)))))
    instant = clock.resolve_instant(F.col("service_date"), F.col("clock_seconds"),
                                    F.col("timezone"))
    return days.select(
        "agency_id", "service_date", "clock_seconds", instant.alias("instant"),
        clock.local_hour(instant, F.col("timezone"), fx.ZONES).alias("local_hour"),
    )


@query("service_period", f"""
    select (arrival // 3600)::bigint as clock_hour,
      {oracle.period('((arrival // 3600) % 24)')} as service_period, count(*) as calls
    from calls where state = 'ok' group by all""")
def _service_period(spark, sf_dir):
    calls = schedule.timed_calls(fx.feed(spark, sf_dir).stop_times).where(
        F.col("state") == clock.OK)
    hours = calls.groupBy(F.floor(F.col("arrival") / 3600).cast("int").alias("clock_hour")).agg(
        F.count(F.lit(1)).alias("calls"))
    return hours.select(
        "clock_hour", clock.clock_period(F.col("clock_hour")).alias("service_period"), "calls")


@query("service_date_for", """
    select (timezone('America/New_York', timezone('UTC', ts)) - interval 4 hour)::date::varchar
        as service_date,
      (extract(minute from timezone('America/New_York', timezone('UTC', ts))) // 15)::bigint
        as quarter_hour, count(*) as events
    from events group by all""")
def _service_date_for(spark, sf_dir):
    events = fx.as_events(fx.table(spark, sf_dir, "events"))
    zone = F.lit("America/New_York")
    return events.groupBy(
        clock.service_date_for(clock.local_time(F.col("instant"), zone)).alias("service_date"),
        clock.quarter_hour(F.col("instant"), zone).alias("quarter_hour"),
    ).agg(F.count(F.lit(1)).alias("events"))


@query("event_id", """
    select lpad(lower(to_hex(list_reduce(list_concat(s, [q & 255, (q >> 8) & 255, (q >> 16) & 255,
        (q >> 24) & 255]), lambda h, b: (xor(h, b) * 17592186044851::hugeint)
          % 18446744073709551616::hugeint)::ubigint)), 16, '0') as event_id,
      agency_id, service_date::varchar as service_date, trip_id, stop_sequence::bigint
        as stop_sequence
    from (select *, stop_sequence::hugeint as q,
        list_concat([14695981039346656037::hugeint],
          list_transform(string_split(agency_id || chr(31) || service_date || chr(31) || trip_id
            || chr(31), ''), lambda c: ascii(c)::hugeint)) as s from facts)""")
def _event_id(spark, sf_dir):
    return _resolved(spark, sf_dir).select(
        "event_id", "agency_id", "service_date", "trip_id", "stop_sequence")


@query("match_keys", """
    select agency_id, case when agency_id in ('AMERICA', 'EUROPE')
        then split_part(trip_id, '_', -1) else trip_id end as match_trip,
      case when agency_id in ('AMERICA', 'EUROPE') then regexp_replace(stop_id, '[NS]$', '')
        else stop_id end as match_stop, count(*) as updates
    from upd group by all""")
def _match_keys(spark, sf_dir):
    updates = _updates(spark, sf_dir)
    rows = updates.join(fx.agencies(spark, sf_dir), "agency_id")
    return rows.groupBy(
        "agency_id",
        keys.trip_match_key(F.col("trip_id"), F.col("trip_id_match")).alias("match_trip"),
        keys.match_stop_id(F.col("stop_id"), F.col("stop_id_direction_suffix"))
        .alias("match_stop"),
    ).agg(F.count(F.lit(1)).alias("updates"))


# --- calendar -------------------------------------------------------------


@query("expand_calendar", """
    select agency_id, service_id, service_date::varchar as service_date from service_dates""")
def _expand_calendar(spark, sf_dir):
    return _service_dates(spark, sf_dir)


@query("coverage", """
    select agency_id, min(service_date)::varchar as first_date,
      max(service_date)::varchar as last_date from service_dates group by all""")
def _coverage(spark, sf_dir):
    return cal.coverage(_service_dates(spark, sf_dir))


@query("shared_window", """
    select max(a)::varchar as first_date, min(b)::varchar as last_date from (
      select min(service_date) as a, max(service_date) as b from service_dates
      group by agency_id)""")
def _shared_window(spark, sf_dir):
    return cal.shared_coverage(_service_dates(spark, sf_dir))


@query("services_on", """
    select agency_id, service_date::varchar as service_date, count(*) as services
    from service_dates group by all""")
def _services_on(spark, sf_dir):
    return _service_dates(spark, sf_dir).groupBy("agency_id", "service_date").agg(
        F.count(F.lit(1)).alias("services"))


@query("service_lookup", """
    select 'services' as asked, agency_id, service_id, service_date::varchar as service_date
    from service_dates where service_date = date '1997-06-02'
    union all select 'dates', agency_id, service_id, service_date::varchar from service_dates
    where agency_id = 'ASIA' and service_id = (
      select min(service_id) from service_dates where agency_id = 'ASIA')""")
def _service_lookup(spark, sf_dir):
    """The services of a date, and the dates of a service."""
    dates = _service_dates(spark, sf_dir)
    day = dt.date(1997, 6, 2)
    first = dates.where("agency_id = 'ASIA'").agg(F.min("service_id")).first()[0]
    return cal.services_on(dates, day).select(
        F.lit("services").alias("asked"), "agency_id", "service_id",
        F.lit(day).cast("string").alias("service_date"),
    ).unionByName(cal.dates_for(dates, "ASIA", first).select(
        F.lit("dates").alias("asked"), F.lit("ASIA").alias("agency_id"),
        F.lit(first).alias("service_id"), F.col("service_date").cast("string").alias("service_date")))


@query("empty_services", """
    select distinct agency_id, service_id from (
      select agency_id, service_id from calendar_t
      union all select agency_id, service_id from calendar_dates_t where kind = 1)
    where (agency_id, service_id) not in (select (agency_id, service_id) from service_dates)""")
def _empty_services(spark, sf_dir):
    feed = fx.feed(spark, sf_dir)
    return cal.empty_services(
        feed.calendar, feed.calendar_dates, _service_dates(spark, sf_dir))


# --- schedule -------------------------------------------------------------


@query("resolve_schedule", f"""
    select service_date::varchar as service_date, agency_id, route_id, route_key, trip_id, stop_id,
      stop_key, stop_sequence::bigint as stop_sequence, direction_id::varchar as direction_id,
      {oracle.stamp('arr')} as scheduled_arrival, {oracle.stamp('dep')} as scheduled_departure,
      dwell_seconds::bigint as dwell_seconds, overnight::bigint as crosses_midnight,
      local_hour::bigint as local_hour, service_period, overnight::bigint as overnight
    from facts""")
def _resolve_schedule(spark, sf_dir):
    facts = _resolved(spark, sf_dir)
    skipped = ("event_id", *fx_realtime)
    return facts.drop(*skipped).withColumn("direction_id", text("direction_id"))


@query("resolve_window", """
    select agency_id, service_date::varchar as service_date, count(*) as calls, min(arr) as first_arrival
    from facts, (select max(a) as first_date, min(b) as last_date from (
      select min(service_date) as a, max(service_date) as b from service_dates group by agency_id))
    where service_date between first_date and least(last_date, first_date + interval 6 day)
    group by all""".replace("min(arr) as first_arrival", f"{oracle.stamp('min(arr)')} as first_arrival"))
def _resolve_window(spark, sf_dir):
    """The first week that all agencies cover, resolved and nothing else."""
    feed, agencies = fx.feed(spark, sf_dir), fx.agencies(spark, sf_dir)
    dates = _service_dates(spark, sf_dir)
    names = [r.agency_id for r in agencies.select("agency_id").collect()]
    window = cal.shared_window(dates, names, days=7)
    facts = schedule.resolve_schedule(feed, agencies, window, fx.ZONES)
    return facts.groupBy("agency_id", "service_date").agg(
        F.count(F.lit(1)).alias("calls"), F.min("scheduled_arrival").alias("first_arrival"))


@query("facts_roundtrip", f"""
    select service_date::varchar as service_date, agency_id, route_id, route_key, trip_id, stop_id,
      stop_key, stop_sequence::bigint as stop_sequence, direction_id::varchar as direction_id,
      {oracle.stamp('arr')} as scheduled_arrival, {oracle.stamp('dep')} as scheduled_departure,
      dwell_seconds::bigint as dwell_seconds, overnight::bigint as crosses_midnight,
      local_hour::bigint as local_hour, service_period, overnight::bigint as overnight,
      true::bigint as without_realtime
    from facts where service_date in (date '1997-06-02', date '1997-06-03')""")
def _facts_roundtrip(spark, sf_dir):
    """All columns of a window of dates, in the stored layout, read back for two dates."""
    root = f"{shared_dir(spark)}/dataset-{uuid.uuid4().hex}"
    window = dt.date(1997, 5, 26), dt.date(1997, 6, 22)
    dataset.write_facts(schedule.resolve_schedule(
        fx.feed(spark, sf_dir), fx.agencies(spark, sf_dir), window, fx.ZONES), root)
    stored = dataset.load_facts(
        spark, root, [dt.date(1997, 6, 2), dt.date(1997, 6, 3)], fx.agencies(spark, sf_dir))
    empty = F.lit(True)
    for name in fx_realtime:
        empty = empty & F.col(name).isNull()
    return stored.withColumn("without_realtime", empty.cast("int")).drop(
        "event_id", *fx_realtime).withColumn("direction_id", text("direction_id"))


fx_realtime = ("actual_arrival", "delay_seconds", "headway_seconds", "is_cancelled",
               "schedule_relationship", "vehicle_id")

_STATS = """
    stats as (select agency_id, service_date, count(distinct trip_id) as trips,
        count(*) filter (state = 'ok') as events,
        count(*) filter (state = 'absent') as untimed_stop_times,
        count(*) filter (state = 'malformed') as malformed_times,
        count(*) filter (state = 'ok' and arrival >= 86400) as crossing_midnight
      from calls join trips_t using (agency_id, trip_id)
        join service_dates using (agency_id, service_id) group by all)"""
_MEASURES = ("trips", "events", "untimed_stop_times", "malformed_times", "crossing_midnight")


@query("resolution_stats", """
    select agency_id, service_date::varchar as service_date, coalesce(trips, 0) as trips,
      coalesce(events, 0) as events, coalesce(untimed_stop_times, 0) as untimed_stop_times,
      coalesce(malformed_times, 0) as malformed_times,
      coalesce(crossing_midnight, 0) as crossing_midnight
    from zone_days left join (""" + _STATS.split("as (", 1)[1] + """
      using (agency_id, service_date)""")
def _resolution_stats(spark, sf_dir):
    return schedule.resolution_stats(fx.feed(spark, sf_dir))


@query("build_summary", """
    select agency_id, count(*) filter (coalesce(events, 0) > 0) as dates_written,
      count(*) filter (coalesce(events, 0) = 0) as dates_empty,
      """ + ", ".join(f"coalesce(sum({m}), 0)::bigint as {m}" for m in _MEASURES) + """,
      (select count(*) from routes_t r where r.agency_id = z.agency_id) as routes,
      (select count(*) from stops_t s where s.agency_id = z.agency_id) as stops,
      min(service_date)::varchar as first_date, max(service_date)::varchar as last_date
    from zone_days z left join (""" + _STATS.split("as (", 1)[1] + """
      using (agency_id, service_date) group by agency_id""")
def _build_summary(spark, sf_dir):
    return schedule.build_summary(fx.feed(spark, sf_dir))


@query("feed_profile", """
    select agency_id, (select count(*) from routes_t r where r.agency_id = g.agency_id) as routes,
      (select count(*) from stops_t r where r.agency_id = g.agency_id) as stops,
      (select count(*) from trips_t r where r.agency_id = g.agency_id) as trips,
      (select count(*) from cells r where r.agency_id = g.agency_id) as stop_times,
      (select count(*) from calendar_t r where r.agency_id = g.agency_id) as calendar,
      (select count(*) from calendar_dates_t r where r.agency_id = g.agency_id) as calendar_dates,
      (select count(distinct service_id) from (select agency_id, service_id from calendar_t union
        select agency_id, service_id from calendar_dates_t where kind = 1) r
        where r.agency_id = g.agency_id) as services,
      (select count(*) from cells r where r.agency_id = g.agency_id and a >= 86400)
        as past_midnight,
      (select count(*) from zone_days r where r.agency_id = g.agency_id) as active_dates,
      (select min(service_date)::varchar from zone_days r where r.agency_id = g.agency_id)
        as first_date,
      (select max(service_date)::varchar from zone_days r where r.agency_id = g.agency_id)
        as last_date,
      round(100.0::double * (select count(*) from cells r where r.agency_id = g.agency_id
        and a >= 86400) / (select count(*) from cells r where r.agency_id = g.agency_id), 4)
        as past_midnight_percent
    from ag g""")
def _feed_profile(spark, sf_dir):
    return schedule.feed_profile(fx.feed(spark, sf_dir))


# --- validation -----------------------------------------------------------

_DANGLING = """
    select agency_id, 'trips.txt' as file, 'route_id' as field, route_id as value,
      'routes.txt' as "references", count(*) as occurrences from trips_t
      where (agency_id, route_id) not in (select (agency_id, route_id) from routes_t) group by all
    union all select agency_id, 'trips.txt', 'service_id', service_id,
      'calendar.txt/calendar_dates.txt', count(*) from trips_t
      where (agency_id, service_id) not in (select (agency_id, service_id) from calendar_t)
        and (agency_id, service_id) not in (select (agency_id, service_id) from calendar_dates_t)
      group by all
    union all select agency_id, 'stop_times.txt', 'trip_id', trip_id, 'trips.txt', count(*)
      from stop_times_t where (agency_id, trip_id) not in
        (select (agency_id, trip_id) from trips_t) group by all
    union all select agency_id, 'stop_times.txt', 'stop_id', stop_id, 'stops.txt', count(*)
      from stop_times_t where (agency_id, stop_id) not in
        (select (agency_id, stop_id) from stops_t) group by all
    union all select agency_id, 'stops.txt', 'parent_station', parent_station, 'stops.txt',
      count(*) from stops_t where parent_station <> '' and (agency_id, parent_station) not in
        (select (agency_id, stop_id) from stops_t) group by all"""
_DUPLICATES = """
    select agency_id, 'stops.txt' as file, 'stop_id' as field, stop_id as value,
      'a unique key' as "references", 2::bigint as occurrences from stops_t
      where stop_lat < 1 and stop_name is not null
    union all select agency_id, 'routes.txt', 'route_id', route_id, 'a unique key', 2 from routes_t
      where route_id = '2'"""


@query("violations", _DANGLING)
def _violations(spark, sf_dir):
    return validate.violations(fx.feed(spark, sf_dir))


@query("duplicate_keys", _DUPLICATES)
def _duplicate_keys(spark, sf_dir):
    return validate.duplicate_keys(fx.feed_with_duplicates(spark, sf_dir))


@query("trips_without_calls", """
    select agency_id, 'trips.txt' as file, 'trip_id' as field, trip_id as value,
      'stop_times.txt' as "references", count(*) as occurrences from trips_t
    where (agency_id, trip_id) not in (select (agency_id, trip_id) from stop_times_t)
    group by all""")
def _trips_without_calls(spark, sf_dir):
    return validate.trips_without_calls(fx.feed(spark, sf_dir))


@query("agency_guard", "select distinct agency_id from observed")
def _agency_guard(spark, sf_dir):
    return dataset.unknown_agencies(fx.observed(spark, sf_dir), fx.agencies(spark, sf_dir))


# --- dimensions -----------------------------------------------------------


@query("routes_dim", """
    select route_key, route_id, agency_id, mode, route_type, route_short_name, route_long_name,
      display_name, null::varchar as route_color from routes_d""")
def _routes_dim(spark, sf_dir):
    return dims.route_dimension(fx.feed(spark, sf_dir), fx.agencies(spark, sf_dir))


@query("stops_dim", """
    select stop_key, stop_id, agency_id, stop_name, round(stop_lat, 4)::varchar as stop_lat,
      round(stop_lon, 4)::varchar as stop_lon, is_station::bigint as is_station,
      parent_station_key, station_key, 'Unknown' as borough, 'Unknown' as municipality
    from stops_l""")
def _stops_dim(spark, sf_dir):
    stops = dims.stop_dimension(fx.feed(spark, sf_dir))
    return stops.withColumns({
        c: F.round(c, 4).cast("string") for c in ("stop_lat", "stop_lon")})


@query("geo_join", "select stop_key, borough, municipality from stops_d")
def _geo_join(spark, sf_dir):
    stops = dims.stop_dimension(fx.feed(spark, sf_dir), fx.boundaries(spark, sf_dir))
    return stops.select("stop_key", "borough", "municipality")


@query("station_name", "select stop_key, station_key, station_name from stops_d")
def _station_name(spark, sf_dir):
    stops = dims.with_station_names(dims.stop_dimension(fx.feed(spark, sf_dir)))
    return stops.select("stop_key", "station_key", "station_name")


@query("calendar_dim", """
    select service_date::varchar as service_date, day_type, is_holiday::bigint as is_holiday,
      year, month, day_of_week from calendar_d""")
def _calendar_dim(spark, sf_dir):
    return _calendar(_service_dates(spark, sf_dir))


@query("dimension_roundtrip", "select stop_key, station_name, borough from stops_d")
def _dimension_roundtrip(spark, sf_dir):
    """Written per agency to the shared folder and read back."""
    root = f"{shared_dir(spark)}/dataset-{uuid.uuid4().hex}"
    feed = fx.feed(spark, sf_dir)
    stops = dims.stop_dimension(feed, fx.boundaries(spark, sf_dir))
    dataset.write_dimension(stops, root, "stops")
    stored = dataset.load_dimension(spark, root, "stops")
    return dims.with_station_names(stored).select("stop_key", "station_name", "borough")


# --- cube -----------------------------------------------------------------

_TEN = """count(*) as scheduled_stops, count(distinct trip_id) as scheduled_trips,
      count(distinct route_key) as routes_served, count(distinct stop_key) as stops_served,
      count(distinct service_date) as service_days,
      round(count(distinct trip_id)::double / count(distinct service_date), 4)
        as trips_per_service_day,
      round(count(*)::double / count(distinct trip_id), 4) as stops_per_trip,
      round(avg(dwell_seconds), 4) as mean_dwell_seconds,
      sum(overnight)::bigint as overnight_stops,
      round(sum(overnight)::double / count(*), 4) as overnight_share"""


def _cube_sql(*columns: str, where: str = "true") -> str:
    names = ", ".join(
        "service_date::varchar as service_date" if c == "service_date"
        else f"{c}::bigint as {c}" if c in ("year", "month", "local_hour", "direction_id") else c
        for c in columns)
    lead = f"{names}, " if columns else ""
    groups = f"group by {', '.join(columns)}" if columns else ""
    return f"select {lead}{_TEN} from wide where {where} {groups}"


def _rollup_sql(*hierarchies: tuple[str, ...]) -> str:
    columns = [c for h in hierarchies for c in h]
    grouping = ", ".join(f"rollup ({', '.join(h)})" for h in hierarchies)
    numbers = ("year", "month", "local_hour", "direction_id")
    names = ", ".join(
        f"{c}::varchar as {c}" if c == "service_date" or c in numbers else c for c in columns)
    return (f"select {names}, grouping({', '.join(columns)})::bigint as level_mask, {_TEN} "
            f"from wide group by {grouping}")


@query("cube_total", _cube_sql())
def _cube_total(spark, sf_dir):
    return _cube(spark, sf_dir).query(*cubes.SCHEDULE_MEASURES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled trips per route per hour by day type."""
    return _cube(spark, sf_dir).query(
        "scheduled_trips", levels=["display_name", "local_hour", "day_type"])


query("cube_route_hour_daytype", """
    select agency_id, mode, display_name, local_hour::bigint as local_hour, day_type,
      count(distinct trip_id) as scheduled_trips from wide group by all""")(flagship)


@query("cube_geography_rollup",
       _rollup_sql(("borough", "municipality", "station_name", "stop_id")))
def _cube_geography_rollup(spark, sf_dir):
    return _cube(spark, sf_dir).rollup(*cubes.SCHEDULE_MEASURES, hierarchies=["Geography"])


@query("cube_network_rollup", _rollup_sql(("agency_id", "mode", "display_name")))
def _cube_network_rollup(spark, sf_dir):
    return _cube(spark, sf_dir).rollup(*cubes.SCHEDULE_MEASURES, hierarchies=["Network"])


@query("cube_calendar_rollup", _rollup_sql(("year", "month", "service_date")))
def _cube_calendar_rollup(spark, sf_dir):
    result = _cube(spark, sf_dir).rollup(*cubes.SCHEDULE_MEASURES, hierarchies=["Calendar"])
    return result.withColumns({c: text(c) for c in ("year", "month", "service_date")})


@query("cube_network_period_rollup",
       _rollup_sql(("agency_id", "mode", "display_name"), ("service_period",)))
def _cube_network_period_rollup(spark, sf_dir):
    return _cube(spark, sf_dir).rollup(
        *cubes.SCHEDULE_MEASURES, hierarchies=["Network", "Service Period"])


@query("cube_period", _cube_sql("service_period"))
def _cube_period(spark, sf_dir):
    return _cube(spark, sf_dir).query(*cubes.SCHEDULE_MEASURES, levels=["service_period"])


@query("cube_hour_direction", _cube_sql("local_hour", "direction_id"))
def _cube_hour_direction(spark, sf_dir):
    return _cube(spark, sf_dir).query(
        *cubes.SCHEDULE_MEASURES, levels=["local_hour", "direction_id"])


@query("cube_date_period", _cube_sql("year", "month", "service_date", "service_period"))
def _cube_date_period(spark, sf_dir):
    return _cube(spark, sf_dir).query(
        *cubes.SCHEDULE_MEASURES, levels=["service_date", "service_period"])


@query("cube_members", _cube_sql(
    "borough", where="day_type = 'Weekday' and service_period = 'PM Peak' and mode = 'bus'"))
def _cube_members(spark, sf_dir):
    return _cube(spark, sf_dir).query(
        *cubes.SCHEDULE_MEASURES, levels=["borough"],
        members={"day_type": ["Weekday"], "service_period": ["PM Peak"], "mode": ["bus"]})


@query("trip_runs", """
    select agency_id, mode, count(distinct (fact_agency, service_date, trip_id)) as trip_runs
    from wide group by all""")
def _trip_runs(spark, sf_dir):
    return _cube(spark, sf_dir).query("trip_runs", levels=["mode"])


@query("window_service_days",
       "select count(distinct service_date) as window_service_days from facts")
def _window_service_days(spark, sf_dir):
    return cubes.window_service_days(_facts(spark, sf_dir))


# --- realtime -------------------------------------------------------------


@query("realtime_match", f"""
    select agency_id, service_date::varchar as service_date, trip_id, stop_id, match_status,
      case when match_status = 'matched' then {oracle.stamp('arr')} end as scheduled_arrival,
      {oracle.stamp('actual')} as actual_arrival from matched""")
def _realtime_match(spark, sf_dir):
    calls, parts = _by_match_key(spark, sf_dir)
    matched = rt.match_calls(calls, _messages(spark, sf_dir), fx.agencies(spark, sf_dir), parts)
    return matched.select("agency_id", "service_date", "trip_id", "stop_id", "match_status",
                          "scheduled_arrival", "actual_arrival")


@query("stop_events", f"""
    select service_date::varchar as service_date, agency_id, trip_id,
      stop_sequence::bigint as stop_sequence, {oracle.stamp('actual')} as actual_arrival,
      delay_seconds::bigint::varchar as delay_seconds,
      schedule_relationship, is_cancelled::bigint::varchar as is_cancelled, vehicle_id
    from stop_ev""")
def _stop_events_query(spark, sf_dir):
    return _filled(spark, sf_dir).select(
        "service_date", "agency_id", "trip_id", "stop_sequence", "actual_arrival",
        text("delay_seconds"), "schedule_relationship",
        F.col("is_cancelled").cast("int").cast("string").alias("is_cancelled"), "vehicle_id")


@query("delay_measurable", """
    select route_key, schedule_relationship, count(*) as events,
      count(*) filter (schedule_relationship = 'SCHEDULED' and not is_cancelled
        and delay_seconds is not null) as measured from observed group by all""")
def _delay_measurable(spark, sf_dir):
    events = rt.usable(fx.observed(spark, sf_dir))
    return events.groupBy("route_key", "schedule_relationship").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("measured").alias("measured"))


_M = "schedule_relationship = 'SCHEDULED' and not is_cancelled and delay_seconds is not null"
_DELAYS = f"""count(*) filter ({_M}) as measured_stops,
      round(avg(delay_seconds) filter ({_M}), 4) as mean_delay_seconds,
      round(quantile_cont(delay_seconds, 0.5) filter ({_M}), 4) as p50_delay_seconds,
      round(quantile_cont(delay_seconds, 0.9) filter ({_M}), 4) as p90_delay_seconds,
      round(quantile_cont(delay_seconds, 0.99) filter ({_M}), 4) as p99_delay_seconds"""
_WIDE = """stop_ev e left join stops_d s on s.stop_key = e.stop_key
      left join calendar_d c on c.service_date = e.service_date"""
_MEASURED_WIDE = f"{_WIDE} where {_M}"


# Cells without a measured delay stay, with nulls, as do the routes nobody defines.
@query("delay_percentiles", f"""
    select coalesce(borough, 'Unknown') as borough, {_DELAYS} from {_WIDE}
      where service_period = 'PM Peak' and day_type = 'Weekday' group by all""")
def _delay_percentiles(spark, sf_dir):
    return _delay_cube(spark, sf_dir).query(
        "measured_stops", "mean_delay_seconds", "p50_delay_seconds", "p90_delay_seconds",
        "p99_delay_seconds", levels=["borough"],
        members={"service_period": ["PM Peak"], "day_type": ["Weekday"]})


@query("on_time", f"""
    select coalesce(r.agency_id, 'Unknown') as agency_id, coalesce(mode, 'Unknown') as mode,
      coalesce(display_name, 'Unknown') as display_name, count(*) filter ({_M}) as measured_stops,
      round(avg((abs(delay_seconds) <= 300)::integer) filter ({_M}), 4) as on_time_share
    from stop_ev e left join routes_d r on r.route_key = e.route_key group by all""")
def _on_time(spark, sf_dir):
    return _delay_cube(spark, sf_dir).query(
        "measured_stops", "on_time_share", levels=["display_name"])


@query("adherence", f"""
    select service_period, round(avg(greatest(0.0::double, 1 - abs(delay_seconds) / 600.0::double)),
      4) as adherence_score from {_MEASURED_WIDE} group by all""")
def _adherence(spark, sf_dir):
    return _delay_cube(spark, sf_dir).query("adherence_score", levels=["service_period"])


_HEADWAY = """select o.*, (second - lag(second) over (
      partition by service_date, route_key, stop_key, direction_id
      order by second, event_id)) as headway from observed o"""


@query("headway", f"""
    select event_id, service_date::varchar as service_date, route_key, stop_key,
      headway::bigint::varchar as headway_seconds from ({_HEADWAY})""")
def _headway(spark, sf_dir):
    return rt.with_headway(fx.observed(spark, sf_dir)).select(
        "event_id", "service_date", "route_key", "stop_key", text("headway_seconds"))


@query("headway_regularity", f"""
    select route_key, count(headway) as gaps, round(stddev_samp(headway), 4)
      as headway_deviation_seconds from ({_HEADWAY}) group by all""")
def _headway_regularity(spark, sf_dir):
    gaps = rt.with_headway(fx.observed(spark, sf_dir))
    return gaps.groupBy("route_key").agg(
        F.count("headway_seconds").alias("gaps"),
        F.stddev_samp("headway_seconds").alias("headway_deviation_seconds"))


@query("cube_headway", """
    select service_period, round(stddev_samp(gap), 4) as headway_deviation_seconds from (
      select service_period, actual - lag(actual) over (partition by service_date, route_key,
        stop_key, direction_id order by actual) as gap from stop_ev where actual is not null)
    group by all""")
def _cube_headway(spark, sf_dir):
    return _delay_cube(spark, sf_dir, headways=True).query(
        "headway_deviation_seconds", levels=["service_period"])


def _rolling_sql(key: str, size: str) -> str:
    length, slide = rt.ROLLING[size]
    return f"""
    select {key}, {oracle.stamp('w')} as window_start, {oracle.stamp(f'w + {length}')} as window_end,
      count(*) as events, count(delay) as measured_events,
      coalesce(round(avg(delay), 4)::varchar, '-') as mean_delay,
      coalesce(round(avg((abs(delay) <= 300)::integer), 4)::varchar, '-') as on_time_share,
      quantile_disc(delay, 0.5)::bigint::varchar as p50_delay,
      quantile_disc(delay, 0.9)::bigint::varchar as p90_delay,
      quantile_disc(delay, 0.99)::bigint::varchar as p99_delay
    from (select {key}, case when schedule_relationship = 'SCHEDULED' then delay_seconds end
        as delay, unnest(generate_series((second // {slide}) * {slide} - {length - slide},
          (second // {slide}) * {slide}, {slide})) as w from observed) group by all"""


def _shown_windows(windows: DataFrame) -> DataFrame:
    shown = {c: text(c) for c in ("p50_delay", "p90_delay", "p99_delay")}
    for name in ("mean_delay", "on_time_share"):
        shown[name] = F.coalesce(F.round(name, 4).cast("string"), F.lit("-"))
    return windows.withColumns(shown)


def _rolling(key: str, size: str) -> Query:
    return lambda spark, sf_dir: _shown_windows(
        rt.rolling(fx.observed(spark, sf_dir), key, size))


for _size in rt.ROLLING:
    query(f"rolling_windows_{_size}", _rolling_sql("route_key", _size))(
        _rolling("route_key", _size))
    query(f"rolling_windows_stop_{_size}", _rolling_sql("stop_key", _size))(
        _rolling("stop_key", _size))

_WINDOWS_24H = """
    select route_key, w, count(delay) as n, avg(delay) as mean from (
      select route_key, case when schedule_relationship = 'SCHEDULED' then delay_seconds end
        as delay, unnest(generate_series((second // 3600) * 3600 - 82800,
          (second // 3600) * 3600, 3600)) as w from observed) group by all"""
_BASELINE = """
    select route_key, (isodow(ts) - 1)::bigint as day_of_week, hour(ts)::bigint as hour,
      avg(delay_seconds) as baseline, count(*) as n from measured group by all"""


@query("baseline", f"""
    select route_key, day_of_week, hour, round(baseline, 4) as baseline_delay,
      n as baseline_events from ({_BASELINE})""")
def _baseline(spark, sf_dir):
    return rt.delay_baseline(fx.observed(spark, sf_dir))


# The test data has few events per slot, so this query passes lower limits than the
# defaults of 120 seconds and 20 observations.
@query("anomalies", f"""
    select route_key, {oracle.stamp('w')} as window_start, {oracle.stamp('w + 86400')}
      as window_end, x.n as measured_events, round(mean, 4) as mean_delay,
      round(baseline, 4) as baseline_delay, round(mean - baseline, 4) as excess_delay
    from (select *, (isodow(to_timestamp(w) at time zone 'UTC') - 1)::bigint as day_of_week,
        hour(to_timestamp(w) at time zone 'UTC')::bigint as hour from ({_WINDOWS_24H})) x
    join ({_BASELINE}) b using (route_key, day_of_week, hour)
    where x.n >= 5 and mean - baseline > 60""")
def _anomalies(spark, sf_dir):
    events = fx.observed(spark, sf_dir)
    windows = rt.rolling(events, "route_key", "24h", percentiles=False)
    return rt.anomalies(windows, rt.delay_baseline(events), threshold=60, observations=5)


@query("current_stats", f"""
    select route_key, {oracle.stamp('max(w)')} as window_start, max_by(n, w) as events from (
      select route_key, w, count(*) as n from (select route_key,
        unnest(generate_series((second // 300) * 300 - 3300, (second // 300) * 300, 300)) as w
        from observed) group by all) group by all""")
def _current_stats(spark, sf_dir):
    windows = rt.rolling(fx.observed(spark, sf_dir), "route_key", "1h")
    return rt.current_stats(windows, "route_key").select("route_key", "window_start", "events")


@query("poll_diff", """
    select vehicle, service_date::varchar as service_date,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as polled_at, zone::bigint as zone,
      schedule_relationship from (
      select *, row_number() over w as rn, lag(zone) over w as z0,
        lag(schedule_relationship) over w as r0
      from (select distinct vehicle, service_date, ts, zone, schedule_relationship from poll)
      window w as (partition by vehicle, service_date order by ts, zone, schedule_relationship))
    where rn = 1 or zone is distinct from z0 or schedule_relationship is distinct from r0""")
def _poll_diff(spark, sf_dir):
    return rt.changed_between_polls(
        _polls(spark, sf_dir), ["vehicle", "service_date"], ["zone", "schedule_relationship"])


@query("stale_feeds", """
    select vehicle, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as polled_at,
      (second - header_us // 1000000)::bigint as age_seconds
    from poll where epoch_us(ts) - header_us > 300000000""")
def _stale_feeds(spark, sf_dir):
    return rt.stale_polls(_polls(spark, sf_dir)).select("vehicle", "polled_at", "age_seconds")


@query("scenario_delay", f"""
    select scenario, borough, count(*) filter (counts) as measured_stops,
      round(quantile_cont(delay, 0.9) filter (counts), 4) as p90_delay_seconds from (
      select scenario, coalesce(borough, 'Unknown') as borough, coalesce({_M}, false) as counts,
        delay_seconds + case when scenario = 'relief' and service_period = 'PM Peak'
          and e.agency_id in ('AMERICA', 'EUROPE') then -60 else 0 end as delay
      from stop_ev e left join stops_d s on s.stop_key = e.stop_key,
        (values ('base'), ('relief')) v(scenario)) group by all""")
def _scenario_delay(spark, sf_dir):
    cube = _delay_cube(spark, sf_dir)
    agencies = fx.agencies(spark, sf_dir).where("stop_id_direction_suffix")
    overrides = agencies.select(
        F.lit("relief").alias("scenario"), "agency_id",
        F.lit("PM Peak").alias("service_period"), F.lit(-60).alias("delay_change"))
    return cube.scenarios(
        overrides, ["relief"], ["agency_id", "service_period"], "measured_stops", "p90_delay_seconds",
        levels=["borough"])


# --- streaming ------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    return fx.as_events(live.file_stream(spark, sf_dir, schema, "events.parquet"))


def _observed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observed_calls(_event_stream(spark, sf_dir))


def _live_windows(spark: SparkSession, sf_dir: str, key: str, size: str) -> DataFrame:
    return live_windows.rolling_streams(_observed_stream(spark, sf_dir), key, StreamSettings())[size]


def _stream_windows(key: str, size: str) -> Query:
    return lambda spark, sf_dir: _shown_windows(live.run_available(
        _live_windows(spark, sf_dir, key, size), "update", [key, "window_start"]))


for _size in rt.ROLLING:
    query(f"stream_windows_{_size}", _rolling_sql("route_key", _size))(
        _stream_windows("route_key", _size))
    query(f"stream_windows_stop_{_size}", _rolling_sql("stop_key", _size))(
        _stream_windows("stop_key", _size))


@query("stream_window_flush", f"""
    select * from ({_rolling_sql("route_key", "5m")}) where window_end <= (
      select strftime(max(ts) - interval 10 minute, '%Y-%m-%d %H:%M:%S') from observed)""")
def _stream_window_flush(spark, sf_dir):
    """Windows that the watermark has closed, appended to a folder and read back."""
    root = f"{shared_dir(spark)}/flush-{uuid.uuid4().hex}"
    windows = _live_windows(spark, sf_dir, "route_key", "5m")
    live.flush_windows(windows, f"{root}/table", f"{root}/checkpoint", None).awaitTermination()
    return _shown_windows(spark.read.schema(windows.schema).parquet(f"{root}/table"))


@query("stream_alert_messages", f"""
    select route_key as key, window_start, measured_events::varchar as measured_events
    from ({ORACLE["anomalies"]})""")
def _stream_alert_messages(spark, sf_dir):
    """Alerts as the alert topic's messages, with two fields of the body read again."""
    windows = _live_windows(spark, sf_dir, "route_key", "24h")
    baseline = rt.delay_baseline(fx.observed(spark, sf_dir))
    alerts = live_windows.anomaly_stream(windows, baseline, threshold=60, observations=5)
    sent = live_windows.alert_messages(alerts).withColumn(
        "window_start", F.get_json_object("value", "$.window_start"))
    latest = live.run_available(sent, "update", ["key", "window_start"])
    return latest.select(
        "key", F.to_timestamp("window_start").alias("window_start"),
        F.get_json_object("value", "$.measured_events").alias("measured_events"))


@query("stream_health_messages", f"""
    select vehicle::varchar as key, age_seconds::varchar as age_seconds
    from ({ORACLE["stale_feeds"]})""")
def _stream_health_messages(spark, sf_dir):
    stale = live_windows.health_stream(fx.polls(_event_stream(spark, sf_dir)))
    sent = live.run_available(live_windows.health_messages(stale, "vehicle"), "append")
    return sent.select("key", F.get_json_object("value", "$.age_seconds").alias("age_seconds"))


@query("stream_anomalies", ORACLE["anomalies"])
def _stream_anomalies(spark, sf_dir):
    windows = live_windows.rolling_stream(_observed_stream(spark, sf_dir), "route_key", "24h")
    baseline = rt.delay_baseline(fx.observed(spark, sf_dir))
    alerts = live_windows.anomaly_stream(windows, baseline, threshold=60, observations=5)
    return live.run_available(alerts, "update", ["route_key", "window_start"])


@query("stream_distinct_events", "select event_id, route_key from observed")
def _stream_distinct_events(spark, sf_dir):
    twice = _observed_stream(spark, sf_dir).unionByName(_observed_stream(spark, sf_dir))
    return live.run_available(
        live_windows.distinct_events(twice), "append").select("event_id", "route_key")


# These run over several batches, in order of arrival: some events come over an hour after
# their time.  Each slice is a query of its own on one checkpoint; a heartbeat closes the feed.
_SLICES = 3


def _replayed(spark: SparkSession, sf_dir: str, build, **options):
    sent = fx.sent_events(spark, sf_dir)
    return replay(sent, lambda raw: build(fx.as_events(raw)), _SLICES, closing=fx.closing_event(sent), **options)


@query("stream_poll_diff", ORACLE["poll_diff"])
def _stream_poll_diff(spark, sf_dir):
    changed, _ = _replayed(spark, sf_dir, lambda events: stateful.poll_diff_stream(
        fx.polls(events), ["vehicle", "service_date"], ["zone", "schedule_relationship"], watermark=fx.LONGEST_WAY))
    return changed.drop("batch")


@query("stream_headway", f"""
    select event_id, headway::bigint::varchar as headway_seconds from ({_HEADWAY})""")
def _stream_headway(spark, sf_dir):
    gaps, _ = _replayed(spark, sf_dir, lambda events: stateful.headway_stream(
        fx.observed_calls(events), watermark=fx.LONGEST_WAY))
    return gaps.select("event_id", text("headway_seconds"))


_LATE = "floor(value * 10) >= 600"


@query("stream_late_rows", f"""
    select lpad(event_id::varchar, 16, '0') as event_id,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as actual_arrival,
      floor(value * 10)::bigint as seconds_late, count(*) over () as counted
    from events where {_LATE}""")
def _stream_late_rows(spark, sf_dir):
    """Rows too late for a watermark of ten minutes, set aside, with their number as observed."""
    def build(events: DataFrame) -> DataFrame:
        calls = fx.observed_calls(events, "received_at").where(F.col("event_id").isNotNull())
        return late_rows.counted_late(calls, "actual_arrival", "received_at", 600)

    found, reports = _replayed(
        spark, sf_dir, build, sink=lambda root: BatchFolders(root, {"late": F.col("is_late")}))
    way = F.unix_seconds("received_at") - F.unix_seconds("actual_arrival")
    return found.where("part = 'late'").select(
        "event_id", "actual_arrival", way.alias("seconds_late"),
        F.lit(late_rows.observed_total(reports, "late", "late_rows")).cast("long").alias("counted"))


def _on_time_sql(key: str, size: str) -> str:
    late = f"(select lpad(event_id::varchar, 16, '0') from events where {_LATE})"
    return _rolling_sql(key, size).replace(" from observed)", f" from observed where event_id not in {late})")


@query("stream_windows_without_late", _on_time_sql("route_key", "1h"))
def _stream_windows_without_late(spark, sf_dir):
    """Windows over several batches: what is late is left out, all the rest is in."""
    def build(events: DataFrame) -> DataFrame:
        calls = fx.observed_calls(events, "received_at")
        in_time = late_rows.counted_late(calls, "actual_arrival", "received_at", 600).where(
            ~F.col("is_late") & F.col("event_id").isNotNull())
        return live_windows.rolling_stream(in_time, "route_key", "1h", StreamSettings().watermark)

    found, _ = _replayed(spark, sf_dir, build, mode="update")
    return _shown_windows(live.newest(found, ["route_key", "window_start"]))


def _sketched(key: str, size: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found, _ = _replayed(spark, sf_dir, lambda events: live_windows.sketched_stream(
            fx.observed_calls(events), key, size, fx.LONGEST_WAY))
        return _shown_windows(found.drop("batch"))

    return run


# Panes of up to SKETCH_K delays are kept whole, so here the percentiles are exact.
for _key in ("route_key", "stop_key"):
    for _size in ("1h", "24h"):
        query(f"stream_sketched_{_key.removesuffix('_key')}_{_size}", _rolling_sql(_key, _size))(_sketched(_key, _size))


@query("stream_current_stats", ORACLE["current_stats"])
def _stream_current_stats(spark, sf_dir):
    """The newest window of every route, as a table kept by the batches."""
    found, _ = _replayed(
        spark, sf_dir, lambda events: live_windows.rolling_stream(
            fx.observed_calls(events).where(F.col("event_id").isNotNull()), "route_key", "1h", fx.LONGEST_WAY),
        mode="update", sink=live_windows.current_table)
    return found.select("route_key", "window_start", "events")


@query("stream_realtime_match", ORACLE["realtime_match"])
def _stream_realtime_match(spark, sf_dir):
    """Updates matched batch by batch; of each the newest is kept."""
    facts, agencies = _facts(spark, sf_dir), fx.agencies(spark, sf_dir)
    found, _ = _replayed(
        spark, sf_dir, lambda events: fx.updates_of(events, spark, sf_dir, facts),
        sink=lambda root: matching.matched_table(root, facts, agencies, by=8))
    return found.select("agency_id", "service_date", "trip_id", "stop_id", "match_status",
                        "scheduled_arrival", "actual_arrival")


_BROKEN, _UNKNOWN = "event_id % 17 = 3", "event_id % 19 = 4"


@query("stream_sorted_messages", f"""
    select lpad(event_id::varchar, 16, '0') as event_id,
      case when {_BROKEN} or {_UNKNOWN} then 'malformed'
        when event_type in ('click', 'view') and value is not null then 'rest' else 'unmeasured' end as part,
      case when not ({_BROKEN} or {_UNKNOWN}) and event_type in ('click', 'view')
        then trunc(value * 6 - 120)::bigint::varchar end as delay_seconds
    from events""")
def _stream_sorted_messages(spark, sf_dir):
    """Messages, some broken or of an unknown kind: set aside, kept unaveraged, or measured."""
    def build(events: DataFrame) -> DataFrame:
        calls = fx.observed_calls(events).where(F.col("event_id").isNotNull())
        value = F.col("value")
        sent = live.render_stop_events(calls).withColumn(
            "number", F.get_json_object("value", "$.event_id").cast("long"))
        lost = F.regexp_replace(value, '"schedule_relationship":("[A-Z]*"|null)', '"schedule_relationship":"LOST"')
        cut = F.substr(value, F.lit(1), F.length(value) - 5)
        number = F.col("number")
        return live.parse_stop_events(sent.select(
            F.when(number % 17 == 3, cut).when(number % 19 == 4, lost).otherwise(value).alias("value")))

    found, _ = _replayed(spark, sf_dir, build, sink=live.sorted_out)
    told = F.regexp_extract("malformed", '"event_id":"([0-9]+)"', 1)
    return found.select(
        F.coalesce("event_id", told).alias("event_id"), "part",
        F.when(F.col("part") == "rest", F.col("delay_seconds")).cast("string").alias("delay_seconds"))


@query("stream_health", ORACLE["stale_feeds"])
def _stream_health(spark, sf_dir):
    stale = live_windows.health_stream(fx.polls(_event_stream(spark, sf_dir)))
    return live.run_available(stale, "append").select("vehicle", "polled_at", "age_seconds")


@query("stream_wire", """
    select event_id, service_date::varchar as service_date, route_key, direction_id::varchar
      as direction_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as actual_arrival,
      delay_seconds::varchar as delay_seconds, schedule_relationship, 0::bigint as malformed
    from observed""")
def _stream_wire(spark, sf_dir):
    """Rendered to the wire format and parsed again on the stream."""
    messages = live.render_stop_events(_observed_stream(spark, sf_dir)).select("value")
    parsed = live.parse_stop_events(messages).select(
        "event_id", "service_date", "route_key", text("direction_id"), "actual_arrival",
        text("delay_seconds"), "schedule_relationship",
        F.col("malformed").isNotNull().alias("malformed"))
    return live.run_available(parsed, "append")
