"""Resolving timetable calls into scheduled events.

Shape of the plan: trips meet their service's dates as arrays, trips and stop times are
shuffled once on the trip id at their unexpanded size, and a call becomes a row for each
of its dates last, with no exchange after it.  What needs the facts in another order
shuffles the calls before they are expanded.  A trip that holds a large share of the stop
times is split by the adaptive skew join, since nothing above it relies on its partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom import schemas as sc
from tramloom.functions import clock, keys
from tramloom.operators.calendar import Window, active_dates, expand_calendar
from tramloom.sources.feed import Feed


def timed_calls(stop_times: DataFrame) -> DataFrame:
    """Stop times with clock seconds and a state: ok, absent or malformed.

    A missing arrival takes the departure and the other way round.  One unreadable
    cell makes the whole row malformed.
    """
    key = ["agency_id", "trip_id", "stop_id", "stop_sequence"]
    cells = stop_times.select(
        *key,
        clock.clock_code(F.col("arrival_time")).alias("arrives"),
        clock.clock_code(F.col("departure_time")).alias("departs"),
    )
    arrives, departs = F.col("arrives"), F.col("departs")
    state = (
        F.when(F.least(arrives, departs) == clock.MALFORMED_CODE, clock.MALFORMED)
        .when(F.greatest(arrives, departs) == clock.ABSENT_CODE, clock.ABSENT)
        .otherwise(clock.OK)
    )
    return cells.select(
        *key, state.alias("state"),
        F.when(arrives >= 0, arrives).otherwise(departs).alias("arrival"),
        F.when(departs >= 0, departs).otherwise(arrives).alias("departure"),
    )


def _utc_start(date: Column) -> Column:
    return F.unix_date(date).cast("bigint") * clock.DAY_SECONDS


def trip_runs(
    feed: Feed, service_dates: DataFrame, agencies: DataFrame, zones: Iterable[str] = ()
) -> DataFrame:
    """One row per trip, with all dates it runs on as arrays.

    What does not depend on the call is worked out here or before: ``starts`` says where each of
    ``dates`` starts in the agency's zone, as seconds from its start in UTC, once a service;
    ``prefixes`` has the event id of each up to its stop sequence, once a trip.  The calendar's longest range bounds the arrays.
    """
    trips = feed.trips.select("agency_id", "service_id", "trip_id", "route_id", "direction_id")
    days = service_days(service_dates, agencies, zones).drop("spans")
    return trips.join(days, ["agency_id", "service_id"]).drop("service_id")


def _steady(start: Column, zone: Column, zones: Iterable[str]) -> Column:
    """Whether the zone's offset is one and the same at every hour a clock can name from ``start`` on."""
    def offset(hour: Column) -> Column:
        instant = start + hour * 3600
        local = clock.by_zone(zone, zones, lambda z: F.from_utc_timestamp(F.timestamp_seconds(instant), z))
        return F.unix_seconds(local) - instant

    return F.size(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(clock.CLOCK_HOURS)), offset))) == 1


def service_days(service_dates: DataFrame, agencies: DataFrame, zones: Iterable[str] = ()) -> DataFrame:
    """One row per service: its ``dates``, where each ``starts``, and both again as ``spans``, with the dates as ``words``.

    A clock time falls into the same local hour on all dates of a span: all dates on which the
    zone keeps its offset are one (``steady``), every other date is one of its own.
    """
    date = F.col("service_date")
    begins = clock.day_start(date, F.col("timezone"), zones)
    start = (begins - _utc_start(date)).cast("int").alias("start")
    # No trip can name a service without an id.
    own = service_dates.where(F.col("service_id").isNotNull()).join(
        agencies.select("agency_id", "timezone"), "agency_id")
    steady = own.select("timezone", "service_date").distinct().select(
        "timezone", "service_date", F.coalesce(_steady(begins, F.col("timezone"), zones), F.lit(False)).alias("steady"))
    # A zone's dates are few, its services' dates are many.
    own = own.join(F.broadcast(steady), ["timezone", "service_date"], "left").withColumn(
        "steady", F.coalesce("steady", F.lit(False)))
    days = own.groupBy("agency_id", "service_id", "timezone").agg(F.sort_array(F.collect_list(F.struct("service_date", start, "steady"))).alias("days"))

    def span(days: Column, steady: bool) -> Column:
        dates = days.getField("service_date")
        return F.struct(dates.alias("dates"), days.getField("start").alias("starts"), F.lit(steady).alias("steady"),
                        clock.day_words(dates).alias("words"))

    even = F.filter("days", lambda d: d.getField("steady"))
    odd = F.transform(F.filter("days", lambda d: ~d.getField("steady")), lambda d: span(F.array(d), False))
    spans = F.concat(F.when(F.size(even) > 0, F.array(span(even, True))).otherwise(F.slice(F.array(span(even, True)), 1, 0)), odd)
    return days.select(
        "agency_id", "service_id", "timezone", F.col("days.service_date").alias("dates"),
        F.col("days.start").alias("starts"), spans.alias("spans"))


_CLOCK_END = clock.CLOCK_HOURS * 3600


def calls_by_service(feed: Feed, services: DataFrame, agencies: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """Every usable call of every trip that runs, once, with its service instead of the dates.

    With ``parts``, trips and stop times meet where their trip's match key by the rule of
    ``agencies`` lies, so that the calls need not be shuffled again for the match.
    """
    known = services.where(F.col("timezone").isNotNull()).select("agency_id", "service_id")
    runs = feed.trips.select("agency_id", "service_id", "trip_id", "route_id", "direction_id").join(
        F.broadcast(known), ["agency_id", "service_id"], "left_semi")
    calls = timed_calls(feed.stop_times)
    same = ["agency_id", "trip_id"]
    # Both clocks of a usable call in one number; an unusable one has none.
    both = F.when(F.col("state") == clock.OK, F.col("arrival").cast("bigint") * _CLOCK_END + F.col("departure"))
    calls = calls.select("agency_id", "trip_id", "stop_id", "stop_sequence", both.alias("clocks"))
    if parts:
        # Where a rule is stated twice, either will do to lie together.
        rules = agencies.groupBy("agency_id").agg(F.min("trip_id_match").alias("rule"))
        runs, calls = (rows.join(F.broadcast(rules), "agency_id", "left").withColumn(
            "laid", keys.trip_match_key(F.col("trip_id"), F.col("rule"))).drop("rule").repartition(
            parts, "agency_id", "laid") for rows in (runs, calls))
        same.append("laid")
    # As in ``scheduled_calls``, the test stays in the join.
    usable = F.when(F.col("clocks").isNotNull(), F.col("run.service_id")).isNotNull()
    same_trip = reduce(Column.__and__, [F.col(f"call.{c}") == F.col(f"run.{c}") for c in same])
    found = calls.alias("call").join(runs.alias("run"), same_trip & usable)
    return found.select(
        *[F.col(f"call.{c}") for c in ("agency_id", "trip_id", "stop_id", "stop_sequence")],
        F.floor(F.col("clocks") / _CLOCK_END).cast("int").alias("arrival"),
        (F.col("clocks") % _CLOCK_END).cast("int").alias("departure"),
        *[F.col(f"run.{c}") for c in ("service_id", "route_id", "direction_id")])


def dated(calls: DataFrame, services: DataFrame) -> DataFrame:
    """Calls by service with the service's dates.  Services are few in any network, so they are sent to the calls."""
    return calls.join(F.broadcast(services.where(F.col("timezone").isNotNull())), ["agency_id", "service_id"])


def span_rows(calls: DataFrame, zones: Iterable[str] = ()) -> DataFrame:
    """``dated`` calls, a row for each span: what a fact row says, once for all of the span's ``dates`` (and ``words``)."""
    rows = calls.drop("dates", "starts").select("*", F.inline("spans")).drop("spans")
    instant = clock.at_clock(_utc_start(F.get("dates", F.lit(0))) + F.get("starts", F.lit(0)), F.col("arrival"))
    hour = F.when(F.col("steady"), (F.floor(F.col("arrival") / 3600) % 24).cast("int")).otherwise(
        clock.local_hour(instant, F.col("timezone"), zones))
    rows = rows.withColumn("local_hour", hour)
    crosses = clock.rolls_over(F.col("arrival"))
    return rows.select(
        "dates", "words", "agency_id", "route_id", keys.namespaced(F.col("agency_id"), F.col("route_id")).alias("route_key"),
        "trip_id", "stop_id", keys.namespaced(F.col("agency_id"), F.col("stop_id")).alias("stop_key"),
        "stop_sequence", F.col("direction_id").cast("int").alias("direction_id"),
        F.greatest(F.col("departure") - F.col("arrival"), F.lit(0)).cast("int").alias("dwell_seconds"),
        crosses.alias("crosses_midnight"), crosses.cast("int").alias("overnight"), "local_hour",
        clock.service_period(F.col("local_hour")).alias("service_period"))


def scheduled_calls(
    feed: Feed, agencies: DataFrame, window: Window | None = None, zones: Iterable[str] = ()
) -> DataFrame:
    """Every usable call of every trip that runs, once, with the dates it runs on as arrays.

    ``zones`` may list the time zones to expect; it only makes the job faster.
    """
    service_dates = expand_calendar(feed.calendar, feed.calendar_dates, window)
    runs = trip_runs(feed, service_dates, agencies, zones).repartition("agency_id", "trip_id")
    runs = runs.withColumn(
        "prefixes", keys.id_prefixes(F.col("agency_id"), F.col("dates"), F.col("trip_id"))).alias("run")
    calls = timed_calls(feed.stop_times).alias("call")

    # The state test names a column of each side, so it stays in the join.  As a plain
    # filter it would be pushed to the scan with the whole parse copied into it, and
    # every clock text would be parsed twice.
    usable = F.when(F.col("state") == clock.OK, F.col("timezone")).isNotNull()
    same_trip = (F.col("call.agency_id") == F.col("run.agency_id")) & (
        F.col("call.trip_id") == F.col("run.trip_id")
    )
    return calls.join(runs, same_trip & usable).drop(
        F.col("run.agency_id"), F.col("run.trip_id"), "state")


def with_stop_key(calls: DataFrame) -> DataFrame:
    return calls.withColumn("stop_key", keys.namespaced(F.col("agency_id"), F.col("stop_id")))


def fact_rows(
    calls: DataFrame, zones: Iterable[str] = (), carried: tuple[str, ...] = (), each: tuple[str, ...] = (),
) -> DataFrame:
    """The fact rows of ``scheduled_calls``, one for each call and date, with the columns ``carried`` along.

    ``each`` names arrays with an element for each date, of which a fact row gets its own.
    """
    if "prefixes" not in calls.columns:
        calls = calls.withColumn(
            "prefixes", keys.id_prefixes(F.col("agency_id"), F.col("dates"), F.col("trip_id")))
    if "stop_key" not in calls.columns:
        calls = with_stop_key(calls)
    facts = calls.select("*", F.posexplode("dates").alias("nth", "service_date")).withColumns(
        {"day_start": _utc_start(F.col("service_date")) + F.get("starts", "nth"), "id_prefix": F.get("prefixes", "nth")})
    start = F.col("day_start")
    facts = facts.withColumns({
        **{c: F.get(c, "nth") for c in each},
        "scheduled_arrival": clock.at_clock(start, F.col("arrival")),
        "scheduled_departure": clock.at_clock(start, F.col("departure")),
    })
    facts = facts.withColumn(
        "local_hour", clock.local_hour(F.col("scheduled_arrival"), F.col("timezone"), zones)
    )
    crosses = clock.rolls_over(F.col("arrival"))
    facts = keys.with_event_id(facts, "id_prefix", "stop_sequence").withColumns({
        "route_key": keys.namespaced(F.col("agency_id"), F.col("route_id")),
        "dwell_seconds": F.greatest(F.col("departure") - F.col("arrival"), F.lit(0)),
        "crosses_midnight": crosses,
        "overnight": crosses.cast("int"),
        "service_period": clock.service_period(F.col("local_hour")),
    })
    return sc.conform(facts, sc.FACTS, "service_date", *carried, *each)


def resolve_schedule(
    feed: Feed, agencies: DataFrame, window: Window | None = None, zones: Iterable[str] = ()
) -> DataFrame:
    """Every scheduled call of every trip on every date it runs, as fact rows."""
    return fact_rows(scheduled_calls(feed, agencies, window, zones), zones)


_COUNTS = ("events", "untimed_stop_times", "malformed_times", "crossing_midnight")


def resolution_stats(feed: Feed, window: Window | None = None) -> DataFrame:
    """Per agency and active date: what resolving it yields and drops.

    Counted per trip, then per service, and only then spread over the dates, so no
    call is expanded.  Dates on which nothing runs to completion stay, with zeros.
    """
    service_dates = expand_calendar(feed.calendar, feed.calendar_dates, window)
    state, ok = F.col("state"), F.col("state") == clock.OK
    per_trip = timed_calls(feed.stop_times).groupBy("agency_id", "trip_id").agg(
        F.count_if(ok).alias("events"),
        F.count_if(state == clock.ABSENT).alias("untimed_stop_times"),
        F.count_if(state == clock.MALFORMED).alias("malformed_times"),
        F.count_if(ok & clock.rolls_over(F.col("arrival"))).alias("crossing_midnight"),
    )
    per_service = (
        feed.trips.select("agency_id", "trip_id", "service_id")
        .join(per_trip, ["agency_id", "trip_id"])
        .groupBy("agency_id", "service_id")
        .agg(F.count(F.lit(1)).alias("trips"), *[F.sum(c).alias(c) for c in _COUNTS])
    )
    measures = ("trips", *_COUNTS)
    return (
        service_dates.join(per_service, ["agency_id", "service_id"], "left")
        .groupBy("agency_id", "service_date")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in measures])
    )


def build_summary(feed: Feed, window: Window | None = None) -> DataFrame:
    """One row per agency over all dates of the window."""
    stats = resolution_stats(feed, window)
    measures = ("trips", *_COUNTS)
    per_agency = stats.groupBy("agency_id").agg(
        F.count_if(F.col("events") > 0).alias("dates_written"),
        F.count_if(F.col("events") == 0).alias("dates_empty"),
        *[F.sum(c).alias(c) for c in measures],
        F.min("service_date").alias("first_date"),
        F.max("service_date").alias("last_date"),
    )
    sizes = [
        table.groupBy("agency_id").agg(F.count(F.lit(1)).alias(name))
        for name, table in (("routes", feed.routes), ("stops", feed.stops))
    ]
    agencies = sizes[0].join(sizes[1], "agency_id", "full")
    summary = agencies.join(per_agency, "agency_id", "full")
    counts = ("dates_written", "dates_empty", *measures, "routes", "stops")
    return summary.select(
        "agency_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        "first_date",
        "last_date",
    )


def feed_profile(feed: Feed) -> DataFrame:
    """Row counts, services, coverage and the share of calls past 24:00 per agency."""
    counted = [
        getattr(feed, name).groupBy("agency_id").agg(F.count(F.lit(1)).alias("n"))
        .select("agency_id", F.lit(name).alias("item"), "n")
        for name in ("routes", "stops", "trips", "calendar", "calendar_dates")
    ]
    past = clock.rolls_over(clock.clock_seconds(F.col("arrival_time")))
    calls = feed.stop_times.groupBy("agency_id").agg(
        F.count(F.lit(1)).alias("stop_times"), F.count_if(past).alias("past_midnight")
    )
    counted.append(
        calls.select(
            "agency_id",
            F.explode(F.create_map(
                F.lit("stop_times"), "stop_times", F.lit("past_midnight"), "past_midnight"
            )).alias("item", "n"),
        )
    )
    added = feed.calendar_dates.where(F.col("exception_type") == 1)
    services = feed.calendar.select("agency_id", "service_id").unionByName(
        added.select("agency_id", "service_id")
    ).distinct()
    counted.append(
        services.groupBy("agency_id").agg(F.count(F.lit(1)).alias("n"))
        .select("agency_id", F.lit("services").alias("item"), "n")
    )
    counts = counted[0]
    for part in counted[1:]:
        counts = counts.unionByName(part)

    items = ("routes", "stops", "trips", "stop_times", "calendar", "calendar_dates",
             "services", "past_midnight")
    wide = counts.groupBy("agency_id").agg(*[
        F.coalesce(F.sum(F.when(F.col("item") == i, F.col("n"))), F.lit(0)).alias(i)
        for i in items
    ])
    dates = active_dates(expand_calendar(feed.calendar, feed.calendar_dates))
    covered = dates.groupBy("agency_id").agg(
        F.count(F.lit(1)).alias("active_dates"),
        F.min("service_date").alias("first_date"),
        F.max("service_date").alias("last_date"),
    )
    share = 100.0 * F.col("past_midnight") / F.greatest(F.col("stop_times"), F.lit(1))
    return wide.join(covered, "agency_id", "left").select(
        "agency_id", *items,
        F.coalesce("active_dates", F.lit(0)).cast("bigint").alias("active_dates"),
        "first_date", "last_date", share.alias("past_midnight_percent"),
    )
