"""Calls with their dates as arrays say what the facts say, and are matched as the facts are."""

from __future__ import annotations

import datetime as dt

import small_feed
from pyspark.sql import functions as F

from tramloom.operators import realtime as rt
from tramloom.operators import schedule
from tramloom.operators.calendar import expand_calendar

# A Sunday on which New York's clocks are put forward, and days before it.
DATES = [(small_feed.A, "SVC", d, 1) for d in ("20260303", "20260304", "20260307", "20260308")]
TIMES = [(small_feed.A, t, s, n, c, "") for t in ("A1_T1", "A2_T2") for n, (s, c) in enumerate(
    [("101", "01:30:00"), ("102", "02:30:00"), ("103", "26:10:00"), ("104", "24:59:59")])]


def built(spark):
    known = small_feed.agencies(spark)
    trips = [(small_feed.A, t, "1", "SVC", None, 0) for t in ("A1_T1", "A2_T2")]
    feed = small_feed.feed(spark, trips=trips, stop_times=TIMES, calendar_dates=DATES)
    services = schedule.service_days(expand_calendar(feed.calendar, feed.calendar_dates), known)
    return feed, known, services, schedule.calls_by_service(feed, services)


def test_spans_say_what_the_facts_say(spark):
    feed, known, services, calls = built(spark)
    names = ["trip_id", "stop_key", "route_key", "stop_sequence", "local_hour", "service_period", "overnight", "dwell_seconds"]
    spans = schedule.span_rows(schedule.dated(calls, services))
    assert max(r.n for r in spans.select(F.size("dates").alias("n")).collect()) > 1
    found = spans.select(F.explode("dates").alias("service_date"), *names)
    facts = schedule.resolve_schedule(feed, known).select("service_date", *names)
    assert sorted(map(str, found.collect())) == sorted(map(str, facts.collect()))


def test_calls_are_filled_as_facts_are(spark):
    feed, known, services, calls = built(spark)
    updates = spark.createDataFrame(
        [(small_feed.A, dt.date(2026, 3, day), trip, "101N", dt.datetime(2026, 3, day, 15), dt.datetime(2026, 3, day, 7, late),
          "SCHEDULED", False, str(late)) for day, trip, late in ((7, "RT_T1", 3), (8, "RT_T1", 4), (8, "RT_T2", 9), (12, "RT_T1", 5))],
        "agency_id string, service_date date, trip_id string, stop_id string, polled_at timestamp, actual_arrival timestamp, "
        "schedule_relationship string, is_cancelled boolean, vehicle_id string")
    laid = schedule.dated(rt.with_match_keys(calls, known, realtime=False).repartition(2, "agency_id", "match_trip"), services)
    seen = rt.observed_by_call(laid, updates, known, 2)
    own = rt.filled_calls(laid, seen)
    plainly = rt.stop_events(schedule.resolve_schedule(feed, known), updates, known)
    assert own.where("vehicle_id is not null").count() == 3
    assert sorted(map(str, own.collect())) == sorted(map(str, plainly.select(own.columns).collect()))
