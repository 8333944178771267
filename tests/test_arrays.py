"""Updates that meet calls as arrays fill the facts as updates a row a date do, however odd they are."""

from __future__ import annotations

import datetime as dt
import random

import pytest
import small_feed
from pyspark.sql import functions as F

from tramloom.functions import keys
from tramloom.operators import cube as cubes
from tramloom.operators import realtime as rt
from tramloom.operators import schedule
from tramloom.operators.calendar import expand_calendar

A = small_feed.A
DATES = [(A, service, f"202603{day:02d}", 1) for service, days in (("S1", (3, 4, 7, 8)), ("S2", (9, 10)), ("S3", (8, 9)))
         for day in days]
# One trip runs by two services, one calls twice at a stop, two share a suffix, a call has no number.
TRIPS = [(A, t, r, s, None, d) for t, r, s, d in (
    ("A1_T1", "1", "S1", 0), ("A1_T1", "2", "S2", 0), ("A2_T1", "1", "S3", 1), ("A1_T2", "1", "S1", 0), ("A1_T3", "1", "S1", None), ("A1_T4", "1", "S1", 0))]
TIMES = [(A, t, s, n, c, "") for t, s, n, c in (
    ("A1_T1", "101", 1, "06:00:00"), ("A1_T1", "102", 2, "23:59:59"), ("A1_T1", "103", 2, "24:10:00"), ("A2_T1", "101", 1, "06:00:00"),
    ("A1_T2", "101", 1, "06:00:00"), ("A1_T2", "101", 2, "06:30:00"), ("A1_T2", "102", 3, "06:40:00"), ("A1_T2", "104", None, "06:50:00"),
    ("A1_T3", "102", 1, "06:41:00"), ("A1_T3", "103", 2, "07:00:00"), ("A1_T3", "104", 3, "07:05:00"),
    ("A1_T4", "101", 1, "06:10:00"), ("A1_T4", "102", 2, "06:45:00"))]
SCHEMA = ("agency_id string, trip_id string, stop_id string, polled_at timestamp, schedule_relationship string, "
          "is_cancelled boolean, vehicle_id string, days array<struct<service_date: date, actual_arrival: timestamp>>")


def messages(spark, count: int):
    rng = random.Random(4)
    rows = []
    for n in range(count):
        days = sorted(rng.sample((3, 4, 7, 8, 9, 10, 12), rng.randrange(0, 5)))
        days = (3, 4, 7, 8) if n % 3 == 0 else days * (2 if n % 11 == 0 else 1)
        rows.append((A, f"RT_{rng.choice(('T1', 'T2', 'T3', 'T4', 'T9'))}" + ("_T3" if n % 5 == 0 else ""), f"10{rng.randrange(1, 5)}{rng.choice('NS')}",
                     dt.datetime(2026, 3, 3, 9, rng.randrange(4)), rng.choice(("SCHEDULED", "ADDED", None)), rng.choice((False, True, None)),
                     str(n % 7), [(dt.date(2026, 3, day), rng.choice((None, dt.datetime(2026, 3, day, 12, rng.randrange(3), 1, 5)))) for day in days]))
    return spark.createDataFrame(rows, SCHEMA)


def built(spark):
    known = small_feed.agencies(spark)
    feed = small_feed.feed(spark, trips=TRIPS, stop_times=TIMES, calendar_dates=DATES)
    services = schedule.service_days(expand_calendar(feed.calendar, feed.calendar_dates), known)
    calls = schedule.calls_by_service(feed, services)
    laid = schedule.dated(rt.with_match_keys(calls, known, realtime=False).repartition(2, "agency_id", "match_trip"), services)
    return feed, known, laid


def test_odd_messages_fill_calls_as_updates_fill_facts(spark):
    feed, known, laid = built(spark)
    facts = schedule.resolve_schedule(feed, known)
    for count in (3, 60):
        sent = messages(spark, count)
        updates = sent.select("*", F.inline("days")).select(
            "agency_id", "service_date", "trip_id", "stop_id", "polled_at", "actual_arrival", "schedule_relationship",
            "is_cancelled", "vehicle_id")
        own = rt.filled_calls(laid, rt.observed_by_call(laid, sent, known, 2))
        plainly = rt.stop_events(facts, updates, known).select(own.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, plainly.collect()))
    assert {r.headway_seconds is None for r in own.where("actual_arrival is not null").collect()} == {True, False}


def test_calls_and_updates_stay_arrays_until_they_are_facts(spark):
    _, known, laid = built(spark)
    seen = rt.observed_by_call(laid, messages(spark, 9), known, 2, headways=False)
    text = seen._jdf.queryExecution().executedPlan().toString()
    assert "posexplode(dates" not in text and "SortAggregate" not in text
    filled = rt.filled_calls(laid, seen)._jdf.queryExecution().executedPlan().toString()
    assert filled.count("posexplode(dates") == 1


def test_headways_take_one_row_a_message_there_and_back(spark):
    _, known, laid = built(spark)
    found = rt.observed_by_call(laid, messages(spark, 9), known, 2, headways=False)
    text = rt.with_gaps(found, 2)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in text
    above, _, below = text.partition("Window")
    assert below and not [line for line in below.split("posexplode(days")[0].splitlines() if "Exchange" in line]


def test_ids_of_few_rows_are_the_same_ids(spark):
    rows = [("A", dt.date(2026, 3, 7), "T_1"), ("Å€", dt.date(1969, 1, 1), ""), (None, None, None)]
    frame = spark.createDataFrame(rows, "a string, d date, t string")
    own = frame.select(keys.plain_id_prefix(F.col("a"), F.col("d"), F.col("t")).alias("one"),
                       keys.id_prefix(F.col("a"), F.col("d"), F.col("t")).alias("other"))
    assert all(r.one == r.other for r in own.collect())


@pytest.mark.parametrize("members", [None, {"service_period": ["AM Peak", "Unknown"]}])
def test_versions_of_a_fact_are_put_together_once_an_override(spark, monkeypatch, members):
    rows = [(f"R{i % 3}", (None, "AM Peak", "PM Peak")[i % 4 % 3], 60 * (i % 5) if i % 7 else None, "SCHEDULED" if i % 6 else None,
             i % 4 == 0, i % 9 if i % 8 else None) for i in range(2000)]
    facts = spark.createDataFrame(
        rows, "route_key string, service_period string, delay_seconds int, schedule_relationship string, is_cancelled boolean, "
        "dwell_seconds int")
    overrides = spark.createDataFrame([("relief", "R1", "PM Peak", -60), ("relief", "R2", "AM Peak", 45)],
                                      "scenario string, route_key string, service_period string, delay_change int")
    measures = ["measured_stops", "p90_delay_seconds", "mean_delay_seconds", "scheduled_stops", "mean_dwell_seconds"]
    on = ["route_key", "service_period"]
    given, prepare = [], cubes._prepare
    monkeypatch.setattr(cubes, "_prepare", lambda rows, *more: given.append(rows) or prepare(rows, *more))
    found = cubes.cube_scenarios(facts, cubes.Dimensions(None, None, None), overrides, ["relief"], on, measures,
                                 ["service_period"], members)
    made = given[0]._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "inline(" in made and "lambda" not in made
    copied = rt.scenario_facts(facts, overrides, ["relief"], on)
    expected = cubes.cube_query(copied, cubes.Dimensions(None, None, None), measures, ["service_period"], members, by=["scenario"])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(found.columns).collect()))


def test_days_of_a_cell_are_shuffled_as_words_and_trips_once(spark):
    rng = random.Random(5)
    rows = [(dt.date(1996, 3, 1) + dt.timedelta(days=rng.choice((-9700, 0, 1, 2, 40, 63, 64, 65, 700))) if i % 13 else None,
             rng.choice((None, "A:1", "A:2", "A:3", "A:4")), rng.choice((None, "A:1", "B:2")), rng.choice((None, "t1", "t2", "t3")), i % 3)
            for i in range(300)]
    facts = spark.createDataFrame(
        rows, "service_date date, stop_key string, route_key string, trip_id string, dwell_seconds int")
    stops = spark.createDataFrame([(f"A:{i}", f"B{i // 3}", f"M{i // 3}", f"S{i // 2}", str(i)) for i in range(1, 4)],
                                  "stop_key string, borough string, municipality string, station_name string, stop_id string")
    dims = cubes.Dimensions(None, stops, None)
    spans = facts.withColumns({"dates": F.array("service_date")})
    spread = cubes.Spread(facts, lambda column: facts.repartition(3, column), spans, 3)
    measures = ["scheduled_stops", "service_days", "routes_served", "scheduled_trips", "stops_served", "mean_dwell_seconds"]
    result = cubes.cube_rollup(spread, dims, measures, ["Geography"])
    cells: dict = {}
    for day, stop, route, trip, dwell in rows:
        i = int(stop[2:]) if stop and stop != "A:4" else None
        path = ("Unknown",) * 4 if i is None else (f"B{i // 3}", f"M{i // 3}", f"S{i // 2}", str(i))
        for depth in range(5):
            cell = cells.setdefault((*path[:depth], *[None] * (4 - depth), 2 ** (4 - depth) - 1), ([], set(), set(), set(), set()))
            for held, value in zip(cell, (dwell, day, route, trip, stop), strict=True):
                held.append(value) if isinstance(held, list) else held.update({value} - {None})
    found = {(r.borough, r.municipality, r.station_name, r.stop_id, r.level_mask): (
        r.scheduled_stops, r.service_days, r.routes_served, r.scheduled_trips, r.stops_served, round(r.mean_dwell_seconds, 9))
        for r in result.collect()}
    assert found == {k: (len(v[0]), *map(len, v[1:]), round(sum(v[0]) / len(v[0]), 9)) for k, v in cells.items()}
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in text and not [line for line in text.splitlines() if "Exchange" in line and "_at#" in line and "level_mask" in line]
    dated = cubes.cube_query(facts, dims, ["service_days", "scheduled_stops"], ["stop_id"]).collect()
    assert {r.stop_id: r.service_days for r in dated} == {k[3]: len(v[1]) for k, v in cells.items() if not k[4]}
