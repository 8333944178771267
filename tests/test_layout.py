"""Calls become a row a date after the last shuffle, and large values are counted where they lie."""

from __future__ import annotations

from itertools import combinations

import small_feed
from pyspark.sql import functions as F

from tramloom.operators import cube as cubes
from tramloom.operators import realtime as rt
from tramloom.operators import schedule

DAYS = ("20260401", "20260402", "20260403")
TIMES = [(small_feed.A, "A1_T1", f"{100 + n}", n, f"{6 + 5 * n:02d}:00:00", "") for n in range(4)] + [
    (small_feed.A, "A2_T2", "101", 9, "23:30:00", "23:31:00")]


def agencies(spark):
    return spark.createDataFrame(
        small_feed.AGENCIES, "agency_id string, agency_name string, mode string, timezone string, "
        "trip_id_match string, stop_id_direction_suffix boolean")


def feed(spark):
    trips = [(small_feed.A, t, "1", "SVC", None, 0) for t in ("A1_T1", "A2_T2")]
    return small_feed.feed(spark, trips=trips, stop_times=TIMES)


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_calls_are_shuffled_before_they_become_a_row_a_date(spark):
    facts = schedule.resolve_schedule(feed(spark), agencies(spark))
    above, _, below = facts._jdf.queryExecution().executedPlan().toString().partition("posexplode")
    assert below and "Exchange" not in above
    assert facts.count() == len(DAYS) * len(TIMES)


def test_an_event_id_is_asked_for_before_it_is_hashed(spark):
    facts = schedule.resolve_schedule(feed(spark), agencies(spark))
    assert "EvalPython" not in plan(facts.groupBy("service_period").count())
    assert "EvalPython" in plan(facts.select("event_id"))


def test_distinct_counts_of_every_level_equal_sets(spark):
    rows = [(f"2026-0{1 + i % 2}-1{i % 3}", "A" if i % 5 else "B", f"t{i % 4}" if i % 7 else None, f"s{i % 6}", i % 3)
            for i in range(40)]
    facts = spark.createDataFrame(
        rows, "d string, agency_id string, trip_id string, stop_key string, hour int").select(
        F.to_date("d").alias("service_date"), "agency_id", "trip_id", "stop_key",
        F.concat(F.lit("p"), F.col("hour")).alias("service_period"), F.lit("A:1").alias("route_key"))
    calendar = facts.select("service_date").distinct().withColumns(
        {"year": F.year("service_date"), "month": F.month("service_date")})
    dims = cubes.Dimensions(None, None, calendar)
    asked = []
    spread = cubes.Spread(facts, lambda column: asked.append(column) or facts.repartition(3, column))
    result = cubes.cube_rollup(
        spread, dims, ["scheduled_trips", "stops_served", "trip_runs"], ["Calendar", "Service Period"])
    found = {(str(r.service_date) if r.service_date else None, r.month, r.year, r.service_period, r.level_mask):
             (r.scheduled_trips, r.stops_served, r.trip_runs) for r in result.collect()}
    assert set(asked) == {"trip_id", "stop_key"}
    cells: dict = {}
    for d, agency, trip, stop, hour in rows:
        for depth in range(4):
            for period in (f"p{hour}", None):
                key = (d if depth == 3 else None, int(d[5:7]) if depth > 1 else None, 2026 if depth else None, period,
                       sum(8 >> i for i in range(depth, 3)) + (period is None))
                cell = cells.setdefault(key, (set(), set(), set()))
                cell[0].update({trip} - {None})
                cell[1].add(stop)
                cell[2].add((agency, d, trip))
    assert found == {k: tuple(map(len, v)) for k, v in cells.items()}
    assert cubes.cube_query(spread, dims, ["scheduled_trips"], ["month"]).count() == 2


def test_facts_by_match_key_are_not_shuffled_for_the_match(spark):
    known = agencies(spark)
    calls = schedule.scheduled_calls(feed(spark), known).drop("prefixes")
    laid = rt.with_match_keys(calls, known, realtime=False).repartition(2, "agency_id", "match_trip")
    facts = schedule.fact_rows(laid, carried=("match_trip", "match_stop"))
    updates = spark.createDataFrame(
        [(small_feed.A, "2026-04-01", "RT_x_T1", "101N", "2026-04-01 15:00:00", "2026-04-01 15:01:00", "SCHEDULED", False, "7"),
         (small_feed.A, "2026-04-02", "RT_x_T9", "101N", "2026-04-02 15:00:00", None, None, False, "8")],
        "agency_id string, d string, trip_id string, stop_id string, p string, a string, schedule_relationship string, "
        "is_cancelled boolean, vehicle_id string").select(
        "agency_id", F.to_date("d").alias("service_date"), "trip_id", "stop_id", F.to_timestamp("p").alias("polled_at"),
        F.to_timestamp("a").alias("actual_arrival"), "schedule_relationship", "is_cancelled", "vehicle_id")
    own = rt.stop_events(facts, updates, known, parts=2)
    lean = own.drop("headway_seconds", "event_id")
    assert "EvalPython" not in plan(lean)
    plainly = rt.stop_events(schedule.resolve_schedule(feed(spark), known), updates, known)
    assert sorted(map(str, own.collect())) == sorted(map(str, plainly.collect()))
    assert own.where("vehicle_id = '7'").count() == 1
