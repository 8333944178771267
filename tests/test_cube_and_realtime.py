"""Golden cube of three rows, matching, headway ties, polygons, settings and the wire contract."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tramloom import schemas as sc
from tramloom.errors import SettingsError
from tramloom.operators import cube, dimensions, geography
from tramloom.operators import realtime as rt
from tramloom.streaming import events as live
from tramloom.streaming.settings import StreamSettings, Topics

UTC = dt.timezone.utc
AGENCIES = "agency_id string, trip_id_match string, stop_id_direction_suffix boolean"


def facts(spark):
    """(date, event id, arrival, hour, period, past midnight, trip, dwell)"""
    given = [
        (dt.date(2026, 5, 26), "a", dt.datetime(2026, 5, 26, 10, 0, tzinfo=UTC), 6, "AM Peak", False, "T1", 30),
        (dt.date(2026, 5, 26), "b", dt.datetime(2026, 5, 27, 5, 30, tzinfo=UTC), 1, "Overnight", True, "T1", 30),
        (dt.date(2026, 5, 27), "c", dt.datetime(2026, 5, 27, 21, 0, tzinfo=UTC), 17, "PM Peak", False, "T2", 60),
    ]
    rows = [(d, e, "MTA_NYCT", "1", "MTA_NYCT:1", trip, "101N", "MTA_NYCT:101N", i + 1, 0, at, at, dwell, past, hour,
             period, int(past)) for i, (d, e, at, hour, period, past, trip, dwell) in enumerate(given)]
    schema = "service_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sc.FACT_KEYS.fields)
    frame = spark.createDataFrame(rows, schema)
    for field in sc.REALTIME_COLUMNS.fields:
        frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    return frame


def test_cube_of_three_rows(spark):
    routes = spark.createDataFrame(
        [("MTA_NYCT:1", "1", "MTA_NYCT", "subway", 1, "1", None, "1", None)], sc.ROUTES)
    stops = spark.createDataFrame([
        ("MTA_NYCT:101", "101", "MTA_NYCT", "Van", 40.9, -73.9, True, None, "MTA_NYCT:101", "Bronx", "New York"),
        ("MTA_NYCT:101N", "101N", "MTA_NYCT", "Van", 40.9, -73.9, False, "MTA_NYCT:101", "MTA_NYCT:101", "Bronx",
         "New York")], sc.STOPS)
    own = facts(spark)
    calendar = dimensions.calendar_dimension(own, spark.createDataFrame([], "holiday date"))
    tables = cube.Dimensions.of(routes, stops, calendar)
    total = cube.cube_query(own, tables, ["scheduled_stops", "scheduled_trips", "service_days",
                                          "trips_per_service_day", "mean_dwell_seconds", "overnight_stops"]).first()
    assert (total.scheduled_stops, total.scheduled_trips, total.service_days) == (3, 2, 2)
    assert (total.trips_per_service_day, total.mean_dwell_seconds, total.overnight_stops) == (1.0, 40.0, 1)
    by_hour = cube.cube_query(own, tables, ["scheduled_stops"], levels=["local_hour"]).collect()
    assert sorted((r.local_hour, r.scheduled_stops) for r in by_hour) == [(1, 1), (6, 1), (17, 1)]
    by_borough = cube.cube_query(own, tables, ["scheduled_stops"], levels=["borough"]).collect()
    assert [(r.borough, r.scheduled_stops) for r in by_borough] == [("Bronx", 3)]


@pytest.mark.parametrize("levels", [[], ["local_hour"], ["display_name", "service_period"]])
def test_scenarios_as_differences_equal_copied_facts(spark, levels):
    rng = random.Random(8)
    one = facts(spark)
    many = one.crossJoin(spark.createDataFrame([
        (i, f"R{rng.randrange(4)}", rng.choice([None, *range(-90, 900, 30)]), rng.choice(["SCHEDULED", "ADDED", None]))
        for i in range(120)], "i int, route string, late int, kind string")).withColumns({
            "route_key": F.concat(F.lit("MTA_NYCT:"), "route"), "delay_seconds": F.col("late"),
            "schedule_relationship": F.col("kind"), "is_cancelled": F.col("i") % 11 == 0,
            "trip_id": F.concat("trip_id", F.col("i") % 17)}).select(*one.columns)
    routes = spark.createDataFrame(
        [(f"MTA_NYCT:R{i}", f"R{i}", "MTA_NYCT", "subway", 1, f"{i}", None, f"{i}", None) for i in range(3)], sc.ROUTES)
    tables = cube.Dimensions.of(routes, spark.createDataFrame([], sc.STOPS),
                                dimensions.calendar_dimension(one, spark.createDataFrame([], "holiday date")))
    overrides = spark.createDataFrame(
        [("relief", "MTA_NYCT:R0", "AM Peak", -60), ("relief", "MTA_NYCT:R1", "AM Peak", 45),
         ("storm", "MTA_NYCT:R3", "PM Peak", 600), ("unasked", "MTA_NYCT:R0", "PM Peak", 1)],
        "scenario string, route_key string, service_period string, delay_change int")
    on, asked = ["route_key", "service_period"], ["relief", "storm", "nothing"]
    measures = ["scheduled_stops", "scheduled_trips", "measured_stops", "mean_delay_seconds", "p50_delay_seconds",
                "p99_delay_seconds", "on_time_share", "adherence_score", "mean_dwell_seconds"]
    found = cube.cube_scenarios(many, tables, overrides, asked, on, measures, levels)
    copied = rt.scenario_facts(many, overrides.where("scenario != 'unasked'"), asked, on)
    expected = cube.cube_query(copied, tables, measures, levels, by=["scenario"])

    def shown(frame):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                       for r in frame.select("scenario", *expected.columns[1:]).collect()), key=repr)

    assert shown(found) == shown(expected)
    assert {r.scenario for r in found.collect()} == {"base", *asked}


def test_matching_guesses_nothing(spark):
    day = dt.date(2026, 5, 26)
    agencies = spark.createDataFrame([("MTA_NYCT", "nyct_suffix", True)], AGENCIES)
    at = dt.datetime(2026, 5, 26, 10, 0, 5, tzinfo=UTC)
    own = facts(spark).withColumns({
        "trip_id": F.element_at(F.array(F.lit("A_X1"), F.lit("B_X1"), F.lit("C_X2")), F.col("stop_sequence")),
        "stop_id": F.lit("101"), "service_date": F.lit(day)})
    updates = spark.createDataFrame(
        [("MTA_NYCT", day, t, "101N", at, at, "SCHEDULED", False, "v") for t in ("R_X1", "R_X2", "R_X3")],
        "agency_id string, service_date date, trip_id string, stop_id string, polled_at timestamp, "
        "actual_arrival timestamp, schedule_relationship string, is_cancelled boolean, vehicle_id string")
    found = {r.trip_id: (r.match_status, r.event_id) for r in rt.match_updates(own, updates, agencies).collect()}
    assert found == {"R_X1": ("ambiguous", None), "R_X2": ("matched", "c"), "R_X3": ("unmatched", None)}
    filled = {r.event_id: (r.delay_seconds, r.headway_seconds, r.vehicle_id)
              for r in rt.stop_events(own, updates, agencies).collect()}
    late = int((at - dt.datetime(2026, 5, 27, 21, 0, tzinfo=UTC)).total_seconds())
    assert filled == {"a": (None, None, None), "b": (None, None, None), "c": (late, None, "v")}


def test_headway_of_ties_and_unstated_directions(spark):
    rows = [("a", 10, None), ("b", 10, None), ("c", 40, None), ("d", 41, 0), ("e", None, None), ("f", 100, None)]
    frame = spark.createDataFrame(rows, "event_id string, at long, direction_id int").withColumns({
        "actual_arrival": F.timestamp_seconds("at"), "service_date": F.lit(dt.date(2026, 1, 1)),
        "route_key": F.lit("r"), "stop_key": F.lit("s")})
    found = {r.event_id: r.headway_seconds for r in rt.with_headway(frame).collect()}
    assert found == {"a": None, "b": 0, "c": 30, "d": None, "e": None, "f": 60}


def test_points_in_a_ring_with_a_notch(spark):
    corners = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in corners])
    points = spark.createDataFrame([(0.5, 2.0), (2.0, 2.0), (2.0, 0.5), (3.8, 3.0), (5.0, 1.0)], "x double, y double")
    found = points.select(geography.inside(F.col("x"), F.col("y"), ring).alias("i")).collect()
    assert [r.i for r in found] == [True, False, True, True, False]


def test_stream_settings_are_checked():
    for bad in ({"windows": ()}, {"on_time_threshold_seconds": 0}, {"anomaly_min_observations": -1},
                {"watermark": " "}, {"long_watermark": ""}):
        with pytest.raises(SettingsError):
            StreamSettings(**bad)
    with pytest.raises(SettingsError):
        Topics(alerts=" ")


def test_a_message_has_all_fields_and_bad_ones_are_kept(spark):
    few = facts(spark).select("service_date", "event_id", "route_key", "scheduled_arrival")
    message = json.loads(live.render_stop_events(few).first()["value"])
    assert list(message) == sc.STOP_EVENT.names and len(message) == 23
    assert message["vehicle_id"] is None
    whole = live.render_stop_events(facts(spark)).select("value").union(spark.createDataFrame(
        [("{not json",), ('{"event_id": "z", "schedule_relationship": "NEVER"}',)], "value string"))
    parsed = live.parse_stop_events(whole).collect()
    assert sorted(r.event_id for r in parsed if r.malformed is None) == ["a", "b", "c"]
    assert sum(r.malformed is not None for r in parsed) == 2
