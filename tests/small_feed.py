"""Literal feeds for the tests."""

from __future__ import annotations

from tramloom import schemas as sc
from tramloom.sources.feed import Feed

COLUMNS = {
    "agency": "agency_id string, stated_agency_id string, agency_name string, "
              "agency_timezone string",
    "routes": "agency_id string, route_id string, route_type int, stated_agency_id string, "
              "route_short_name string, route_long_name string, route_color string",
    "stops": "agency_id string, stop_id string, stop_name string, stop_lat double, "
             "stop_lon double, location_type int, parent_station string",
    "trips": "agency_id string, trip_id string, route_id string, service_id string, "
             "trip_headsign string, direction_id int",
    "stop_times": "agency_id string, trip_id string, stop_id string, stop_sequence int, "
                  "arrival_time string, departure_time string",
    "calendar": "agency_id string, service_id string, monday int, tuesday int, wednesday int, "
                "thursday int, friday int, saturday int, sunday int, start_date string, "
                "end_date string",
    "calendar_dates": "agency_id string, service_id string, date string, exception_type int",
}
A = "MTA_NYCT"
ROWS = {
    "agency": [(A, "A", "Test", "America/New_York")],
    "routes": [(A, "1", 1, "A", "1", None, None)],
    "stops": [(A, "101N", "First", 40.9, -73.9, 0, "101"), (A, "101", "First", 40.9, -73.9, 1, None)],
    "trips": [(A, "T1", "1", "SVC", None, 0)],
    "stop_times": [(A, "T1", "101N", 1, "06:00:00", "06:00:30")],
    "calendar": [],
    "calendar_dates": [(A, "SVC", d, 1) for d in ("20260401", "20260402", "20260403")],
}
AGENCIES = [(A, "Subway", "subway", "America/New_York", "nyct_suffix", True)]


def feed(spark, **changed) -> Feed:
    rows = {**ROWS, **changed}
    return Feed(**{n: spark.createDataFrame(rows[n], COLUMNS[n]) for n in COLUMNS})


def agencies(spark):
    from tramloom.sources.registry import AGENCIES as schema

    return spark.createDataFrame(AGENCIES, schema)


def column(df, *names):
    return sorted(tuple(row[n] for n in names) for row in df.collect())


__all__ = ["A", "ROWS", "agencies", "column", "feed", "sc"]
