import datetime as dt
import zipfile
from pathlib import Path

import pytest
from small_feed import A, ROWS, agencies, column, feed

from tramloom.errors import FeedError, IntegrityError, RegistryError, WindowError
from tramloom.operators import calendar as cal
from tramloom.operators import dimensions as dims
from tramloom.operators import schedule, validate
from tramloom.plans.build import build_dataset, open_cube
from tramloom.sources import dataset
from tramloom.sources.feed import read_feed
from tramloom.sources.registry import Registry, Agency, load_registry

CSV = {
    "agency.txt": "agency_id,agency_name,agency_timezone\nA,Test,America/New_York\n",
    "routes.txt": "﻿route_id, route_long_name,route_type\n1,Branch,2\n",
    "stops.txt": '"stop_id","stop_name","stop_lat","stop_lon","note"\n"1","A, B","40.5",,"x"\n2\n',
    "trips.txt": "trip_id,route_id,service_id\nT1,1,S\n",
    "stop_times.txt": "trip_id,stop_id,stop_sequence,arrival_time,departure_time\n"
                      "T1,1,1,06:00:00,\nT1,2,2,25:30:00,25:31:00\n",
    "calendar_dates.txt": "service_id,date,exception_type\nS,20260401,1\n",
}


def write(folder, files, archive):
    if archive:
        path = folder / "feed.zip"
        with zipfile.ZipFile(path, "w") as out:
            for name, text in files.items():
                out.writestr(f"nested/{name.upper()}", text)
        return str(path)
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("archive", [True, False])
def test_read_feed(spark, tmp_path, archive):
    read = read_feed(spark, write(tmp_path, CSV, archive), "X")
    assert column(read.routes, "agency_id", "route_id", "route_long_name") == [("X", "1", "Branch")]
    stops = {r.stop_id: r for r in read.stops.collect()}
    assert stops["1"].stop_name == "A, B" and stops["1"].stop_lat == 40.5
    assert not stops["1"].stop_lon and stops["2"].stop_name is None
    assert read.calendar.count() == 0
    assert schedule.feed_profile(read).head().past_midnight == 1


@pytest.mark.parametrize("archive", [True, False])
def test_bad_feeds(spark, tmp_path, archive):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir(), (tmp_path / "c").mkdir()
    missing = {k: v for k, v in CSV.items() if k != "trips.txt"}
    with pytest.raises(FeedError, match="trips.txt"):
        read_feed(spark, write(tmp_path / "a", missing, archive), "X")
    no_service = {k: v for k, v in CSV.items() if k != "calendar_dates.txt"}
    with pytest.raises(FeedError, match="calendar"):
        read_feed(spark, write(tmp_path / "b", no_service, archive), "X")
    bad = {**CSV, "stops.txt": "stop_id,stop_lat\n1,40\n2,north\n"}
    with pytest.raises(Exception, match="bad stop_lat north"):
        read_feed(spark, write(tmp_path / "c", bad, archive), "X").stops.collect()


def week(service, flags, start, end):
    return (A, service, *[int(c) for c in flags], start, end)


def days(spark, calendar=(), dates=(), window=None):
    f = feed(spark, calendar=list(calendar), calendar_dates=[(A, *d) for d in dates])
    found = cal.expand_calendar(f.calendar, f.calendar_dates, window)
    return [str(r[0]) for r in column(found, "service_date")]


def test_calendar_shapes(spark):
    weekdays = week("S", "1111100", "20260302", "20260315")
    assert len(days(spark, [weekdays])) == 10
    clipped = (dt.date(2026, 3, 4), dt.date(2026, 3, 9))
    assert len(days(spark, [weekdays], window=clipped)) == 4
    both = days(spark, [week("S", "1111100", "20260302", "20260306")],
                [("S", "20260307", 1), ("S", "20260302", 2), ("GONE", "20260302", 2)])
    assert both == [f"2026-03-0{d}" for d in range(3, 8)]
    for order in ([1, 2], [2, 1]):
        assert days(spark, dates=[("S", "20260307", k) for k in order]) == []
    assert days(spark, [week("S", "1111111", "20260306", "20260302")]) == []


@pytest.mark.parametrize("calendar, dates, message", [
    ([week("S", "1111111", "20200101", "20260101")], [], "implausible"),
    ([week("S", "1111111", "2020-01-01", "20260101")], [], "bad date in calendar.txt"),
    ([], [("S", "20260101", 3)], "exception_type"), ([], [("S", "x", 1)], "calendar_dates.txt")])
def test_calendar_errors(spark, calendar, dates, message):
    with pytest.raises(Exception, match=message):
        days(spark, calendar, dates)


def test_shared_window(spark):
    d = dt.date
    rows = [("S", d(2026, 5, 20)), ("S", d(2026, 8, 10)), ("M", d(2026, 7, 10)),
            ("M", d(2026, 9, 1)), ("L", d(2026, 7, 25)), ("L", d(2026, 12, 1))]
    dates = spark.createDataFrame(
        [(a, "x", day) for a, day in rows], "agency_id string, service_id string, service_date date")
    names = ["S", "M", "L"]
    assert cal.shared_window(dates, names) == (d(2026, 7, 25), d(2026, 8, 10))
    assert cal.shared_window(dates, names, days=7)[1] == d(2026, 7, 31)
    assert cal.shared_window(dates, names, days=60)[1] == d(2026, 8, 10)
    assert cal.shared_window(dates, names, start=d(2026, 8, 1)) == (d(2026, 8, 1), d(2026, 8, 10))
    for bad in ({"days": 0}, {"start": d(2026, 8, 2), "end": d(2026, 8, 1)},
                {"start": d(2026, 9, 9)}):
        with pytest.raises(WindowError):
            cal.shared_window(dates, names, **bad)
    with pytest.raises(WindowError):
        cal.shared_window(dates, [*names, "NONE"])


def test_resolution(spark):
    times = [(A, "T1", "101N", 2, "25:30:00", "25:30:00"), (A, "T1", "101N", 1, "06:00:00", "05:59:00"),
             (A, "T1", "101", 3, "", "07:00:00"), (A, "T1", "101", 4, "", ""),
             (A, "T1", "101", 5, "8:5", "08:06:00")]
    f = feed(spark, stop_times=times)
    facts = schedule.resolve_schedule(f, agencies(spark), zones=["America/New_York"])
    first = {r.stop_sequence: r for r in facts.where("service_date = '2026-04-01'").collect()}
    assert set(first) == {1, 2, 3} and facts.count() == 9
    assert str(first[1].scheduled_arrival) == "2026-04-01 10:00:00" and first[1].dwell_seconds == 0
    assert first[2].crosses_midnight and first[2].local_hour == 1
    assert first[2].service_period == "Overnight" and first[2].overnight == 1
    assert first[3].scheduled_arrival == first[3].scheduled_departure
    assert first[1].delay_seconds is None and first[1].route_key == f"{A}:1"
    summary = schedule.build_summary(f).head()
    assert (summary.events, summary.trips, summary.crossing_midnight) == (9, 3, 3)
    assert (summary.untimed_stop_times, summary.malformed_times) == (3, 3)
    idle = schedule.build_summary(feed(spark, stop_times=[])).head()
    assert (idle.dates_written, idle.dates_empty, idle.routes, idle.stops) == (0, 3, 1, 2)


def test_violations(spark):
    assert validate.violations(feed(spark)).count() == 0
    bad = [(A, "T1", "nowhere", n, "06:00:00", "") for n in range(5000)]
    found = validate.violations(feed(spark, stop_times=bad)).collect()
    assert [(r.value, r.occurrences) for r in found] == [("nowhere", 5000)]
    twice = feed(spark, trips=ROWS["trips"] * 2)
    assert validate.violations(twice).head().references == "a unique key"
    unnamed = feed(spark, agency=[(A, None, "Test", "UTC")])
    assert validate.violations(unnamed).count() == 0
    orphan = feed(spark, trips=[(A, "T1", "9", "NONE", None, None)])
    assert column(validate.violations(orphan), "field") == [("route_id",), ("service_id",)]


def test_build_and_open(spark, tmp_path):
    root, f, registry = str(tmp_path), feed(spark), agencies(spark)
    for _ in range(2):
        build_dataset(f, registry, root)
    cube = open_cube(spark, root, registry)
    assert cube.facts.count() == 3
    assert dataset.load_facts(spark, root, [dt.date(2026, 4, 2)]).count() == 1
    row = cube.query("scheduled_stops", "scheduled_trips", levels=["station_name"]).head()
    assert (row.station_name, row.scheduled_stops, row.scheduled_trips) == ("First", 3, 1)
    other = registry.where("agency_id = 'none'")
    with pytest.raises(RegistryError):
        dataset.load_facts(spark, root, agencies=other)
    broken = feed(spark, trips=[(A, "T1", "9", "SVC", None, None)])
    with pytest.raises(IntegrityError):
        build_dataset(broken, registry, root)


def test_dimensions(spark):
    f = feed(spark)
    stops = {r.stop_id: r for r in dims.with_station_names(dims.stop_dimension(f)).collect()}
    assert stops["101N"].station_key == f"{A}:101" and stops["101"].is_station
    assert stops["101N"].borough == "Unknown"
    dates = spark.createDataFrame([(dt.date(2026, 7, 4),), (dt.date(2026, 5, 30),)],
                                  "service_date date")
    calendar = dims.calendar_dimension(dates, dims.holiday_frame(spark))
    assert column(calendar, "day_type", "day_of_week") == [("Holiday", 5), ("Weekend", 5)]
    with pytest.raises(Exception, match="2031"):
        late = spark.createDataFrame([(dt.date(2031, 1, 1),)], "service_date date")
        dims.require_holiday_years(late, dims.holiday_frame(spark))


def test_registry(tmp_path):
    registry = load_registry(Path(__file__).resolve().parents[1] / "config" / "agencies.toml")
    assert [a.id for a in registry.agencies] == ["MTA_NYCT", "MTA_LIRR", "MTA_MNR"]
    assert registry.agency("MTA_NYCT").trip_id_match == "nyct_suffix"
    with pytest.raises(RegistryError):
        registry.select("NOPE")
    with pytest.raises(RegistryError):
        Registry((Agency("a", "A", "bus", "Mars/Base"),))
    with pytest.raises(RegistryError):
        Registry((Agency("a", "A", "bus", "UTC"),) * 2)
