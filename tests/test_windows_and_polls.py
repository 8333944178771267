"""Exact percentiles at any pane size, polls inside one second, windows of dates."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramloom.errors import DatasetError, IntegrityError, WindowError
from tramloom.operators import calendar as cal
from tramloom.operators import realtime as rt
from tramloom.operators import validate

T0 = dt.datetime(2026, 5, 1, 12, 0, 0)


def events(spark, rows):
    frame = spark.createDataFrame(rows, "route_key string, at long, delay_seconds int, status string")
    return frame.withColumns({
        "actual_arrival": F.timestamp_seconds("at"), "schedule_relationship": F.col("status"),
        "is_cancelled": F.lit(False)})


@pytest.mark.parametrize("size", ["5m", "1h"])
def test_percentiles_of_a_large_pane_are_exact(spark, size):
    rng = np.random.default_rng(1)
    delays = rng.integers(-500, 90_000, 10_000)
    rows = [("r", 600 + i % 300, int(d), "SCHEDULED") for i, d in enumerate(delays)]
    rows += [("r", 700, 5, "SKIPPED")] * 50
    found = rt.rolling(events(spark, rows), "route_key", size).where("window_start = timestamp_seconds(600)").first()
    ordered = np.sort(delays)
    for name, share in rt.PERCENTILES.items():
        assert found[name] == ordered[-(-share * len(ordered) // 100) - 1]
    assert (found.events, found.measured_events) == (10_050, 10_000)
    assert found.mean_delay == pytest.approx(delays.mean())
    assert found.on_time_share == pytest.approx((abs(delays) <= 300).mean())


def test_a_window_without_measured_delays_has_no_percentiles(spark):
    found = rt.rolling(events(spark, [("r", 0, None, "SCHEDULED"), ("r", 1, 7, "SKIPPED")]), "route_key", "5m").first()
    assert (found.events, found.measured_events, found.p50_delay, found.mean_delay) == (2, 0, None, None)


@pytest.mark.parametrize("size", ["5m", "1h", "24h"])
def test_windows_without_percentiles_have_the_same_sums(spark, size):
    rng = np.random.default_rng(2)
    rows = [(f"r{i % 3}", int(t), None if i % 7 == 0 else int(d), "SKIPPED" if i % 5 == 0 else "SCHEDULED")
            for i, (t, d) in enumerate(zip(rng.integers(0, 90_000, 300), rng.integers(-400, 900, 300), strict=True))]
    frame = events(spark, rows)
    whole = rt.rolling(frame, "route_key", size).drop(*rt.PERCENTILES)
    plain = rt.rolling(frame, "route_key", size, percentiles=False)
    assert plain.columns == whole.columns
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_changes_inside_a_second_are_kept(spark):
    times = [0.1, 0.5, 0.5, 1.2, 1.2, 1.3]
    states = [1, 2, 2, 1, 1, 1]
    polls = spark.createDataFrame(
        [("v", T0 + dt.timedelta(seconds=t), s) for t, s in zip(times, states, strict=True)],
        "vehicle string, polled_at timestamp, zone int")
    found = rt.changed_between_polls(polls, ["vehicle"], ["zone"]).orderBy("polled_at").collect()
    assert [r.zone for r in found] == [1, 2, 1]


def test_dates_of_a_window(spark):
    d = dt.date
    rows = [("A", "s", d(2026, 1, k)) for k in range(1, 21)] + [("B", "s", d(2026, 1, k)) for k in range(5, 31)]
    dates = spark.createDataFrame(rows, "agency_id string, service_id string, service_date date")
    assert cal.shared_window(dates, ["A", "B"]) == (d(2026, 1, 5), d(2026, 1, 20))
    assert cal.shared_window(dates, ["B"], days=2) == (d(2026, 1, 5), d(2026, 1, 6))
    assert cal.shared_window(None, [], d(2030, 1, 1), d(2030, 1, 1)) == (d(2030, 1, 1), d(2030, 1, 1))
    for bad in ({"days": 0}, {"start": d(2026, 2, 1)}, {"start": d(2026, 1, 9), "end": d(2026, 1, 8)}):
        with pytest.raises(WindowError):
            cal.shared_window(dates, ["A", "B"], **bad)
    with pytest.raises(WindowError, match="C"):
        cal.shared_window(dates, ["A", "C"])


def test_an_integrity_error_states_the_total(spark):
    found = spark.createDataFrame(
        [("A", "trips.txt", "route_id", f"x{i:03d}", "routes.txt", 1) for i in range(45)],
        "agency_id string, file string, field string, value string, references string, occurrences int")
    original = validate.violations
    validate.violations = lambda feed: found
    try:
        with pytest.raises(IntegrityError, match="45 violations.*and 25 more"):
            validate.require_integrity(None)
    finally:
        validate.violations = original


def test_facts_without_a_contract_column_are_refused(spark, tmp_path):
    from tramloom.sources import dataset

    spark.range(3).write.parquet(f"{tmp_path}/{dataset.FACT_TABLE}")
    with pytest.raises(DatasetError, match="without"):
        dataset.load_facts(spark, str(tmp_path))
