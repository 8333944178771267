import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tramloom import schemas as sc
from tramloom.functions import clock, delay, keys

PERIODS = (["Overnight"] * 6 + ["AM Peak"] * 4 + ["Midday"] * 6 + ["PM Peak"] * 4
           + ["Evening"] * 4)


def one(spark, expression, **values):
    schema = ", ".join(
        f"{k} {'int' if isinstance(v, int) else 'date' if isinstance(v, dt.date) else 'string'}"
        for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (0,)
    return spark.createDataFrame([row], schema).select(expression.alias("v")).head().v


@pytest.mark.parametrize("text, seconds, state", [
    ("06:00:00", 21600, "ok"), ("8:05:09", 29109, "ok"), (" 25:14:00 ", 90840, "ok"),
    ("8:5:00", 29100, "ok"), ("47:59:59", 172799, "ok"), ("+1:00:00", 3600, "ok"),
    ("24:00:00", 86400, "ok"), ("00012:00:00", 43200, "ok"),
    ("", None, "absent"), ("   ", None, "absent"),
    ("48:00:00", None, "malformed"), ("12:60:00", None, "malformed"),
    ("12:00:60", None, "malformed"), ("12:00", None, "malformed"),
    ("12:00:00:00", None, "malformed"), ("12: 0:00", None, "malformed"),
    ("ab:cd:ef", None, "malformed"), ("-1:00:00", None, "malformed"),
])
def test_clock(spark, text, seconds, state):
    code = clock.clock_code(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(
        clock.clock_seconds(F.col("t")).alias("s"), clock.code_state(code).alias("state")).head()
    assert (row.s, row.state) == (seconds, state)


def test_format_clock_round_trips(spark):
    assert one(spark, clock.format_clock(F.col("s")), s=90840) == "25:14:00"


@pytest.mark.parametrize("text, date", [
    ("20260315", dt.date(2026, 3, 15)), (" 20260315 ", dt.date(2026, 3, 15)),
    ("2026-03-15", None), ("20261332", None), ("", None)])
def test_service_day(spark, text, date):
    assert one(spark, clock.service_day(F.col("t")), t=text) == date


@pytest.mark.parametrize("date, seconds, utc", [
    ("2026-03-08", 9000, "2026-03-08 06:30:00"), ("2026-11-01", 5400, "2026-11-01 06:30:00"),
    ("2026-03-10", 91800, "2026-03-11 05:30:00"), ("2026-04-01", 21600, "2026-04-01 10:00:00")])
@pytest.mark.parametrize("zones", [(), ("America/New_York",)])
def test_instants_across_dst(spark, date, seconds, utc, zones):
    start = clock.day_start(F.col("d"), F.lit("America/New_York"), zones)
    instant = clock.at_clock(start, F.col("s"))
    shown = F.date_format(instant, "yyyy-MM-dd HH:mm:ss")
    assert one(spark, shown, d=dt.date.fromisoformat(date), s=seconds) == utc


@pytest.mark.parametrize("date", ["2026-03-08", "2026-11-01"])
def test_seven_is_local_seven_on_dst_days(spark, date):
    zone = F.lit("America/New_York")
    instant = clock.resolve_instant(F.col("d"), F.lit(25200), zone)
    assert one(spark, clock.local_hour(instant, zone), d=dt.date.fromisoformat(date)) == 7


def test_periods_follow_the_contract(spark):
    hours = spark.range(48).select(
        F.col("id").cast("int").alias("h"), clock.clock_period(F.col("id").cast("int")).alias("p"))
    assert [r.p for r in hours.orderBy("h").collect()] == PERIODS * 2
    with pytest.raises(Exception, match="outside 0..47"):
        one(spark, clock.clock_period(F.col("h")), h=48)


def test_service_date_rolls_over_at_four(spark):
    shown = clock.service_date_for(F.col("t").cast("timestamp"))
    assert one(spark, shown, t="2026-05-27 03:59:00") == dt.date(2026, 5, 26)
    assert one(spark, shown, t="2026-05-27 04:00:00") == dt.date(2026, 5, 27)


def test_event_id_golden(spark):
    rows = spark.createDataFrame(
        [("MTA_NYCT", dt.date(2026, 4, 1), "T1", 1), ("AB", dt.date(2026, 4, 1), "C", 1),
         ("A", dt.date(2026, 4, 1), "BC", 1), ("A", dt.date(2026, 4, 1), "BC", 70000)],
        "a string, d date, t string, n int")
    hashed = keys.with_event_id(
        rows.withColumn("p", keys.id_prefix(F.col("a"), F.col("d"), F.col("t"))), "p", "n")
    ids = [r.event_id for r in hashed.collect()]
    assert "a932425890b2ec62" in ids
    assert len(set(ids)) == 4


def test_match_keys(spark):
    trip = keys.trip_match_key(F.col("t"), F.col("r"))
    assert one(spark, trip, t="AFA_x_000600_1..S03R", r="nyct_suffix") == "1..S03R"
    assert one(spark, trip, t="GO_1", r="exact") == "GO_1"
    assert one(spark, keys.match_stop_id(F.col("s"), F.lit(True)), s="101N") == "101"
    assert one(spark, keys.match_stop_id(F.col("s"), F.lit(False)), s="101N") == "101N"


def test_only_scheduled_is_measurable(spark):
    rows = [(r, False, 5) for r in (*sc.SCHEDULE_RELATIONSHIPS, None)]
    rows += [("SCHEDULED", True, 5), ("SCHEDULED", False, None), ("SCHEDULED", None, 5)]
    df = spark.createDataFrame(rows, "r string, c boolean, d int")
    found = [r.m for r in df.select(
        delay.measurable(F.col("r"), F.col("c"), F.col("d")).alias("m")).collect()]
    assert found == [True] + [False] * 8 + [False, False, True]


def test_wire_contract(spark):
    from tramloom.streaming.events import parse_stop_events, render_stop_events

    good = {"event_id": "e", "service_date": "2026-07-26", "agency_id": "A", "route_key": "A:1",
            "scheduled_arrival": "2026-07-26T05:05:00Z", "actual_arrival": "2026-07-26T05:07:00Z",
            "delay_seconds": 120, "schedule_relationship": "SCHEDULED", "extra": 1}
    messages = [json.dumps(good), json.dumps({"routeKey": "A:1", "event_id": "f"}), "{broken",
                json.dumps({"event_id": "g", "schedule_relationship": "LATE"})]
    parsed = parse_stop_events(spark.createDataFrame([(m,) for m in messages], "value string"))
    rows = {r.event_id: r for r in parsed.collect() if r.event_id}
    assert rows["e"].delay_seconds == 120 and rows["e"].is_cancelled is False
    assert rows["e"].direction_id is None and rows["f"].route_key is None
    assert parsed.where("malformed is not null").count() == 2
    sent = json.loads(render_stop_events(parsed.where("event_id = 'e'")).head().value)
    assert sent["actual_arrival"] == "2026-07-26T05:07:00Z" and sent["direction_id"] is None
