"""Streams over several batches: order, late rows, restarts and sorted-out messages."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tramloom.operators import realtime as rt
from tramloom.streaming import events, matching
from tramloom.streaming import replay as rp
from tramloom.streaming import sinks, stateful, windows

T0 = dt.datetime(2026, 5, 1, 12)
POLL = "vehicle string, polled_at timestamp, zone int, state string, received_at timestamp"


def later(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def closing(spark, schema, place):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(T0 + dt.timedelta(days=30) if n == place else None for n in names)], schema)


def replayed_polls(spark, polls, slices):
    frame = spark.createDataFrame(polls, POLL)
    found, _ = rp.replay(
        frame, lambda s: stateful.poll_diff_stream(s, ["vehicle"], ["zone", "state"]), slices,
        closing=closing(spark, POLL, "polled_at"))
    return frame, found.drop("batch")


def test_polls_out_of_order_between_batches(spark):
    # Seconds 0, 20 | 10, 30: each poll differs from the one before it in time.
    polls = [("v", later(s), z, "a", later(100 + k)) for k, (s, z) in enumerate([(0, 1), (20, 1), (10, 2), (30, 2)])]
    _, found = replayed_polls(spark, polls, 2)
    assert [(r.polled_at, r.zone) for r in found.orderBy("polled_at").collect()] == [
        (later(0), 1), (later(10), 2), (later(20), 1), (later(30), 2)]


@pytest.mark.parametrize("slices", [1, 4])
def test_poll_diff_does_not_depend_on_batch_borders(spark, slices):
    rng = random.Random(1)
    polls = []
    for _ in range(400):
        at = rng.randrange(3000) / 2
        polls.append((rng.choice("vwx"), later(at), rng.choice([None, 1, 2]), rng.choice("ab"),
                      later(at + rng.randrange(550))))
    polls += polls[:40]  # the same poll twice
    frame, found = replayed_polls(spark, polls, slices)
    assert rows(found) == rows(rt.changed_between_polls(frame, ["vehicle"], ["zone", "state"]))


def test_headway_with_late_arrivals(spark):
    rng = random.Random(2)
    calls = []
    for i in range(300):
        at = rng.randrange(4000) / 3
        calls.append((f"e{i:04d}", T0.date(), rng.choice("ab"), "s", rng.choice([None, 0, 1]), later(at),
                      later(at + rng.randrange(590))))
    schema = ("event_id string, service_date date, route_key string, stop_key string, direction_id int, "
              "actual_arrival timestamp, received_at timestamp")
    frame = spark.createDataFrame(calls, schema)
    found, _ = rp.replay(frame, stateful.headway_stream, 3, closing=closing(spark, schema, "actual_arrival"))
    assert rows(found.drop("batch")) == rows(rt.with_headway(frame).select("event_id", "headway_seconds"))


def test_silent_keys_are_forgotten(spark):
    polls = [("v", later(0), 1, "a", later(0)), ("w", later(5), 1, "a", later(5)),
             ("w", later(90_000), 1, "a", later(90_000)), ("w", later(180_000), 1, "a", later(180_000))]
    frame = spark.createDataFrame(polls, POLL)
    found, reports = rp.replay(
        frame, lambda s: stateful.poll_diff_stream(s, ["vehicle"], ["zone", "state"], forget_seconds=100_000), 4,
        closing=closing(spark, POLL, "polled_at"))
    assert found.count() == 2  # w is never silent for so long
    assert reports[-1].stateOperators[0].numRowsTotal == 0


def test_late_rows_are_counted_and_set_aside(spark):
    data = [(i, later(60 * i), later(60 * i + way)) for i, way in enumerate([0, 599, 600, 5, 10_000, 601, 1, 599])]
    frame = spark.createDataFrame(data, "id int, at timestamp, received_at timestamp")
    found, reports = rp.replay(
        frame, lambda s: rp.counted_late(s, "at", "received_at", 600), 3,
        sink=lambda root: sinks.BatchFolders(root, {"late": F.col("is_late")}))
    assert sorted((r.id, r.part) for r in found.collect()) == [
        (i, "late" if i in (2, 4, 5) else "rest") for i in range(8)]
    assert rp.observed_total(reports, "late", "late_rows") == 3
    assert rp.observed_total(reports, "late", "rows") == 8


def test_spark_drops_no_row_that_is_in_time(spark):
    rng = random.Random(3)
    data = [(i, later(at), later(at + rng.choice([0, 300, 599.9, 600, 5000])))
            for i, at in enumerate(rng.randrange(20_000) for _ in range(400))]
    frame = spark.createDataFrame(data, "id int, at timestamp, received_at timestamp")

    def kept(stream):
        return rp.counted_late(stream, "at", "received_at", 600).withWatermark("at", "600 seconds") \
            .dropDuplicatesWithinWatermark(["id"])

    found, _ = rp.replay(frame, kept, 5)
    in_time = {i for i, at, received in data if (received - at).total_seconds() < 600}
    assert in_time <= {r.id for r in found.where("not is_late").collect()}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    sink = sinks.BatchFolders(str(tmp_path), {"odd": F.col("id") % 2 == 1})
    for _ in range(2):
        sink.store(spark.range(10), 0)
    sink.store(spark.range(10, 13), 1)
    found = sink.read(spark, spark.range(1).schema)
    assert sorted((r.id, r.batch, r.part) for r in found.collect()) == sorted(
        (i, i // 10, "odd" if i % 2 else "rest") for i in range(13))


def test_unknown_arrivals_are_in_the_first_slice(spark):
    frame = spark.createDataFrame([(1, None), (2, T0), (3, later(9))], "id int, received_at timestamp")
    found, _ = rp.replay(frame, lambda s: s, 2)
    assert sorted(r.id for r in found.collect()) == [1, 2, 3]


# --- kept tables ----------------------------------------------------------

KEPT = "k string, at int, v string"


def files(tmp_path):
    return sorted(p.name for p in tmp_path.rglob("part-*") if p.is_file())


@pytest.mark.parametrize("by", [3, "k"])
def test_a_kept_table_has_the_newest_row_of_each_key(spark, tmp_path, by):
    table = sinks.KeptTable(str(tmp_path), ["k"], ["at"], by)
    batches = [[("a", 1, "x"), ("b", 5, "y"), ("a", 3, "z")], [("c", 1, None), ("a", 2, "old")], [("b", 5, "zz"), (None, 1, "n")]]
    state = {}
    for number, rows_ in enumerate(batches):
        for _ in range(2):  # every batch comes twice
            table.store(spark.createDataFrame(rows_, KEPT), number)
        for k, at, v in rows_:
            state[k] = max(state.get(k, (-1, "")), (at, v or ""))
        assert sorted((r.k or "", r.at, r.v or "") for r in table.read(spark).collect()) == sorted(
            (k or "", *row) for k, row in state.items())
    assert {r.k: r.batch for r in table.read(spark).collect()} == {"a": 0, "b": 2, "c": 1, None: 2}


def test_an_old_batch_again_changes_nothing_and_storage_stays(spark, tmp_path):
    table = sinks.KeptTable(str(tmp_path), ["k"], ["at"], 1)
    for number in range(6):
        table.store(spark.createDataFrame([("a", number, "x"), (f"k{number % 2}", 1, "y")], KEPT).coalesce(1), number)
        if number == 2:
            held = len(files(tmp_path))
    assert len(files(tmp_path)) == held
    before = rows(table.read(spark))
    table.store(spark.createDataFrame([("a", 0, "x"), ("k1", 1, "y")], KEPT), 6)
    assert rows(table.read(spark)) == before
    table.store(spark.createDataFrame([], KEPT), 7)  # an empty batch
    assert rows(table.read(spark)) == before


def test_a_batch_broken_off_after_staging_is_finished(spark, tmp_path):
    table = sinks.KeptTable(str(tmp_path), ["k"], ["at"], 2)
    table.store(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], KEPT), 0)
    # As if the program had ended between staging and replacing.
    table._merged(spark.createDataFrame([("a", 2, "y")], KEPT), 1).write.partitionBy("bucket").parquet(
        f"{tmp_path}/staged/batch=1")
    table.store(spark.createDataFrame([("a", 2, "y")], KEPT), 1)
    assert sorted((r.k, r.at) for r in table.read(spark).collect()) == [("a", 2), ("b", 1)]


# --- sketches -------------------------------------------------------------


def test_sketched_windows_are_bounded_and_close(spark):
    rng = random.Random(5)
    delays = [int(rng.gauss(0, 1) ** 3 * 400) for _ in range(30_000)]
    calls = [(f"r{i % 2}", 1_777_636_800 + i // 9, d, "SKIPPED" if i % 50 == 0 else "SCHEDULED") for i, d in enumerate(delays)]
    frame = spark.createDataFrame(calls, "route_key string, at long, delay_seconds int, schedule_relationship string")
    timed = frame.withColumn("actual_arrival", F.timestamp_seconds("at")).withColumn("is_cancelled", F.lit(False))
    panes = windows.pane_sketches(timed, ["route_key"], "")
    assert panes.agg(F.max(F.length("sketch"))).first()[0] < 40 * windows.SKETCH_K
    found = windows.sketched_stream(timed, "route_key", "1h", "").collect()
    exact = {(r.route_key, r.window_start): r for r in rt.rolling(timed, "route_key", "1h").collect()}
    assert len(found) == len(exact)
    for r in found:
        e = exact[r.route_key, r.window_start]
        assert (r.events, r.measured_events, r.mean_delay, r.on_time_share) == (
            e.events, e.measured_events, e.mean_delay, e.on_time_share)
        low = int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp())
        own = sorted(d for k, at, d, s in calls if k == r.route_key and low <= at < low + 3600 and s == "SCHEDULED")
        for name, share in rt.PERCENTILES.items():
            value = getattr(r, name)
            below, upto = sum(d < value for d in own), sum(d <= value for d in own)
            assert below - 0.017 * len(own) <= share / 100 * len(own) <= upto + 0.017 * len(own) + 1


def test_windows_without_a_delay_have_no_percentile(spark):
    frame = spark.createDataFrame([("r", T0, None, "SCHEDULED", False)],
                                  "route_key string, actual_arrival timestamp, delay_seconds int, "
                                  "schedule_relationship string, is_cancelled boolean")
    found = windows.sketched_stream(frame, "route_key", "1h", "").collect()
    assert len(found) == 12 and all(r.p50_delay is None and r.mean_delay is None and r.events == 1 for r in found)


# --- matching and messages ------------------------------------------------


def test_streamed_updates_match_as_in_batch(spark, tmp_path):
    day, next_day = dt.date(2026, 5, 1), dt.date(2026, 5, 2)
    calls = [(d, f"{trip}-{d.day}-{stop}", "A", trip, stop, later(3600 * k))
             for d in (day, next_day) for k, (trip, stop) in enumerate(
                 [("x_1", "s1"), ("x_1", "s2"), ("y_1", "s3"), ("x_2", "s1"), ("x_2", "s1")])]
    frame = spark.createDataFrame(calls, "service_date date, event_id string, agency_id string, trip_id string, "
                                         "stop_id string, scheduled_arrival timestamp")
    frame.write.partitionBy("service_date").parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    agencies = spark.createDataFrame([("A", "nyct_suffix", True)],
                                     "agency_id string, trip_id_match string, stop_id_direction_suffix boolean")
    rng = random.Random(6)
    updates = [("A", rng.choice([day, next_day, dt.date(2026, 6, 1)]), rng.choice(["r_1", "r_2", "r_9"]),
                rng.choice(["s1N", "s2S", "s3", "s8"]), later(rng.randrange(50)), rng.choice([None, later(7), later(8)]),
                later(rng.randrange(500))) for _ in range(120)]
    schema = ("agency_id string, service_date date, trip_id string, stop_id string, polled_at timestamp, "
              "actual_arrival timestamp, received_at timestamp")
    sent = spark.createDataFrame(updates, schema)
    found, _ = rp.replay(sent, lambda s: s.drop("received_at"), 3,
                         sink=lambda root: matching.matched_table(root, facts, agencies))
    expected = rt.match_updates(facts, sent.drop("received_at"), agencies)
    columns = [c for c in expected.columns if c != "batch"]
    assert rows(found.select(columns)) == rows(expected.select(columns))
    assert {r.match_status for r in found.collect()} == {"matched", "unmatched", "ambiguous"}
    plan = matching.match_batch(facts, sent.where("service_date = '2026-05-01'"), agencies)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_date" in text or "service_date#" in text.split("PartitionFilters: [")[1][:80]
    assert matching.match_batch(facts, sent.where("false"), agencies).count() == 0


def test_messages_are_sorted_out_whole(spark, tmp_path):
    sent = [('{"event_id":"1","route_key":"r","schedule_relationship":"SCHEDULED","delay_seconds":5}', "rest"),
            ('{"event_id":"2","route_key":"r","schedule_relationship":"ADDED","delay_seconds":5}', "unmeasured"),
            ('{"event_id":"3","route_key":"r","delay_seconds":5}', "unmeasured"),
            ('{"event_id":"4","route_key":"r","schedule_relationship":"SCHEDULED","is_cancelled":true,"delay_seconds":1}',
             "unmeasured"),
            ('{"event_id":"5","route_key":"r","schedule_relationship":"SCHEDULED"}', "unmeasured"),
            ('{"event_id":"6","route_key":"r","schedule_relationship":"LOST","delay_seconds":5}', "malformed"),
            ('{"event_id":"7","route_', "malformed"), ("", "malformed"), ("none", "malformed")]
    frame = spark.createDataFrame([(v, later(k)) for k, (v, _) in enumerate(sent)], "value string, received_at timestamp")
    found, _ = rp.replay(frame, lambda s: events.parse_stop_events(s.select("value")), 3, sink=events.sorted_out)
    shown = sorted((r.malformed if r.part == "malformed" else r.event_id, r.part) for r in found.collect())
    assert shown == sorted((v if p == "malformed" else str(k + 1), p) for k, (v, p) in enumerate(sent))
