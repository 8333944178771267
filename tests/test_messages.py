"""Updates as messages say what updates a row a date say, and meet calls that are not shuffled for it."""

from __future__ import annotations

import datetime as dt

import small_feed
from pyspark.sql import functions as F

from tramloom.operators import realtime as rt
from tramloom.plans import catalog
from tramloom.plans import tpch_feed as fx

TABLES = {
    "region": ("r_regionkey int, r_name string", [(i, n) for i, n in enumerate(("AFRICA", "AMERICA", "ASIA", "EUROPE", "EAST"))]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"N{i}", i % 5) for i in range(25)]),
    "customer": ("c_custkey bigint, c_nationkey int", [(i, i) for i in range(25)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                 [(i, f"S{i}", i % 25, 600.0 + i) for i in range(1, 8)]),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
               [(k, k % 25, "OF"[k % 2], 3000.0, dt.datetime(1996, 3, 4 + k % 4), f"{1 + k % 2}-X") for k in range(1, 61)]),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
                 [(k, 7 * k + n, 1 + (k + n) % 7, n, 10.0, 50.0, 0.1 if k % 9 == 0 else 0.05, 0.08 if n == 1 else 0.0, "ANR"[(k + n) % 3])
                  for k in range(1, 61) for n in range(1, 4)]),
    "events": ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
               [(k, dt.datetime(1996, 3, 5, k % 24), k % 11, ("click", "view", "signup", "error", "purchase")[k % 5], 3.5 * k,
                 f'{{"k": {k}}}') for k in range(1, 71)]),
}


def written(spark, folder) -> str:
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_messages_are_the_updates(spark, tmp_path):
    sf_dir = written(spark, tmp_path)
    plainly = catalog._updates(spark, sf_dir)
    messages = catalog._messages(spark, sf_dir)
    own = messages.select("*", F.inline("days")).select(plainly.columns)
    assert messages.count() < plainly.count()
    assert sorted(map(str, own.collect())) == sorted(map(str, plainly.collect()))
    agencies = fx.agencies(spark, sf_dir)
    calls, parts = catalog._by_match_key(spark, sf_dir)
    one, other = (rt.match_calls(calls, rows, agencies, parts) for rows in (messages, plainly))
    found = sorted(map(str, one.collect()))
    assert found == sorted(map(str, other.collect()))
    assert {r.match_status for r in one.collect()} >= {"matched", "unmatched"}


def test_calls_are_stored_once_and_not_shuffled_for_the_match(spark, tmp_path):
    filled = catalog._filled(spark, written(spark, tmp_path))
    plan = filled._jdf.queryExecution().executedPlan().toString()
    # The events on their way to the calls and the messages on theirs to the match; the calls lie there.
    laid = [line for line in plan.splitlines() if "Exchange" in line and "match_trip" in line]
    assert len(laid) == 2
    assert filled.where("vehicle_id is not null").count() > 0


def test_updates_without_a_date_or_an_arrival_stay(spark):
    rows = [(small_feed.A, None, "RT_T1", "101N", dt.datetime(2026, 3, 7, 15), dt.datetime(2026, 3, 7, 7, 1), "SCHEDULED", False, "1"),
            (small_feed.A, dt.date(1969, 3, 7), "RT_T2", "101S", dt.datetime(2026, 3, 7, 15), None, None, True, None),
            (small_feed.A, dt.date(2026, 3, 7), None, None, None, dt.datetime(2026, 3, 8, 7, 1, 2, 345678), None, None, "2")]
    updates = spark.createDataFrame(
        rows, "agency_id string, service_date date, trip_id string, stop_id string, polled_at timestamp, "
        "actual_arrival timestamp, schedule_relationship string, is_cancelled boolean, vehicle_id string")
    agencies = small_feed.agencies(spark)
    laid = rt.updates_by_match_key(updates, agencies, 2)
    plainly = rt.with_match_keys(updates, agencies, realtime=True)
    assert laid.columns == plainly.columns
    assert sorted(map(str, laid.collect())) == sorted(map(str, plainly.collect()))
