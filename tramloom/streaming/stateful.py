"""Operators on Spark's keyed state, in event time.

Rows of a key wait until the watermark has passed them; then they are handed on in the order
of their time, however they arrived and wherever the batches were cut.  So the result equals
the batch operator's over all rows that came no later than the watermark allows.  State lives
in Spark's own store.  Every call of a Python state costs more than a row, so keys share
``SHARDS`` states by their hash: a list of waiting rows, the last row handed on of each key,
and one timer a shard.

A key that stays silent is forgotten by the timer.  Heartbeats (rows that name no key) move the
watermark while nothing else arrives; they leave no state and no result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tramloom.functions import delay as delays
from tramloom.operators import realtime as rt

#: Silence after which a key's last row is dropped; keys hold a service date, so none returns.
FORGET_SECONDS = 2 * 86_400
#: States that the keys are dealt out to.
SHARDS = 1024
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
_STORE = "spark.sql.streaming.stateStore"
#: Keyed state with timers needs the RocksDB store; a batch then writes its changes, not the store.
STORE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_keyed_state(spark: SparkSession) -> None:
    """Set the session's state store, which a stream takes over when it starts."""
    for key, value in STORE_SETTINGS.items():
        spark.conf.set(key, value)


class _InOrder(StatefulProcessor):
    """Hands the rows of a shard's keys on in order of (at, tie), once the watermark has passed them."""

    def __init__(self, forget_seconds: int):
        self.forget = 1000 * forget_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "key string, at long, body string")
        self.last = handle.getListState("last", "key string, at long, body string")
        self.timer = handle.getValueState("timer", "due long, waits boolean")

    #: The watermark (in milliseconds) from which no earlier or equal row can come.
    @staticmethod
    def due(at: int) -> int:
        raise NotImplementedError

    @staticmethod
    def order(row: tuple[int, str]):
        return row

    def follow(self, ready: list[tuple[int, str]], last: tuple[int, str] | None):
        """Result rows of one key, as column lists, and the new last row."""
        raise NotImplementedError

    def result(self, found: dict[str, list]) -> pd.DataFrame:
        """Result rows of a shard, from column lists with ``_key``."""
        raise NotImplementedError

    def _set_timer(self, due: int, waits: bool) -> None:
        if self.timer.exists():
            set_for, waited = self.timer.get()
            if (set_for, waited) == (due, waits):
                return
            if set_for != due:
                self.handle.deleteTimer(set_for)
                self.handle.registerTimer(due)
        else:
            self.handle.registerTimer(due)
        self.timer.update((due, waits))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):  # heartbeats
            return
        due = None
        for batch in rows:
            at = batch["at"].tolist()
            self.waiting.appendList(list(zip(batch["owner"].tolist(), at, batch["body"].tolist(), strict=True)))
            first = self.due(min(at))
            due = first if due is None else min(due, first)
        if due is not None:
            if self.timer.exists():
                earlier, waits = self.timer.get()
                due = min(due, earlier) if waits else due
            self._set_timer(due, True)
        return
        yield  # the results come when the timer expires

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        passed = timerValues.getCurrentWatermarkInMs()
        ready: dict[str, list[tuple[int, str]]] = {}
        later = []
        for name, at, body in self.waiting.get():
            if self.due(at) <= passed:
                ready.setdefault(name, []).append((at, body))
            else:
                later.append((name, at, body))
        last = {name: (at, body) for name, at, body in self.last.get()}
        results: dict[str, list] = {"_key": []}
        for name, rows in ready.items():
            found, last[name] = self.follow(sorted(rows, key=self.order), last.get(name))
            n = 0
            for column, values in found.items():
                results.setdefault(column, []).extend(values)
                n = len(values)
            results["_key"].extend([name] * n)
        waiting = {name for name, _, _ in later}
        # A key with rows waiting is not silent.
        kept = {name: row for name, row in last.items()
                if name in waiting or self.due(row[0]) + self.forget > passed}
        if ready or len(kept) < len(last):
            self._put(self.last, [(name, *row) for name, row in kept.items()])
        if ready:
            self._put(self.waiting, later)
        if results["_key"]:
            yield self.result(results)
        if later:
            self._set_timer(min(self.due(at) for _, at, _ in later), True)
        elif kept:
            self._set_timer(min(self.due(at) for at, _ in kept.values()) + self.forget, False)

    @staticmethod
    def _put(state, rows: list) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def close(self) -> None:
        pass


class _Changes(_InOrder):
    """Rows whose body differs from the one before; at is in microseconds."""

    @staticmethod
    def due(at: int) -> int:
        return -(-at // 1000)

    @staticmethod
    def order(row: tuple[int, str]):
        # Rows of one instant go by their payload's values, absent ones first.
        return row[0], [(v is not None, v) for v in json.loads(row[1]).values()]

    def follow(self, ready, last):
        at, bodies = [], []
        before = None if last is None else last[1]
        for time, body in ready:
            if body != before:
                at.append(time)
                bodies.append(body)
            before = body
        return {"at": at, "body": bodies}, ready[-1]

    def result(self, found):
        return pd.DataFrame(found)


class _Gaps(_InOrder):
    """Whole seconds since the row before; at is in seconds, the body an id."""

    @staticmethod
    def due(at: int) -> int:
        return 1000 * (at + 1)

    def follow(self, ready, last):
        gaps: list[int | None] = []
        before = None if last is None else last[0]
        for second, _ in ready:
            gaps.append(None if before is None else second - before)
            before = second
        return {"event_id": [body for _, body in ready], "headway_seconds": gaps}, ready[-1]

    def result(self, found):
        return pd.DataFrame({
            "event_id": found["event_id"], "headway_seconds": pd.array(found["headway_seconds"], "Int32")})


def _keyed(rows: DataFrame, key: list[str], time: str, watermark: str, beat: Column, at: Column, body: Column):
    known = F.to_json(F.struct(*key), _JSON)
    keyed = rows.withWatermark(time, watermark).select(
        F.when(~beat, known).alias("owner"), F.col(time).alias("time"), at.alias("at"), body.alias("body"))
    shard = F.when(F.col("owner").isNotNull(), F.pmod(F.xxhash64("owner"), F.lit(SHARDS)).cast("int"))
    return keyed.withColumn("_shard", shard).groupBy("_shard")


def _fields(df: DataFrame, names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, df.schema[n].dataType, True) for n in names])


def poll_diff_stream(
    polls: DataFrame, key: list[str], payload: list[str], time: str = "polled_at",
    watermark: str = "10 minutes", forget_seconds: int = FORGET_SECONDS,
) -> DataFrame:
    """Updates that differ from the previous poll of their key, as a stream.

    Polls equal in key, instant and payload are one poll.  A poll appears when the watermark
    has passed it.  Polls without the first column of the key are heartbeats.
    """
    use_keyed_state(polls.sparkSession)
    changed = _keyed(
        polls, key, time, watermark, F.isnull(key[0]), F.unix_micros(time), F.to_json(F.struct(*payload), _JSON),
    ).transformWithStateInPandas(
        _Changes(forget_seconds), "_key string, at long, body string", "Append", "EventTime")
    own, rest = _fields(polls, key), _fields(polls, payload)
    return changed.select(
        F.from_json("_key", own, _JSON).alias("k"), F.timestamp_micros("at").alias(time),
        F.from_json("body", rest, _JSON).alias("p"),
    ).select(*[F.col("k").getField(k).alias(k) for k in key], time,
             *[F.col("p").getField(p).alias(p) for p in payload])


def headway_stream(
    events: DataFrame, watermark: str = "10 minutes", forget_seconds: int = FORGET_SECONDS,
) -> DataFrame:
    """Event id and seconds since the previous vehicle of its key, as a stream.

    An arrival appears when the watermark has passed its second; events without an arrival
    have no place in the order and no row.  Events without an id are heartbeats.
    """
    use_keyed_state(events.sparkSession)
    return _keyed(
        events, list(rt.HEADWAY_KEY), "actual_arrival", watermark, F.isnull("event_id"),
        delays.epoch_second(F.col("actual_arrival")), F.col("event_id"),
    ).transformWithStateInPandas(
        _Gaps(forget_seconds), "event_id string, headway_seconds int", "Append", "EventTime")
