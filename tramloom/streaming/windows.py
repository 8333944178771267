"""Rolling delay statistics, anomalies and health events on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.functions import delay as delays
from tramloom.operators import realtime as rt
from tramloom.streaming.settings import StreamSettings
from tramloom.streaming.sinks import KeptTable


def distinct_events(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Each event id once, however often it is sent within the watermark."""
    return events.withWatermark("actual_arrival", watermark).dropDuplicatesWithinWatermark(
        ["event_id"]
    )


def rolling_stream(
    events: DataFrame,
    key: str | list[str],
    size: str = "1h",
    watermark: str = "10 minutes",
    threshold: int = delays.ON_TIME_SECONDS,
) -> DataFrame:
    """Rolling statistics per key as a streaming aggregate.

    State is one row per key and open window.  Its percentiles are exact and hold a count
    per different delay; the events of a hot key are combined before they are shuffled.
    """
    length, slide = rt.ROLLING[size]
    keys = [key] if isinstance(key, str) else list(key)
    timed = events.where(F.col("actual_arrival").isNotNull())
    if watermark:
        timed = timed.withWatermark("actual_arrival", watermark)
    span = F.window("actual_arrival", f"{length} seconds", f"{slide} seconds")
    delay = F.when(F.col("measured"), F.col("delay_seconds")).cast("bigint")
    windows = rt.usable(timed).withColumn("delay", delay).groupBy(*keys, span).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("delay").alias("measured_events"),
        F.sum("delay").alias("delay_total"),
        F.count_if(delays.on_time(F.col("delay"), threshold)).alias("on_time_events"),
        *[F.expr(f"percentile_disc({share / 100}) within group (order by delay)").cast("bigint").alias(name)
          for name, share in rt.PERCENTILES.items()],
    )
    return windows.withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end"),
    }).select(*rt.window_columns(keys))


def rolling_streams(
    events: DataFrame, key: str | list[str], settings: StreamSettings = StreamSettings()
) -> dict[str, DataFrame]:
    """The rolling statistics of every window the settings name."""
    return {
        size: rolling_stream(
            events, key, size,
            settings.long_watermark if rt.ROLLING[size][0] > 3600 else settings.watermark,
            settings.on_time_threshold_seconds)
        for size in settings.windows
    }


#: Length of a pane in seconds: every window is made of whole panes.
PANE_SECONDS = 300
#: Size parameter of the delay sketches: about 600 kept values at most, and a percentile's rank
#: within 1.7 points of a hundred with 99 % confidence; up to K values are all kept, so exact.
SKETCH_K = 200


def pane_sketches(
    events: DataFrame, keys: list[str], watermark: str = "10 minutes", threshold: int = delays.ON_TIME_SECONDS,
) -> DataFrame:
    """Statistics of each key's five-minute panes, with a mergeable sketch of the delays."""
    timed = rt.usable(events.where(F.col("actual_arrival").isNotNull()))
    if watermark:
        timed = timed.withWatermark("actual_arrival", watermark)
    delay = F.when(F.col("measured"), F.col("delay_seconds")).cast("bigint")
    return timed.withColumn("delay", delay).groupBy(
        *keys, F.window("actual_arrival", f"{PANE_SECONDS} seconds").alias("pane"),
    ).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("delay").alias("measured_events"),
        F.sum("delay").alias("delay_total"),
        F.count_if(delays.on_time(F.col("delay"), threshold)).alias("on_time_events"),
        F.kll_sketch_agg_bigint("delay", SKETCH_K).alias("sketch"),
    )


def windows_of_panes(panes: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Rolling windows made of finished panes: a pane, not its events, enters each window."""
    length, slide = rt.ROLLING[size]
    if length == PANE_SECONDS:
        windows = panes.withColumnRenamed("pane", "span")
    else:
        # A window of panes takes the pane's last instant, so it holds whole panes.
        span = F.window(F.window_time("pane"), f"{length} seconds", f"{slide} seconds").alias("span")
        windows = panes.groupBy(*keys, span).agg(
            *[F.sum(c).alias(c) for c in ("events", "measured_events", "delay_total", "on_time_events")],
            F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))
    return windows.withColumns({
        "window_start": F.col("span.start"), "window_end": F.col("span.end"),
        **{name: F.when(  # an empty sketch has no quantile
            F.col("measured_events") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(share / 100)))
           for name, share in rt.PERCENTILES.items()},
    }).select(*rt.window_columns(keys))


def sketched_stream(
    events: DataFrame, key: str | list[str], size: str = "1h", watermark: str = "10 minutes",
    threshold: int = delays.ON_TIME_SECONDS,
) -> DataFrame:
    """Rolling statistics with sketched percentiles, as finished windows (append mode).

    State is one sketch of bounded size per key and open pane or window, whatever the traffic
    and however many different delays there are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return windows_of_panes(pane_sketches(events, keys, watermark, threshold), keys, size)


def current_table(root: str) -> KeptTable:
    """The sink that keeps the newest window of every route; a window's later counts replace earlier ones."""
    return KeptTable(root, ["route_key"], ["window_start", "events"])


def anomaly_stream(
    windows: DataFrame,
    baseline: DataFrame,
    threshold: int = delays.ANOMALY_SECONDS,
    observations: int = delays.ANOMALY_OBSERVATIONS,
) -> DataFrame:
    """Alert rows: streamed windows joined with the stored baseline of their slot."""
    return rt.anomalies(windows, baseline, threshold, observations)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as messages for the alert topic."""
    return alerts.select(
        F.col("route_key").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value")
    )


def health_stream(polls: DataFrame, limit: int = delays.STALE_SECONDS) -> DataFrame:
    """Health events of stale feeds."""
    return rt.stale_polls(polls, limit)


def health_messages(stale: DataFrame, key: str) -> DataFrame:
    """Health events as messages for the health topic, by ``key``."""
    return stale.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*stale.columns)).alias("value")
    )
