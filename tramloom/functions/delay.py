"""Expressions over a call's actual arrival."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults of the agency registry and the stream settings, in seconds.
ON_TIME_SECONDS = 300
STALE_SECONDS = 300
ANOMALY_SECONDS = 120
ANOMALY_OBSERVATIONS = 20


def epoch_second(instant: Column) -> Column:
    return F.unix_seconds(instant.cast("timestamp"))


def delay_seconds(scheduled: Column, actual: Column) -> Column:
    """Whole seconds late; negative is early."""
    return F.timestamp_diff("SECOND", scheduled, actual).cast("int")


def measurable(relationship: Column, is_cancelled: Column, delay: Column) -> Column:
    """Only a call the feed states as SCHEDULED, that ran, and has a delay.

    An unstated relationship is not SCHEDULED; an unstated cancellation is none.
    """
    stated = F.coalesce(relationship == "SCHEDULED", F.lit(False))
    return stated & ~F.coalesce(is_cancelled, F.lit(False)) & delay.isNotNull()


def on_time(delay: Column, threshold: int = ON_TIME_SECONDS) -> Column:
    """Within the threshold of schedule, early or late."""
    return F.abs(delay) <= threshold


def adherence(delay: Column, threshold: int = ON_TIME_SECONDS) -> Column:
    """1 for a punctual call, falling to 0 at twice the threshold.

    This package's own definition; the public documents only name the measure.
    """
    return F.greatest(F.lit(0.0), 1 - F.abs(delay) / F.lit(2.0 * threshold))


def is_stale(polled_at: Column, header_at: Column, limit: int = STALE_SECONDS) -> Column:
    """The feed's own header is older than the limit when it was polled."""
    return (F.unix_micros(polled_at) - F.unix_micros(header_at)) > F.lit(limit * 1_000_000)
