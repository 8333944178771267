"""Stored rows as a live feed, in order of arrival, and what comes too late.

A replay hands a table to a stream slice by slice, in order of arrival.  The query is started
anew for every slice on one checkpoint, as after a restart: state, offsets and results must
carry over.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tramloom.session import shared_dir
from tramloom.streaming.sinks import BatchFolders, Sink

def cuts(rows: DataFrame, arrived: str, slices: int) -> list:
    """Instants that cut ``rows`` into about equal slices by time of arrival."""
    shares = [k / slices for k in range(1, slices)]
    found = rows.agg(F.percentile_approx(F.unix_micros(arrived), F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0]
    return sorted(set(found or []))


def replay(
    rows: DataFrame, build: Callable[[DataFrame], DataFrame], slices: int, arrived: str = "received_at",
    mode: str = "append", closing: DataFrame | None = None, sink: Callable[[str], Sink] = BatchFolders,
) -> tuple[DataFrame, list[StreamingQueryProgress]]:
    """Run ``build`` over ``rows`` in slices by ``arrived``; ``closing`` rows come as one slice more.

    ``sink`` makes the sink for a folder.  Returns what it holds in the end and the progress
    reports of all batches.
    """
    spark = rows.sparkSession
    root = f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}"
    at = F.unix_micros(arrived)
    bounds = [None, *cuts(rows, arrived, slices), None]
    own = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        after = F.lit(True) if low is None else F.coalesce(at > low, F.lit(False))  # unknown arrivals come first
        own.append(rows.where(after & (F.lit(True) if high is None else F.coalesce(at <= high, F.lit(True)))))
    own += [] if closing is None else [closing.select(*rows.columns)]
    held = sink(f"{root}/table")
    reports: list[StreamingQueryProgress] = []
    stream = None
    for k, part in enumerate(own):
        part.write.parquet(f"{root}/input/{k}")
        stream = build(spark.readStream.schema(rows.schema).parquet(f"{root}/input/*"))
        query = (
            stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint")
            .foreachBatch(held.store).trigger(availableNow=True).start())
        query.awaitTermination()
        reports += query.recentProgress
    return held.read(spark, stream.schema), reports


# --- late rows ------------------------------------------------------------


def late(time: str, arrived: str, allowed_seconds: int) -> Column:
    """Whether a row came so long after its time that a watermark of that length may drop it.

    It depends on the row alone, not on the batch it falls into.  Where nothing arrives before
    its time, Spark drops late rows only: the watermark trails the newest time seen, which is
    not after any later arrival.
    """
    return F.coalesce(F.unix_micros(arrived) - F.unix_micros(time) >= 1_000_000 * allowed_seconds, F.lit(False))


def counted_late(rows: DataFrame, time: str, arrived: str, allowed_seconds: int) -> DataFrame:
    """Adds ``is_late`` and counts rows and late rows in each batch's progress, as ``late``."""
    marked = rows.withColumn("is_late", late(time, arrived, allowed_seconds))
    return marked.observe("late", F.count(F.lit(1)).alias("rows"), F.count_if("is_late").alias("late_rows"))


def observed_total(reports: list[StreamingQueryProgress], name: str, metric: str) -> int:
    """The sum of an observed metric over all batches."""
    found = [r.observedMetrics[name] for r in reports if name in r.observedMetrics]
    return sum(row[metric] for row in found)
