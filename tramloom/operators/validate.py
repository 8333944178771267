"""Referential integrity of a feed.

Every reference and every key becomes one row of (file, field, value).  References
are counted per value first, so forty thousand calls at one retired stop shrink to
one row before anything is shuffled or joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.errors import IntegrityError
from tramloom.functions.keys import non_empty
from tramloom.sources.feed import Feed

_SERVICE_FILES = "calendar.txt/calendar_dates.txt"


def _reference(file: str, field: str, value: Column, target: str) -> Column:
    parts = {"file": F.lit(file), "field": F.lit(field), "value": value,
             "references": F.lit(target)}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def _references(feed: Feed) -> DataFrame:
    """Every stated reference; each table is read once, whatever it refers to."""
    col = F.col
    # A feed whose agency file states no id at all has nothing to check routes against.
    naming = feed.agency.where(col("stated_agency_id").isNotNull()).select("agency_id").distinct()
    by_table = [
        (feed.trips, [
            _reference("trips.txt", "route_id", col("route_id"), "routes.txt"),
            _reference("trips.txt", "service_id", col("service_id"), _SERVICE_FILES),
        ]),
        (feed.stop_times, [
            _reference("stop_times.txt", "trip_id", col("trip_id"), "trips.txt"),
            _reference("stop_times.txt", "stop_id", col("stop_id"), "stops.txt"),
        ]),
        (feed.stops, [
            _reference("stops.txt", "parent_station", non_empty(col("parent_station")),
                       "stops.txt"),
        ]),
        (feed.routes.join(naming, "agency_id", "left_semi"), [
            _reference("routes.txt", "agency_id", non_empty(col("stated_agency_id")),
                       "agency.txt"),
        ]),
    ]
    parts = [
        table.select("agency_id", F.inline(F.array(*refs))).where(F.col("value").isNotNull())
        for table, refs in by_table
    ]
    return reduce(DataFrame.unionByName, parts)


def _keys(feed: Feed) -> DataFrame:
    def key(table: DataFrame, target: str, column: str) -> DataFrame:
        return table.select(
            "agency_id", F.lit(target).alias("references"), F.col(column).alias("value")
        ).where(F.col("value").isNotNull())

    parts = [
        key(feed.routes, "routes.txt", "route_id"),
        key(feed.trips, "trips.txt", "trip_id"),
        key(feed.stops, "stops.txt", "stop_id"),
        key(feed.calendar, _SERVICE_FILES, "service_id"),
        key(feed.calendar_dates, _SERVICE_FILES, "service_id"),
        key(feed.agency, "agency.txt", "stated_agency_id"),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def dangling_keys(feed: Feed) -> DataFrame:
    """References whose target does not exist, with how often each occurs."""
    counted = _references(feed).groupBy(
        "agency_id", "file", "field", "value", "references"
    ).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.join(_keys(feed), ["agency_id", "references", "value"], "left_anti").select(
        "agency_id", "file", "field", "value", "references", "occurrences"
    )


def duplicate_keys(feed: Feed) -> DataFrame:
    """Primary keys that occur more than once."""
    owners = (
        (feed.routes, "routes.txt", "route_id"),
        (feed.stops, "stops.txt", "stop_id"),
        (feed.trips, "trips.txt", "trip_id"),
    )
    parts = [
        table.groupBy("agency_id", F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(
            "agency_id", F.lit(file).alias("file"), F.lit(column).alias("field"), "value",
            F.lit("a unique key").alias("references"), "occurrences",
        )
        for table, file, column in owners
    ]
    return reduce(DataFrame.unionByName, parts)


def trips_without_calls(feed: Feed) -> DataFrame:
    """Optional check: trips no stop time belongs to."""
    keys = ["agency_id", "trip_id"]
    idle = feed.trips.join(feed.stop_times.select(keys).distinct(), keys, "left_anti")
    return idle.select(
        "agency_id", F.lit("trips.txt").alias("file"), F.lit("trip_id").alias("field"),
        F.col("trip_id").alias("value"), F.lit("stop_times.txt").alias("references"),
    ).groupBy("agency_id", "file", "field", "value", "references").agg(
        F.count(F.lit(1)).alias("occurrences")
    )


def violations(feed: Feed, idle_trips: bool = False) -> DataFrame:
    """All integrity violations.  Empty means the feed is consistent."""
    found = dangling_keys(feed).unionByName(duplicate_keys(feed))
    return found.unionByName(trips_without_calls(feed)) if idle_trips else found


def in_report_order(found: DataFrame) -> DataFrame:
    return found.orderBy("agency_id", "file", "field", "value")


def require_integrity(feed: Feed, shown: int = 20) -> None:
    """Refuse a feed with violations.

    The message states how many there are and spells out the first ``shown``;
    ``violations`` has them all.
    """
    found = violations(feed).cache()
    try:
        total = found.count()
        if not total:
            return
        lines = [
            f"{r.agency_id} {r.file}.{r.field} {r.value!r} not in {r.references} "
            f"({r.occurrences} rows)" for r in in_report_order(found).limit(shown).collect()
        ]
    finally:
        found.unpersist()
    rest = f"; and {total - len(lines)} more" if total > len(lines) else ""
    raise IntegrityError(f"{total} violations: " + "; ".join(lines) + rest)
