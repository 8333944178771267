"""Column contracts: feed tables, facts, dimensions and the wire record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shown for a hierarchy member that the dimensions do not know.
UNKNOWN = "Unknown"

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT, L = T.TimestampType(), T.DateType(), T.LongType()


def struct(*fields: tuple) -> T.StructType:
    """``(name, type)`` is required, ``(name, type, True)`` may be null."""
    return T.StructType([T.StructField(f[0], f[1], len(f) > 2 and f[2]) for f in fields])


FACT_KEYS = struct(
    ("event_id", S), ("agency_id", S), ("route_id", S), ("route_key", S), ("trip_id", S),
    ("stop_id", S), ("stop_key", S), ("stop_sequence", I), ("direction_id", I, True),
    ("scheduled_arrival", TS), ("scheduled_departure", TS), ("dwell_seconds", I),
    ("crosses_midnight", B), ("local_hour", I), ("service_period", S), ("overnight", I),
)
#: Null until realtime fills them, but always present and typed.
REALTIME_COLUMNS = struct(
    ("actual_arrival", TS, True), ("delay_seconds", I, True), ("headway_seconds", I, True),
    ("is_cancelled", B, True), ("schedule_relationship", S, True), ("vehicle_id", S, True),
)
#: The 22 file columns of the fact table; ``service_date`` is the partition.
FACTS = T.StructType(FACT_KEYS.fields + REALTIME_COLUMNS.fields)
#: Written by the build and relied on by the cube.
DERIVED_COLUMNS = ("local_hour", "service_period", "overnight")

ROUTES = struct(
    ("route_key", S), ("route_id", S), ("agency_id", S), ("mode", S), ("route_type", I),
    ("route_short_name", S, True), ("route_long_name", S, True), ("display_name", S),
    ("route_color", S, True),
)
STOPS = struct(
    ("stop_key", S), ("stop_id", S), ("agency_id", S), ("stop_name", S, True),
    ("stop_lat", D, True), ("stop_lon", D, True), ("is_station", B),
    ("parent_station_key", S, True), ("station_key", S), ("borough", S), ("municipality", S),
)
CALENDAR = struct(
    ("service_date", DT), ("day_type", S), ("is_holiday", B), ("year", I), ("month", I),
    ("day_of_week", I),
)

#: The wire record: every fact column plus the service date, snake_case.
STOP_EVENT = T.StructType(
    [T.StructField("service_date", DT, True)]
    + [T.StructField(f.name, f.dataType, True) for f in FACTS.fields]
)

# The eight states of the public realtime specification.
SCHEDULE_RELATIONSHIPS = (
    "SCHEDULED",
    "ADDED",
    "UNSCHEDULED",
    "CANCELED",
    "DUPLICATED",
    "DELETED",
    "SKIPPED",
    "NO_DATA",
)


@dataclass(frozen=True)
class FeedTable:
    """One CSV member of a feed.

    ``required`` columns must be in the header and filled; ``optional`` ones
    become typed nulls when the feed leaves them out.
    """

    file: str
    required: tuple[tuple[str, str], ...]
    optional: tuple[tuple[str, str], ...] = ()
    mandatory: bool = True

    @property
    def name(self) -> str:
        return self.file.removesuffix(".txt")


# File and column names of the public timetable format.  The kinds
# are text (kept as written), int, uint, flag and real.
FEED_TABLES = (
    FeedTable("agency.txt", (("agency_name", "text"), ("agency_timezone", "text")),
              (("agency_id", "text"),)),
    FeedTable("routes.txt", (("route_id", "text"), ("route_type", "int")),
              (("agency_id", "text"), ("route_short_name", "text"),
               ("route_long_name", "text"), ("route_color", "text"))),
    FeedTable("stops.txt", (("stop_id", "text"),),
              (("stop_name", "text"), ("stop_lat", "real"), ("stop_lon", "real"),
               ("location_type", "int"), ("parent_station", "text"))),
    FeedTable("trips.txt", (("trip_id", "text"), ("route_id", "text"), ("service_id", "text")),
              (("trip_headsign", "text"), ("direction_id", "int"))),
    FeedTable("stop_times.txt",
              (("trip_id", "text"), ("stop_id", "text"), ("stop_sequence", "uint")),
              (("arrival_time", "text"), ("departure_time", "text"))),
    FeedTable("calendar.txt",
              (("service_id", "text"), ("monday", "flag"), ("tuesday", "flag"),
               ("wednesday", "flag"), ("thursday", "flag"), ("friday", "flag"),
               ("saturday", "flag"), ("sunday", "flag"), ("start_date", "text"),
               ("end_date", "text")), mandatory=False),
    FeedTable("calendar_dates.txt",
              (("service_id", "text"), ("date", "text"), ("exception_type", "flag")),
              mandatory=False),
)

KIND_TYPES = {"text": S, "int": I, "uint": I, "flag": I, "real": D}


def conform(df: DataFrame, schema: T.StructType, *lead: str) -> DataFrame:
    """Select the contract's columns in order and cast them; absent ones become nulls."""
    have = set(df.columns)
    columns = [F.col(name) for name in lead]
    for field in schema.fields:
        column = F.col(field.name) if field.name in have else F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)
