"""Route, stop and calendar dimensions."""

from __future__ import annotations

from collections.abc import Iterable
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom import schemas as sc
from tramloom.errors import HolidayCoverageError
from tramloom.functions import clock, keys
from tramloom.sources.feed import Feed

# Published reduced-service dates, by year.
HOLIDAYS = {
    2026: (
        "2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19",
        "2026-07-03", "2026-07-04", "2026-09-07", "2026-11-26", "2026-12-25",
    ),
    2027: (
        "2027-01-01", "2027-01-18", "2027-02-15", "2027-05-31", "2027-06-18",
        "2027-06-19", "2027-07-04", "2027-07-05", "2027-09-06", "2027-11-25",
        "2027-12-24", "2027-12-25",
    ),
}


def route_dimension(feed: Feed, agencies: DataFrame) -> DataFrame:
    """One row per route with its namespaced key and a label that is never null."""
    routes = feed.routes.join(agencies.select("agency_id", "mode"), "agency_id")
    col = F.col
    columns = {
        "route_key": keys.namespaced(col("agency_id"), col("route_id")),
        "display_name": keys.display_name(
            col("route_short_name"), col("route_long_name"), col("route_id")
        ),
    }
    for name in ("route_short_name", "route_long_name", "route_color"):
        columns[name] = keys.non_empty(col(name))
    return sc.conform(routes.withColumns(columns), sc.ROUTES)


def stop_dimension(feed: Feed, boundaries: DataFrame | None = None) -> DataFrame:
    """One row per stop; a stop without a parent is its own station.

    ``boundaries`` places stops in a borough and municipality by coordinates;
    without it, or outside every boundary, both are ``Unknown``.
    """
    col = F.col
    own = keys.namespaced(col("agency_id"), col("stop_id"))
    parent = keys.namespaced(col("agency_id"), keys.non_empty(col("parent_station")))
    stops = feed.stops.withColumns({
        "stop_key": own,
        "stop_name": keys.non_empty(col("stop_name")),
        "is_station": F.coalesce(col("location_type"), F.lit(0)) == 1,
        "parent_station_key": parent,
        "station_key": F.coalesce(parent, own),
    })
    if boundaries is not None:
        from tramloom.operators.geography import locate

        stops = locate(stops, boundaries)
    else:
        stops = stops.withColumns(
            {"borough": F.lit(sc.UNKNOWN), "municipality": F.lit(sc.UNKNOWN)}
        )
    return sc.conform(stops, sc.STOPS)


def unique_by(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key, so a join on it never multiplies facts.

    Which of several rows stays is fixed by their content, not by arrival order.
    """
    rest = [c for c in dimension.columns if c != key]
    best = F.max(F.struct(*rest)).alias("row")
    return dimension.groupBy(key).agg(best).select(key, "row.*")


def with_station_names(stops: DataFrame) -> DataFrame:
    """Adds ``station_name``: the station row's name, or its key where it has none."""
    names = unique_by(
        stops.select(F.col("stop_key").alias("station_key"), F.col("stop_name").alias("name")),
        "station_key",
    )
    return (
        stops.join(names, "station_key", "left")
        .withColumn("station_name", F.coalesce("name", "station_key"))
        .select(*stops.columns, "station_name")
    )


# --- calendar -------------------------------------------------------------


def holiday_frame(spark: SparkSession, dates: Iterable[str | dt.date] | None = None) -> DataFrame:
    """Holidays as rows: the given dates, or all years of the fixed table."""
    if dates is None:
        dates = [d for year in HOLIDAYS.values() for d in year]
    rows = [(d if isinstance(d, dt.date) else dt.date.fromisoformat(d),) for d in dates]
    return spark.createDataFrame(rows, sc.struct(("holiday", sc.DT)))


def calendar_dimension(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per service date that occurs in ``dates``."""
    days = dates.select("service_date").distinct()
    marked = days.join(
        holidays.select(F.col("holiday").alias("service_date")).distinct()
        .withColumn("is_holiday", F.lit(True)),
        "service_date", "left",
    ).withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    date = F.col("service_date")
    return sc.conform(
        marked.withColumns({
            "day_type": clock.day_type(date, F.col("is_holiday")),
            "year": F.year(date), "month": F.month(date), "day_of_week": F.weekday(date),
        }),
        sc.CALENDAR,
    )


def require_holiday_years(dates: DataFrame, holidays: DataFrame) -> None:
    """Refuse dates in a year without any holiday entered."""
    years = dates.select(F.year("service_date").alias("year")).distinct()
    covered = holidays.select(F.year("holiday").alias("year")).distinct()
    gap = [r.year for r in years.join(covered, "year", "left_anti").orderBy("year").collect()]
    if gap:
        raise HolidayCoverageError(f"no holidays entered for {gap[0]}")


def fixed_date_holidays(dates: DataFrame, month_days: Iterable[tuple[int, int]]) -> DataFrame:
    """Holidays that fall on the same day every year, for the years in ``dates``."""
    years = dates.select(F.year("service_date").alias("year")).distinct()
    each: list[Column] = [F.make_date("year", F.lit(m), F.lit(d)) for m, d in month_days]
    return years.select(F.explode(F.array(*each)).alias("holiday"))
