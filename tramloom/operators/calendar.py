"""Service calendars: which service runs on which date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.errors import WindowError
from tramloom.functions.clock import service_day

#: A longer range is a garbled field, not years of service.
MAX_SPAN_DAYS = 5 * 366

#: Exception types, also used as precedence.
ADDED, REMOVED = 1, 2

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

Window = tuple[dt.date, dt.date]


def _day(text: str, file: str) -> Column:
    """A date cell; unreadable text fails the job and names the file."""
    column = F.col(text)
    message = F.concat(F.lit(f"bad date in {file}: "), F.coalesce(column, F.lit("missing")))
    parsed = service_day(column)
    return F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(message).cast("date"))


def _in_window(dates: DataFrame, window: Window | None) -> DataFrame:
    if window is None:
        return dates
    return dates.where(F.col("service_date").between(F.lit(window[0]), F.lit(window[1])))


def _weekly(calendar: DataFrame, window: Window | None) -> DataFrame:
    """Dates of the weekly patterns.

    The window is applied to the range before it is expanded: a date outside it
    never becomes a row.
    """
    ranged = calendar.withColumns(
        {"start": _day("start_date", "calendar.txt"), "end": _day("end_date", "calendar.txt")}
    )
    too_long = F.raise_error(
        F.concat(F.lit("implausible service range for "), F.col("service_id"))
    ).cast("date")
    ranged = ranged.withColumn(
        "end",
        F.when(F.date_diff("end", "start") > MAX_SPAN_DAYS, too_long).otherwise(F.col("end")),
    )
    first, last = F.col("start"), F.col("end")
    if window is not None:
        first = F.greatest(first, F.lit(window[0]))
        last = F.least(last, F.lit(window[1]))
    flags = F.array(*[F.col(day) == 1 for day in WEEKDAYS])
    running = F.filter(
        F.sequence(first, last), lambda d: F.element_at(flags, F.weekday(d) + 1)
    )
    dates = F.when(last >= first, running)
    return ranged.select("agency_id", "service_id", F.explode(dates).alias("service_date"))


def _exceptions(calendar_dates: DataFrame, window: Window | None) -> DataFrame:
    bad_kind = F.raise_error(
        F.concat(
            F.lit("bad exception_type for "), F.col("service_id"), F.lit(": "),
            F.col("exception_type").cast("string"),
        )
    ).cast("int")
    kind = F.when(F.col("exception_type").isin(ADDED, REMOVED), F.col("exception_type"))
    dates = calendar_dates.select(
        "agency_id", "service_id", _day("date", "calendar_dates.txt").alias("service_date"),
        kind.otherwise(bad_kind).alias("kind"),
    )
    return _in_window(dates, window)


def expand_calendar(
    calendar: DataFrame, calendar_dates: DataFrame, window: Window | None = None
) -> DataFrame:
    """Every (agency, service, date) on which a service runs.

    Pattern dates, additions and removals meet in one grouping per date: it runs if
    the largest kind is an addition, so a removal always wins and one shuffle does it.
    """
    stated = _weekly(calendar, window).withColumn("kind", F.lit(ADDED))
    stated = stated.unionByName(_exceptions(calendar_dates, window))
    settled = stated.groupBy("agency_id", "service_id", "service_date").agg(
        F.max("kind").alias("kind")
    )
    return settled.where(F.col("kind") == ADDED).drop("kind")


def defined_services(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Services a feed defines.  One that is only ever removed is not defined."""
    added = calendar_dates.where(F.col("exception_type") == ADDED)
    keys = ["agency_id", "service_id"]
    return calendar.select(keys).unionByName(added.select(keys)).distinct()


def empty_services(
    calendar: DataFrame, calendar_dates: DataFrame, service_dates: DataFrame
) -> DataFrame:
    """Services that are defined and run on no date."""
    keys = ["agency_id", "service_id"]
    return defined_services(calendar, calendar_dates).join(service_dates, keys, "left_anti")


def coverage(service_dates: DataFrame) -> DataFrame:
    """First and last running date per agency."""
    return service_dates.groupBy("agency_id").agg(
        F.min("service_date").alias("first_date"), F.max("service_date").alias("last_date")
    )


def active_dates(service_dates: DataFrame) -> DataFrame:
    return service_dates.select("agency_id", "service_date").distinct()


def services_on(service_dates: DataFrame, date: dt.date) -> DataFrame:
    return (
        service_dates.where(F.col("service_date") == F.lit(date))
        .select("agency_id", "service_id")
        .orderBy("agency_id", "service_id")
    )


def dates_for(service_dates: DataFrame, agency_id: str, service_id: str) -> DataFrame:
    wanted = (F.col("agency_id") == agency_id) & (F.col("service_id") == service_id)
    return service_dates.where(wanted).select("service_date").orderBy("service_date")


def runs_on(service_dates: DataFrame, agency_id: str, service_id: str, date: dt.date) -> bool:
    found = dates_for(service_dates, agency_id, service_id)
    return not found.where(F.col("service_date") == F.lit(date)).isEmpty()


def shared_coverage(service_dates: DataFrame) -> DataFrame:
    """One row: the dates every agency covers."""
    return coverage(service_dates).agg(
        F.max("first_date").alias("first_date"), F.min("last_date").alias("last_date")
    )


def shared_window(
    service_dates: DataFrame | None,
    agencies: list[str],
    start: dt.date | None = None,
    end: dt.date | None = None,
    days: int | None = None,
) -> Window:
    """The dates to build: given ones, else those that all ``agencies`` have service for.

    ``days`` counts from the start and never leads past the last common date.  With both
    ends given the calendar is not looked at, and may be None.
    """
    if days is not None and days <= 0:
        raise WindowError(f"{days} days are no window")
    if start is None or end is None:
        start, end = _completed(service_dates, agencies, start, end, days)
    if start > end:
        raise WindowError(f"nothing lies between {start} and {end}")
    return start, end


def _completed(
    service_dates: DataFrame, agencies: list[str], start: dt.date | None, end: dt.date | None,
    days: int | None,
) -> Window:
    """The missing ends of a window, from one row of bounds over the wanted agencies."""
    bounds = coverage(service_dates.where(F.col("agency_id").isin(agencies))).agg(
        F.max("first_date").alias("opening"), F.min("last_date").alias("closing"),
        F.collect_set("agency_id").alias("covered"),
    ).first()
    absent = sorted(set(agencies) - set(bounds.covered))
    if absent:
        raise WindowError("no service on any date: " + ", ".join(absent))
    if bounds.opening > bounds.closing:
        raise WindowError(f"no common date: one agency starts {bounds.opening}, one ends {bounds.closing}")
    start = bounds.opening if start is None else start
    if end is None:
        end = bounds.closing if days is None else min(bounds.closing, start + dt.timedelta(days - 1))
    return start, end
