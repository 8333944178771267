"""Whole jobs: build a dataset from feeds, open it as a cube, inspect a feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tramloom.operators import cube as cubes
from tramloom.operators import dimensions as dims
from tramloom.operators.calendar import Window, expand_calendar, shared_window
from tramloom.operators.schedule import build_summary, feed_profile, resolve_schedule
from tramloom.operators.validate import in_report_order, require_integrity, violations
from tramloom.sources import dataset
from tramloom.sources.feed import Feed


def inspect_feed(feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Profile and violations of a feed."""
    return feed_profile(feed), in_report_order(violations(feed))


def build_window(
    feed: Feed,
    agencies: list[str],
    start: dt.date | None = None,
    end: dt.date | None = None,
    days: int | None = None,
) -> Window:
    """The window to build.  Reads only the calendar tables, and those only if needed."""
    dates = expand_calendar(feed.calendar, feed.calendar_dates)
    return shared_window(dates, agencies, start, end, days)


def build_dataset(
    feed: Feed,
    agencies: DataFrame,
    root: str,
    window: Window | None = None,
    boundaries: DataFrame | None = None,
    allow_violations: bool = False,
) -> DataFrame:
    """Validate, resolve and write a feed; returns its summary, one row per agency."""
    if not allow_violations:
        require_integrity(feed)
    dataset.write_facts(resolve_schedule(feed, agencies, window), root)
    dataset.write_dimension(dims.route_dimension(feed, agencies), root, "routes")
    dataset.write_dimension(dims.stop_dimension(feed, boundaries), root, "stops")
    return build_summary(feed, window)


@dataclass(frozen=True)
class Cube:
    """Facts with their dimensions, ready to query."""

    facts: DataFrame | cubes.Spread
    dimensions: cubes.Dimensions

    def query(
        self,
        *measures: str,
        levels: Iterable[str] = (),
        members: cubes.Members | None = None,
        by: Iterable[str] = (),
    ) -> DataFrame:
        return cubes.cube_query(self.facts, self.dimensions, measures, levels, members, by)

    def scenarios(
        self,
        overrides: DataFrame,
        scenarios: Iterable[str],
        on: list[str],
        *measures: str,
        levels: Iterable[str] = (),
        members: cubes.Members | None = None,
    ) -> DataFrame:
        return cubes.cube_scenarios(
            self.facts, self.dimensions, overrides, scenarios, on, measures, levels, members)

    def rollup(
        self,
        *measures: str,
        hierarchies: Iterable[str],
        members: cubes.Members | None = None,
    ) -> DataFrame:
        return cubes.cube_rollup(self.facts, self.dimensions, measures, hierarchies, members)


def open_cube(
    spark: SparkSession,
    root: str,
    agencies: DataFrame,
    dates: Iterable[dt.date] | None = None,
    holidays: DataFrame | None = None,
) -> Cube:
    """Load a dataset and build the calendar from the dates its facts contain.

    Without ``holidays`` the fixed table is used and a year it lacks is an error.
    """
    facts = dataset.load_facts(spark, root, dates, agencies)
    days = facts.select("service_date").distinct()
    if holidays is None:
        holidays = dims.holiday_frame(spark)
        dims.require_holiday_years(days, holidays)
    return Cube(
        facts,
        cubes.Dimensions.of(
            dataset.load_dimension(spark, root, "routes"),
            dataset.load_dimension(spark, root, "stops"),
            dims.calendar_dimension(days, holidays),
        ),
    )
