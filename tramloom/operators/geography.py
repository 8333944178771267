"""Placing stops inside boundary polygons.

A boundary row is (name columns..., ring), the ring being an array of
``struct<lon: double, lat: double>`` corners.  Boundaries are cut into grid cells,
stops fall into exactly one cell, and the two meet in an equi-join on the cell;
the even-odd rule then decides among the few candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.schemas import UNKNOWN

CELL_DEGREES = 0.25


def inside(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd rule: a ray to the east crosses an odd number of edges."""
    size = F.size(ring)

    def crosses(at: Column) -> Column:
        a = F.element_at(ring, at + 1)
        b = F.element_at(ring, (at + 1) % size + 1)
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        east = a["lon"] + (lat - a["lat"]) * (b["lon"] - a["lon"]) / (b["lat"] - a["lat"])
        return F.when(spans, lon < east).otherwise(F.lit(False))

    hits = F.filter(F.sequence(F.lit(0), size - 1), crosses)
    return F.size(hits) % 2 == 1


def _cell(degrees: Column) -> Column:
    return F.floor(degrees / CELL_DEGREES).cast("int")


def _cell_range(ring: Column, axis: str) -> Column:
    values = F.transform(ring, lambda corner: corner[axis])
    return F.sequence(_cell(F.array_min(values)), _cell(F.array_max(values)))


def boundary_cells(boundaries: DataFrame) -> DataFrame:
    """Each boundary once per grid cell its bounding box touches."""
    across = boundaries.withColumn("cell_x", F.explode(_cell_range(F.col("ring"), "lon")))
    return across.withColumn("cell_y", F.explode(_cell_range(F.col("ring"), "lat")))


def locate(stops: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Adds borough and municipality; the first by name where boundaries overlap.

    Equal coordinates are looked up once, so many stops at one place cost one test.
    """
    places = (
        stops.where(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull())
        .select("stop_lat", "stop_lon").distinct()
        .withColumns({"cell_x": _cell(F.col("stop_lon")), "cell_y": _cell(F.col("stop_lat"))})
    )
    found = (
        places.join(boundary_cells(boundaries), ["cell_x", "cell_y"])
        .where(inside(F.col("stop_lon"), F.col("stop_lat"), F.col("ring")))
        .groupBy("stop_lat", "stop_lon")
        .agg(F.min(F.struct("borough", "municipality")).alias("area"))
    )
    return (
        stops.drop("borough", "municipality")
        .join(found, ["stop_lat", "stop_lon"], "left")
        .withColumns({
            "borough": F.coalesce("area.borough", F.lit(UNKNOWN)),
            "municipality": F.coalesce("area.municipality", F.lit(UNKNOWN)),
        })
        .drop("area")
    )
