"""Reading timetable feeds: folders of CSV files or zip archives of them.

Cells arrive as text, are bound by header name and then cast, so every agency may
have its own column set and order.  All readers are lazy: asking only for the
calendar tables never opens the stop times.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom import schemas as sc
from tramloom.errors import FeedError
from tramloom.sources.archive import DIRECTORY, scan


@dataclass(frozen=True)
class Feed:
    """The seven feed tables, each with an ``agency_id`` from the registry.

    The column an agency states about itself is kept as ``stated_agency_id``.
    """

    agency: DataFrame
    routes: DataFrame
    stops: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame

    def union(self, other: Feed) -> Feed:
        """Both feeds' rows, table by table."""
        return Feed(**{
            t.name: getattr(self, t.name).unionByName(getattr(other, t.name))
            for t in sc.FEED_TABLES
        })


def union_feeds(feeds: list[Feed]) -> Feed:
    return reduce(Feed.union, feeds)


# Patterns of the numeric cells.  A cast alone is too lenient: it takes spaces.
_PATTERNS = {
    "int": r"^[+-]?[0-9]+$",
    "uint": r"^\+?[0-9]+$",
    "flag": r"^\+?[0-9]+$",
    "real": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
}


def _fail(where: Column, what: str, cell: Column, kind) -> Column:
    message = F.concat(where, F.lit(f": {what} "), F.coalesce(cell, F.lit("missing")))
    return F.raise_error(message).cast(kind)


def _typed(cell: Column, name: str, kind: str, required: bool, where: Column) -> Column:
    """A text cell as its contract type; a cell that does not fit fails the job."""
    spark_type = sc.KIND_TYPES[kind]
    if kind == "text" and required and not name.endswith("_id"):
        return F.coalesce(cell, F.lit(""))
    filled = cell.isNotNull() if kind == "text" else (F.coalesce(cell, F.lit("")) != "")
    value = cell
    if kind != "text":
        number = cell.try_cast(spark_type)
        fits = F.coalesce(cell.rlike(_PATTERNS[kind]) & number.isNotNull(), F.lit(False))
        value = F.when(fits, number).otherwise(_fail(where, f"bad {name}", cell, spark_type))
    empty = _fail(where, f"no {name}", F.lit(None).cast("string"), spark_type) if required else (
        F.lit(None).cast(spark_type)
    )
    return F.when(filled, value).otherwise(empty)


def bind(
    rows: DataFrame, table: sc.FeedTable, agency_id: str, cells: dict[str, Column], where: Column
) -> DataFrame:
    """Type the named text cells of one table and stamp the registry's agency id."""
    columns = [F.lit(agency_id).alias("agency_id")]
    for required, group in ((True, table.required), (False, table.optional)):
        for name, kind in group:
            out = "stated_agency_id" if name == "agency_id" else name
            if name not in cells and required:
                raise FeedError(f"{agency_id}: {table.file} has no column {name}")
            cell = cells.get(name, F.lit(None).cast("string"))
            columns.append(_typed(cell, name, kind, required, where).alias(out))
    return rows.select(*columns)


def empty_table(spark: SparkSession, table: sc.FeedTable) -> DataFrame:
    names = [("agency_id", sc.S)]
    for name, kind in (*table.required, *table.optional):
        names.append(("stated_agency_id" if name == "agency_id" else name, sc.KIND_TYPES[kind]))
    return spark.createDataFrame([], sc.struct(*[(n, t, True) for n, t in names]))


# --- folders --------------------------------------------------------------


def _folder_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Lower-case base name -> path of every text file at or below a folder."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[tT][xX][tT]")
        .load(folder)
        .select("path")
    )
    # A feed has a handful of files; only their names come to the driver.
    return {row.path.rsplit("/", 1)[-1].lower(): row.path for row in listing.collect()}


def read_csv_table(
    spark: SparkSession, path: str, table: sc.FeedTable, agency_id: str
) -> DataFrame:
    """One CSV file, split over tasks by Spark, bound by trimmed header names."""
    rows = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )
    cells = {}
    for name in rows.columns:
        cells.setdefault(name.strip().lstrip("﻿"), F.col(f"`{name}`"))
    return bind(rows, table, agency_id, cells, F.lit(f"{agency_id} {table.file}"))


def read_folder(spark: SparkSession, folder: str, agency_id: str) -> Feed:
    """A feed extracted to a folder; files may sit in a subfolder."""
    files = _folder_files(spark, folder)
    return _assemble(
        spark,
        agency_id,
        files.keys(),
        lambda table: read_csv_table(spark, files[table.file], table, agency_id),
    )


# --- archives -------------------------------------------------------------


def read_archive_member(
    spark: SparkSession, path: str, table: sc.FeedTable, agency_id: str
) -> DataFrame:
    """One table of a zip archive, bound by header names.

    An archive's member is one task, as it can only be inflated from its start; stop times are
    spread out again before anything else is done with them.
    """
    names = [name for name, _ in (*table.required, *table.optional)]
    records = scan(spark, path, table.file, names)
    if table.name == "stop_times":
        records = records.hint("rebalance")
    where = F.concat(
        F.col("path"), F.lit(f" {table.file} record "), F.col("record").cast("string")
    )
    return bind(records, table, agency_id, {n: F.col(f"`{n}`") for n in names}, where)


def read_archive(spark: SparkSession, path: str, agency_id: str) -> Feed:
    """A zip archive; members are found by base name, in any letter case."""
    listing = scan(spark, path, DIRECTORY, [])
    members = {row.member for row in listing.select("member").distinct().collect()}
    return _assemble(
        spark,
        agency_id,
        members,
        lambda table: read_archive_member(spark, path, table, agency_id),
    )


def _assemble(spark: SparkSession, agency_id: str, present, read) -> Feed:
    tables = {}
    for table in sc.FEED_TABLES:
        if table.file in present:
            tables[table.name] = read(table)
        elif table.mandatory:
            raise FeedError(f"{agency_id}: missing {table.file}")
        else:
            tables[table.name] = empty_table(spark, table)
    if not ({"calendar.txt", "calendar_dates.txt"} & set(present)) or (
        tables["calendar"].isEmpty() and tables["calendar_dates"].isEmpty()
    ):
        raise FeedError(f"{agency_id}: missing calendar.txt or calendar_dates.txt")
    return Feed(**tables)


def read_feed(spark: SparkSession, path: str, agency_id: str) -> Feed:
    """A feed from a zip archive or from a folder of CSV files."""
    reader = read_archive if path.lower().endswith(".zip") else read_folder
    return reader(spark, path, agency_id)
