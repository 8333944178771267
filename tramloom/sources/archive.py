"""Zip archives of CSV tables as a partitioned Spark source.

One input partition is one member of one archive.  Only the archive's directory is read to plan
them; a task seeks to its member, inflates it as a stream and hands on Arrow batches, so memory
is bounded by a block, however large archive and member are.  A member cannot be split: a
deflated stream is readable from its start only.

    spark.dataSource.register(FeedArchives)
    spark.read.format("feed_archive").option("path", path).option("file", "stops.txt") \
        .option("columns", "stop_id,stop_name").load()

``path`` is a zip file or a folder of them, in any file system Arrow can open: local or mounted
folders, HDFS and the common object stores.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of CSV text parsed at once; a record must fit.
BLOCK_BYTES = 4 << 20
#: Directories hold a row a member: this option asks for them instead of a table's rows.
DIRECTORY = "*"


def base_name(member: str) -> str:
    return re.split(r"[/\\]", member)[-1].lower()


def _open(path: str) -> pa.NativeFile:
    system, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (pafs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _archives(path: str) -> list[str]:
    """A path itself, or the zip files in the folder it names."""
    uri = "://" in path or path.startswith("file:")
    system, inner = pafs.FileSystem.from_uri(path) if uri else (pafs.LocalFileSystem(), path)
    if system.get_file_info(inner).type != pafs.FileType.Directory:
        return [path]
    found = system.get_file_info(pafs.FileSelector(inner))
    prefix = path.rstrip("/")
    return sorted(f"{prefix}/{f.base_name}" for f in found if f.is_file and f.base_name.lower().endswith(".zip"))


def members(path: str) -> list[str]:
    """The member names of an archive, from its directory alone."""
    try:
        with _open(path) as raw, zipfile.ZipFile(raw) as archive:
            return archive.namelist()
    except zipfile.BadZipFile as error:
        raise ValueError(f"{path} is not a zip archive") from error


class _Padded:
    """Records with more or fewer cells than the header: parsed apart, with their record numbers."""

    def __init__(self, width: int):
        self.width = width
        self.numbers: list[int] = []
        self.rows: list[list[str | None]] = []

    def __call__(self, row: pacsv.InvalidRow) -> str:
        cells = next(csv.reader(io.StringIO(row.text, newline="")), [])[:self.width]
        self.numbers.append(row.number)
        self.rows.append([*cells, *[None] * (self.width - len(cells))])
        return "skip"

    def taken(self) -> tuple[list[int], list[list[str | None]]]:
        found = self.numbers, self.rows
        self.numbers, self.rows = [], []
        return found


def records(raw, columns: list[str]) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """A CSV stream as batches: record numbers (the header is 1) and the named columns as text.

    Columns are bound by trimmed header names, the first of equal ones; unknown ones are left out
    and absent ones are null.  A record may be short: the cells it lacks are null.
    """
    header = next(csv.reader([raw.readline().decode("utf-8-sig")]), [])
    place: dict[str, int] = {}
    for i, name in enumerate(header):
        place.setdefault(name.strip(), i)
    names = [f"c{i}" for i in range(len(header))]
    if not names:
        return
    odd = _Padded(len(names))
    try:
        reader = pacsv.open_csv(
            raw,
            pacsv.ReadOptions(use_threads=False, block_size=BLOCK_BYTES, column_names=names),
            pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=odd),
            pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False))
    except pa.ArrowInvalid as error:
        if "Empty CSV file" in str(error):
            return
        raise
    last, aside = 0, []  # the last number given, and later ones that are taken

    def picked(cells: list[pa.Array], n: int) -> list[pa.Array]:
        return [cells[place[c]] if c in place else pa.nulls(n, pa.string()) for c in columns]

    while True:
        try:
            batch = reader.read_next_batch()
        except StopIteration:
            batch = None
        numbers, rows = odd.taken()
        if rows:
            aside += numbers
            yield np.array(numbers) + 1, picked(
                [pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))], len(rows))
        if batch is None:
            return
        if batch.num_rows:
            # The parser counts all records after the header, from 1, and may be a block ahead;
            # the records set aside leave gaps in the batch's own numbers.
            own = np.arange(last + 1, last + batch.num_rows + len(aside) + 1)
            own = own[~np.isin(own, aside)][:batch.num_rows]
            last = int(own[-1])
            aside = [n for n in aside if n > last]
            yield own + 1, picked(batch.columns, batch.num_rows)


@dataclass
class ArchiveMember(InputPartition):
    path: str
    member: str | None


class _Reader(DataSourceReader):
    def __init__(self, path: str, file: str, columns: list[str]):
        self.path, self.file, self.columns = path, file, columns

    def partitions(self) -> list[ArchiveMember]:
        """One for each archive that has the member; of members with equal base names, the first."""
        found = []
        for path in _archives(self.path):
            if self.file == DIRECTORY:
                found.append(ArchiveMember(path, None))
                continue
            own = [m for m in members(path) if base_name(m) == self.file]
            found += [ArchiveMember(path, m) for m in own[:1]]
        return found or [ArchiveMember("", None)]

    def read(self, partition: ArchiveMember) -> Iterator[pa.RecordBatch]:
        names = ["path", "record", *self.columns]
        if not partition.path:
            return
        if partition.member is None:
            own = members(partition.path)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.path] * len(own)), pa.array(range(len(own)), pa.int64()),
                 pa.array(map(base_name, own), pa.string())], names)
            return
        try:
            with _open(partition.path) as raw, zipfile.ZipFile(raw) as archive, \
                    archive.open(partition.member) as inflated:
                for numbers, cells in records(inflated, self.columns):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([partition.path] * len(numbers)), pa.array(numbers, pa.int64()), *cells], names)
        except (zipfile.BadZipFile, pa.ArrowInvalid, UnicodeDecodeError) as error:
            raise ValueError(f"{partition.path} {partition.member}: {error}") from error


class FeedArchives(DataSource):
    """Options: path, file (a member's base name in lower case), columns (comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "feed_archive"

    def _columns(self) -> list[str]:
        if self.options.get("file") == DIRECTORY:
            return ["member"]
        return [c for c in self.options.get("columns", "").split(",") if c]

    def schema(self) -> str:
        return ", ".join(["path string", "record long", *[f"`{c}` string" for c in self._columns()]])

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options["file"], self._columns())


def scan(spark: SparkSession, path: str, file: str, columns: list[str]) -> DataFrame:
    """The records of one table in the archives at ``path``, as text with path and record number."""
    spark.dataSource.register(FeedArchives)
    return spark.read.format("feed_archive").option("path", path).option("file", file).option(
        "columns", ",".join(columns)).load()
