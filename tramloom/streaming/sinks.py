"""Sinks of micro-batches whose result does not change when a batch is repeated."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Sink(Protocol):
    def store(self, batch: DataFrame, number: int) -> None: ...

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame: ...


class BatchFolders:
    """Every batch in a folder of its own number, so a repeated batch replaces itself.

    With ``parts``, a batch is written once, split by the first condition that holds for a row:
    nothing is in two parts or in none (``rest`` takes what no condition does).
    """

    def __init__(self, root: str, parts: dict[str, Column] | None = None):
        self.root = root
        self.parts = parts

    def store(self, batch: DataFrame, number: int) -> None:
        folder = f"{self.root}/batch={number}"
        if self.parts is None:
            batch.write.mode("overwrite").parquet(folder)
            return
        name = reduce(
            lambda other, part: F.when(part[1], part[0]).otherwise(other), reversed(self.parts.items()), F.lit("rest"))
        batch.withColumn("part", name).write.mode("overwrite").partitionBy("part").parquet(folder)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All rows, with their batch and part."""
        extra = [T.StructField("batch", T.LongType())]
        if self.parts is not None:
            extra.append(T.StructField("part", T.StringType()))
        return spark.read.schema(T.StructType([*schema.fields, *extra])).option("basePath", self.root).parquet(
            f"{self.root}/batch=*")


class KeptTable:
    """One row per key: of all rows that batches brought, the one that is last by ``order``.

    A batch touches only the partitions its keys are in: their rows and the batch's are merged
    into a staged table, and this replaces the partitions.  The merge keeps a maximum and a
    staged batch is used again, so a repeated or broken-off batch leaves the same table, and
    storage grows with the keys, not with the batches.  ``by`` is a column of the key that
    partitions the table, or the number of hash partitions of the keys.
    """

    def __init__(self, root: str, keys: list[str], order: list[str], by: str | int = 16,
                 change: Callable[[DataFrame], DataFrame] | None = None):
        self.root, self.keys, self.order, self.by = root, keys, order, by
        #: What is done with a batch before its rows are kept.
        self.change = change
        self.part = by if isinstance(by, str) else "bucket"

    @property
    def table(self) -> str:
        return f"{self.root}/kept"

    def store(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        staged = f"{self.root}/staged/batch={number}"
        if not self._exists(spark, f"{staged}/_SUCCESS"):
            self._merged(batch, number).write.mode("overwrite").partitionBy(self.part).parquet(staged)
        if any(self._parts(spark, staged)):
            spark.read.option("basePath", staged).parquet(staged).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.table)
        if number:
            self._delete(spark, f"{self.root}/staged/batch={number - 1}")

    def _merged(self, batch: DataFrame, number: int) -> DataFrame:
        rows = (self.change(batch) if self.change else batch).withColumn("batch", F.lit(number).cast("long"))
        if not isinstance(self.by, str):
            rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.by)).cast("int"))
        if self._exists(batch.sparkSession, self.table):
            touched = [r[0] for r in rows.select(self.part).distinct().collect()]  # partitions, not rows
            kept = batch.sparkSession.read.schema(rows.schema).parquet(self.table)
            known = [t for t in touched if t is not None]
            wanted = F.col(self.part).isin(known) if known else F.lit(False)
            if len(known) < len(touched):
                wanted = wanted | F.col(self.part).isNull()
            rows = rows.unionByName(kept.where(wanted))
        keys = self.keys if self.part in self.keys else [*self.keys, self.part]
        # Of equal rows the earlier batch's counts, so that a repeated row changes nothing.
        rest = [c for c in rows.columns if c not in (*keys, *self.order, "batch")]
        last = F.max(F.struct(*self.order, *rest, (-F.col("batch")).alias("_first"))).alias("last")
        found = rows.groupBy(*keys).agg(last)
        return found.select(*keys, *[F.col(f"last.`{c}`").alias(c) for c in (*self.order, *rest)],
                            (-F.col("last._first")).alias("batch")).select(rows.columns)

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """The kept rows, with the batch that brought each; no row before the first batch."""
        return spark.read.option("basePath", self.table).parquet(self.table).drop("bucket")

    @staticmethod
    def _path(spark: SparkSession, path: str):
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, spark: SparkSession, path: str) -> bool:
        found, files = self._path(spark, path)
        return files.exists(found)

    def _parts(self, spark: SparkSession, path: str) -> list[bool]:
        found, files = self._path(spark, path)
        return [True for status in files.listStatus(found) if status.isDirectory()]

    def _delete(self, spark: SparkSession, path: str) -> None:
        found, files = self._path(spark, path)
        files.delete(found, True)
