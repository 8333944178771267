"""What several operators of this subpackage share.

Intermediate tables go to the shared folder of the session (``spark.checkpoint.dir``), so
a lost executor costs one stage and no lineage grows with the rounds of a loop.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.session import prepare, shared_dir

#: ASCII white space, the only separator between words.
SPACES = r"[\x20\x09-\x0D]+"
#: One word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written for one call of an operator, removed when the program ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
        atexit.register(self._forget)

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _forget(self) -> None:
        try:
            self.drop()
        except Exception:  # the session has ended before; the folder is the session's
            pass


def sealed(rows: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that none can clash with a helper column."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))


def opened(rows: DataFrame, columns: Sequence[str], **changed: Column) -> DataFrame:
    """The columns of a sealed ``row`` again, some of them changed."""
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding it."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Cut a partition that is sorted by ``keys`` into tables that hold whole groups."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        end = tuple(c[n - 1].as_py() for c in columns)
        same = np.ones(n, bool)
        for column, value in zip(columns, end, strict=True):
            same &= column.to_numpy(zero_copy_only=False) == value
        start = int(np.argmax(same))
        if start == 0 and (last is None or last == end):
            held.append(batch)
        else:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = [batch.slice(start)]
        last = end
    if held:
        yield pa.Table.from_batches(held)


def split_hot(rows: DataFrame, keys: Sequence[str], member: str, most: int) -> DataFrame:
    """Deal every group of ``keys`` out in tasks of bounded size, so that all pairs meet.

    Groups of one member vanish.  A group of up to ``most`` rows stays whole.  A larger one
    is cut into k parts by a hash of ``member``, and each pair of parts (k (k + 1) / 2 of
    them) becomes a group of its own: every pair of members meets, no task gets more than
    about twice ``most`` rows.  Adds the columns ``part_a`` and ``part_b``, and ``part``, the
    row's own one of the two.
    """
    together = Window.partitionBy(*keys)
    counted = rows.withColumn("_n", F.count(F.lit(1)).over(together)).where("_n > 1")
    parts = F.ceil(F.col("_n") / most).cast("int")
    own = F.pmod(F.xxhash64(F.lit(1), member), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b")),
    )
    return counted.select("*", F.explode(pairs).alias("_p")).select(
        *rows.columns, F.col("_p.a").alias("part_a"), F.col("_p.b").alias("part_b"), own.alias("part"))


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 under the given links, the smallest node of each one's component."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return root
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(root, high, low)
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """Connected components of ``links`` (columns a, b: long): one row (node, component) per
    linked node.  Node numbers must be hash-like; the component's is any one of its nodes.

    Each round points every node to the least node beside it, shortens the pointers once
    and merges nodes that share one.  Nodes disappear geometrically, whatever the shape:
    hubs are minima found by partial aggregation, chains break at random places.
    """
    a, b = F.col("a"), F.col("b")
    live = scratch.save(
        links.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(),
        f"{name}-0")
    steps: list[DataFrame] = []
    while live.head(1):
        k = len(steps) + 1
        near = live.union(live.select(b.alias("a"), a.alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
        first = scratch.save(near.select(F.col("a").alias("node"), F.least("a", "m").alias("to")), f"{name}-first-{k}")
        second = first.select(F.col("node").alias("to"), F.col("to").alias("then"))
        step = scratch.save(
            first.join(second, "to").select("node", F.col("then").alias("to")), f"{name}-step-{k}")
        steps.append(step)
        moved = (
            live.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        live = scratch.save(moved, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        scratch.drop(f"{name}-first-{k}")
    if not steps:
        return live.select(a.alias("node"), b.alias("component"))
    found = steps[0]
    for step in steps[1:]:
        found = found.join(
            step.select(F.col("node").alias("to"), F.col("to").alias("then")), "to", "left",
        ).select("node", F.coalesce("then", "to").alias("to"))
    return scratch.save(found.select("node", F.col("to").alias("component")), f"{name}-found")
