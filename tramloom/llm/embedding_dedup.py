"""Embedding near-dedup by a forest of random-projection trees.

Each tree splits the space again and again: a node has a random direction, and its vectors
go left or right of the median of their projections.  Those near the median, the spill, go
both ways, so close vectors seldom part; many trees make it rarer still.  Vectors that share
a leaf of any tree are compared exactly.

The splits are fitted on at most ``FIT_ROWS`` vectors, which bounds the model whatever the
table's size; every vector is indexed.  Equal vectors are one node with a count.  A pair that
meets in several leaves counts in the first one only, which both sides can tell from their
lists of leaves, so a leaf reports numbers of links and a spanning forest and never pairs.  A
leaf with very many vectors is dealt out as pairs of parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.llm.common import Scratch, components, read_table, roots, split_hot, whole_groups

COSINE = 0.95
TREES = 6
#: Bound of the vectors that the splits are fitted on.
FIT_ROWS = 20_000
#: A node of the fitted trees with fewer of these vectors is a leaf.
LEAF_FIT_ROWS = 60
#: Share of a node's vectors that go both ways.
SPILL = 0.1
#: Leaves with more vectors are dealt out.
LEAF_ROWS = 2_000
SEED = 3
_TILE = 512


class Tree:
    """Nodes by number: direction, the bounds of the spill around the median, children."""

    def __init__(self, sample: np.ndarray, seed: int, leaf_rows: int, spill: float):
        self.rng = np.random.default_rng(seed)
        self.directions: list[np.ndarray | None] = []
        self.bounds: list[tuple[float, float]] = []
        self.children: list[tuple[int, int]] = []
        self._grow(sample, np.arange(len(sample)), leaf_rows, spill)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, leaf_rows: int, spill: float) -> int:
        node = len(self.bounds)
        self.directions.append(None)
        self.bounds.append((0.0, 0.0))
        self.children.append((-1, -1))
        if len(rows) < 2 * leaf_rows:
            return node
        direction = self.rng.normal(size=sample.shape[1]).astype(np.float32)
        seen = sample[rows] @ direction
        low, middle, high = np.quantile(seen, [0.5 - spill / 2, 0.5, 0.5 + spill / 2])
        if not (seen < middle).any() or low == high:
            return node  # all alike: no split parts them
        self.directions[node], self.bounds[node] = direction, (float(low), float(high))
        left = self._grow(sample, rows[seen < middle], leaf_rows, spill)
        right = self._grow(sample, rows[seen >= middle], leaf_rows, spill)
        self.children[node] = (left, right)
        return node

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all rows; a row in the spill of a node goes on in both children."""
        rows, leaf = [], []
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, own = waiting.pop()
            if not len(own):
                continue
            if self.directions[node] is None:
                rows.append(own)
                leaf.append(np.full(len(own), node))
                continue
            seen = vectors[own] @ self.directions[node]
            low, high = self.bounds[node]
            left, right = self.children[node]
            waiting += [(left, own[seen <= high]), (right, own[seen >= low])]
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows), np.concatenate(leaf)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def identified(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (floats as they are, anything else as doubles) and id, a hash of the
    vector, which is null if the vector can't be compared: null or zero vectors, and those
    with null or non-finite components."""
    kind = vectors.schema["embedding"].dataType.elementType
    values = F.col("embedding") if isinstance(kind, T.FloatType) else F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    comparable = finite & F.exists("embedding", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding")).withColumn(
        "id", F.when(F.coalesce(comparable, F.lit(False)), F.xxhash64("embedding")))


def _doubles(lists: pa.ListArray, rows: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _indexed(trees: dict[int, list[Tree]]):
    """One row per vector and leaf; ``leaves`` lists all leaves of the vector, in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            embeddings, counts = batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(embeddings).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = np.nonzero(sizes == size)[0]
                part = embeddings.take(pa.array(own))
                vectors = unit(_doubles(part, len(own)))
                rows, leaf = [], []
                for k, tree in enumerate(trees[size]):
                    row, node = tree.leaves(vectors.astype(np.float32))
                    rows.append(row)
                    leaf.append((np.int64(size) << 40) + (np.int64(k) << 32) + node)
                row, leaf = np.concatenate(rows), np.concatenate(leaf)
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(own)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(leaf))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), pa.array(ids[own][row]), part.take(pa.array(row)), lists.take(pa.array(row)),
                     pa.array(counts[own][row])], ["leaf", "id", "embedding", "leaves", "n"])

    return run


def _compared(cosine: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["leaf", "part_a", "part_b"]
        for table in whole_groups(batches, keys):
            table = table.combine_chunks()
            leaf, a, b = (table.column(k).to_numpy() for k in keys)
            cuts = np.nonzero((leaf[1:] != leaf[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[0] + 1
            out: list[list[np.ndarray]] = [[], [], []]
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(leaf)], strict=True):
                part = table.slice(start, end - start)
                for column, found in zip(out, _links(part, cosine), strict=True):
                    column.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in out], ["a", "b", "links"])

    return run


def _links(part: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (id, another or the same id, links of id found here) of one group."""
    ids = part.column("id").to_numpy()
    n = len(ids)
    if n < 2:
        return ids[:0], ids[:0], ids[:0]
    here, own, other = (part.column(k)[0].as_py() for k in ("leaf", "part_a", "part_b"))
    side, counts = part.column("part").to_numpy(), part.column("n").to_numpy()
    vectors = unit(_doubles(part.column("embedding").combine_chunks(), n))
    earlier = [{x for x in leaves if x < here} for leaves in part.column("leaves").to_pylist()]
    links, root = np.zeros(n, np.int64), np.arange(n)
    for top in range(0, n, _TILE):
        for left in range(0, top + 1, _TILE):
            near = vectors[top:top + _TILE] @ vectors[left:left + _TILE].T >= cosine
            i, j = np.nonzero(near)
            i, j = i + top, j + left
            keep = i > j
            if own != other:  # pairs within a part belong to that part's own group
                keep &= side[i] != side[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            first = np.fromiter((earlier[x].isdisjoint(earlier[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)),
                                bool, len(i))
            np.add.at(links, i[first], counts[j[first]])
            np.add.at(links, j[first], counts[i[first]])
            x, y = root[i], root[j]
            fresh = x != y
            if fresh.any():
                root = roots(n, np.concatenate([np.arange(n), x[fresh]]), np.concatenate([root, y[fresh]]))
    told = np.nonzero((links > 0) | (root != np.arange(n)))[0]
    return ids[told], ids[root[told]], links[told]


def links(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other rows found at ``cosine`` or more; component_id is the least vec_id
    that links reach.  A vector that can't be compared (null, zero, null or non-finite
    components) has no links and is its own component.  Rows of one vec_id are separate
    vectors; ids that are null never are a component's least.  No rows give no result.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = identified(vectors)
    kind = rows.schema["embedding"].dataType.simpleString()
    classes = scratch.save(rows.where("id is not null").groupBy("id").agg(
        F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id")),
        "classes")
    sample = classes.select("embedding").orderBy(F.xxhash64(F.lit(SEED), "id")).limit(fit_rows).toArrow()
    by_size: dict[int, list] = {}
    for value in sample.column("embedding").to_pylist():
        by_size.setdefault(len(value), []).append(value)
    # Lengths of vectors, usually one.
    sizes = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    forest = {
        size: [Tree(unit(np.array(by_size.get(size) or [[1.0] * size])).astype(np.float32),
                    SEED * 1000 + k, LEAF_FIT_ROWS, SPILL) for k in range(trees)]
        for size in sizes}
    indexed = classes.select("id", "embedding", "n").mapInArrow(
        _indexed(forest), f"leaf long, id long, embedding {kind}, leaves array<long>, n long")
    keys = ["leaf", "part_a", "part_b"]
    dealt = split_hot(indexed, ["leaf"], "id", LEAF_ROWS)
    told = scratch.save(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _compared(cosine), "a long, b long, links long"), "told")
    found = components(told.where("a <> b").select("a", "b"), scratch)
    counted = told.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    named = classes.select("id", "n", "first_id").join(counted, "id", "left").join(
        found.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "component").select(
        "id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    joined = rows.select("vec_id", "id").join(named, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every row of ``embeddings``; labels play no part."""
    return links(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
