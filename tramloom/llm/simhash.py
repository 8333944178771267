"""SimHash near-dedup with a Gray-order hierarchical index.

A text's fingerprint takes the majority of each bit over the hashes of its word shingles.
Fingerprints that differ in few bits are linked.  The index has two kinds of upper nodes:

* **Shared masked patterns.**  With at most d differing bits, two of d + 2 bit fields agree.
  For each pair of fields the agreeing bits are a node, and only fingerprints below the same
  node are compared.  Spark shuffles on this node.
* **Gray-order groups.**  Below a node, fingerprints are sorted by Gray rank, so neighbours
  share long patterns.  Runs of 32 form a leaf, runs of 8 leaves a node above, and so on;
  each keeps the bits all its members share.  Two groups are compared top down; the bits in
  which their shared patterns differ only accumulate on the way down, and the pair of groups
  is dropped as a whole once they exceed d.

A node with very many fingerprints is cut into parts whose pairs are separate groups.  Tasks
hand on a spanning forest of what they linked, not the links; distributed components join
the forests.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm.common import (
    Scratch, components, opened, read_table, roots, sealed, split_hot, whole_groups)

SHINGLE_WORDS = 4
MOST_BITS = 4
#: Fingerprints below one node that a task compares; nodes with more are cut up.
NODE_ROWS = 20_000
LEAF, FAN = 32, 8


def text_fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z in lower case, words between ASCII white space,
    repeats count; fewer words than a shingle are one shingle; no words give zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts[1:] = np.cumsum(lengths[:-1] + 1)
    ends = (starts + lengths)[shingle_words - 1:].tolist()
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest,
            [joined[i:j] for i, j in zip(starts.tolist(), ends, strict=False)], repeat(42)),
        np.uint64, len(ends))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint_column(shingle_words: int = SHINGLE_WORDS):
    """A function from a text column to its fingerprint, as a signed long."""
    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        found = np.fromiter(
            (text_fingerprint(t, shingle_words) for t in texts.cast(pa.binary()).to_pylist()),
            np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return fingerprint


def fields(count: int) -> list[int]:
    """Masks of ``count`` fields of nearly equal width that cover 64 bits."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def close_pairs(codes: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all pairs of ``codes`` that differ in at most ``most_bits`` bits,
    found through a tree over the codes in Gray order: indexes (i, j) of its links."""
    n = len(codes)
    order = np.argsort(gray_rank(codes), kind="stable")
    ranked = codes[order]
    leaves = -(-n // LEAF)
    padded = np.concatenate([ranked, np.repeat(ranked[-1:], leaves * LEAF - n)]).reshape(leaves, LEAF)
    levels = [(np.bitwise_and.reduce(padded, 1), np.bitwise_or.reduce(padded, 1))]
    while len(levels[-1][0]) > FAN:
        low, high = levels[-1]
        starts = np.arange(0, len(low), FAN)
        levels.append((np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)))
    top = len(levels[-1][0])
    a, b = np.triu_indices(top)
    for depth in range(len(levels) - 1, -1, -1):
        low, high = levels[depth]
        if depth < len(levels) - 1:
            a, b = np.repeat(a * FAN, FAN * FAN), np.repeat(b * FAN, FAN * FAN)
            a += np.tile(np.repeat(np.arange(FAN), FAN), len(a) // (FAN * FAN))
            b += np.tile(np.arange(FAN), len(b) // FAN)
            there = (a <= b) & (b < len(low))
            a, b = a[there], b[there]
        # Bits that all members of a group have, or all lack, and in which the groups differ.
        apart = (low[a] & ~high[b]) | (low[b] & ~high[a])
        near = np.bitwise_count(apart) <= most_bits
        a, b = a[near], b[near]
    root = np.arange(n)
    for at in range(0, len(a), 1024):
        x, y = a[at:at + 1024], b[at:at + 1024]
        apart = np.bitwise_count(padded[x][:, :, None] ^ padded[y][:, None, :])
        p, i, j = np.nonzero(apart <= most_bits)
        i, j = np.minimum(x[p] * LEAF + i, n - 1), np.minimum(y[p] * LEAF + j, n - 1)
        i, j = root[i], root[j]
        fresh = i != j
        if fresh.any():
            root = roots(n, np.concatenate([np.arange(n), i[fresh]]), np.concatenate([root, j[fresh]]))
    linked = np.nonzero(root != np.arange(n))[0]
    return order[linked], order[root[linked]]


def _linked(most_bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["mask", "pattern", "part_a", "part_b"]
        for table in whole_groups(batches, keys):
            codes = table.column("fp").to_numpy().view(np.uint64)
            columns = [table.column(k).to_numpy() for k in keys]
            fresh = np.ones(len(codes), bool)
            fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            group = np.cumsum(fresh) - 1
            size = np.bincount(group)[group]
            left: list[np.ndarray] = []
            right: list[np.ndarray] = []
            small = np.nonzero(size <= LEAF)[0]  # many tiny groups: compare by distance in the list
            for step in range(1, LEAF):
                i, j = small[:-step], small[step:]
                same = group[i] == group[j]
                if not same.any():
                    break
                i, j = i[same], j[same]
                near = np.bitwise_count(codes[i] ^ codes[j]) <= most_bits
                left.append(codes[i[near]])
                right.append(codes[j[near]])
            starts = np.nonzero(fresh)[0]
            for start in starts[size[starts] > LEAF]:
                own = codes[start:start + size[start]]
                i, j = close_pairs(own, most_bits)
                left.append(own[i])
                right.append(own[j])
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(codes: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within ``most_bits``."""
    masks = [x | y for x, y in combinations(fields(most_bits + 2), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    nodes = codes.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern"))
            for k, m in enumerate(signed)])).alias("node"),
    ).select("fp", "node.mask", "node.pattern")
    keys = ["mask", "pattern", "part_a", "part_b"]
    dealt = split_hot(nodes, ["mask", "pattern"], "fp", NODE_ROWS)
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _linked(most_bits), "a long, b long")


def groups(marked: DataFrame, most_bits: int, scratch: Scratch) -> DataFrame:
    """For ``marked`` (doc_id, fp): one row (fp, component, first_id) per fingerprint."""
    codes = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "codes")
    found = components(fingerprint_links(codes.select("fp"), most_bits), scratch)
    return codes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    most_bits: int = MOST_BITS) -> DataFrame:
    """One row (doc_id, fp, component_id) per row of ``docs`` (columns doc_id, text).

    component_id is the least doc_id that links of at most ``most_bits`` bits reach.  Null and
    empty texts have fingerprint zero and are linked like any other.  Rows with a null doc_id
    take part; their component_id is null only if nothing with an id is reachable.  Repeated
    rows are repeated in the result.  An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    mark = fingerprint_column(shingle_words)
    marked = scratch.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark("text").alias("fp")), "marked")
    grouped = groups(marked, most_bits, scratch)
    least = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                     most_bits: int = MOST_BITS) -> DataFrame:
    """The columns of ``docs``, one row of each group of near-duplicates: that of the least
    doc_id, ids that are null last; of rows with one id and one fingerprint, any one."""
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    mark = fingerprint_column(shingle_words)
    marked = scratch.save(
        docs.select(F.col("doc_id").cast("long").alias("_id"), mark("text").alias("_fp")), "marked")
    grouped = groups(marked.toDF("doc_id", "fp"), most_bits, scratch)
    best = F.min(F.struct(F.isnull("first_id").alias("none"), "first_id", "fp")).alias("best")
    winners = grouped.groupBy("component").agg(best).select(
        F.col("best.fp").alias("_fp"), F.col("best.first_id").alias("_id"))
    often = marked.groupBy(F.col("_fp").alias("_ofp"), F.col("_id").alias("_oid")).agg(
        F.count(F.lit(1)).alias("_n"))
    winners = scratch.save(
        winners.join(often, (F.col("_fp") == F.col("_ofp")) & F.col("_id").eqNullSafe(F.col("_oid")))
        .select("_ofp", "_oid", "_n"), "winners")
    kept = sealed(docs).withColumns({"_fp": mark("row.text"), "_id": F.col("row.doc_id").cast("long")}).join(
        winners, (F.col("_fp") == F.col("_ofp")) & F.col("_id").eqNullSafe(F.col("_oid")))
    once, more = kept.where("_n = 1"), kept.where("_n > 1").dropDuplicates(["_fp", "_id"])
    return opened(once, docs.columns).union(opened(more, docs.columns))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
