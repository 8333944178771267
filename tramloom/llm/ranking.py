"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in segments of bounded size: each distinct term of a segment has one
inverted list.  Terms belong to owners by the share of documents that hold them, rarest first.
Item bundles, one an item and segment, visit the owners in turn: each owner is a stage that
cogroups the bundles with its own lists and adds whole-number contributions to the bundles'
sparse document accumulators.  After the last owner each bundle gives its best documents, and
a window over all bundles of an item makes the final selection.

Between stages an item's tenth best partial score is known over all segments.  Scores only
grow, so a document whose score and all that later owners could still add stay below it
cannot be among the ten; its accumulator goes.  Nothing else is left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import Scratch, binary_column, read_table

TOP = 10
#: Documents of a segment; their places fit sixteen bits.
SEGMENT_DOCS = 8_192
#: Items that one task scores together.
BLOCK_ITEMS = 256
#: An owner holds the terms that less than this share of the documents hold; the last one the rest.
OWNER_SHARES = (1 / 256, 1 / 64, 1 / 16)
#: Bits of the filter that keeps most terms no item has out of the index: 512 KB at any size.
#: Terms that pass by chance vanish in the exact join with the items' terms.
FILTER_BITS = 1 << 22
_KNOWN_TERMS = 400_000
#: Bytes as they are compared: A-Z in lower case, what separates terms as a blank.
_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order: runs of ASCII letters and digits and of what is not ASCII."""
    return (text or b"").translate(_BYTES).split()


def _bucket(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) % FILTER_BITS


class _Wanted(dict):
    """Whether a term passes the filter, remembered for the terms seen last."""

    def __init__(self, bits: bytes):
        super().__init__()
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)

    def __missing__(self, term: bytes) -> bool:
        if len(self) >= _KNOWN_TERMS:
            self.clear()
        found = self[term] = bool(self.bits[_bucket(term)])
        return found


# ------------------------------------------------------------------ items

def _item_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = 0
    for batch in batches:
        ids, tasks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: list[list] = [[], [], [], [], [], [], []]
        for item, task, text in zip(ids, tasks, binary_column(batch, "text"), strict=True):
            for term, count in Counter(terms(text)).items():
                row = (task << 40 | place, task << 40 | place // BLOCK_ITEMS, item, term.decode("utf-8", "replace"),
                       count, _bucket(term) >> 15, _bucket(term) & 32767)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            ["item", "block", "item_id", "term", "often", "word", "bit"])


def item_terms(items: DataFrame, scratch: Scratch) -> DataFrame:
    """One row an item and distinct term: item (a number of its own), block, item_id, term, often."""
    return scratch.save(items.select(
        F.col("item_id").cast("long").alias("item_id"), F.spark_partition_id().cast("long").alias("task"), "text",
    ).mapInArrow(_item_rows, "item long, block long, item_id long, term string, often long, word long, bit long"),
        "items")


def term_filter(wanted: DataFrame) -> bytes:
    """The filter as a bitmap; the driver gets its bits, whatever the number of terms."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8).reshape(-1, 4096)
    for row in wanted.groupBy("word").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bits[row["word"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


# ------------------------------------------------------------------ index

def _segments(bits: bytes):
    """Rows of the index: the segment's documents (term null), then a list for each kept term."""
    schema = pa.schema([
        ("segment", pa.int64()), ("term", pa.string()), ("docs", pa.binary()), ("counts", pa.binary()),
        ("sizes", pa.binary()), ("ids", pa.list_(pa.int64())), ("with_terms", pa.int64()), ("n_terms", pa.int64()),
        ("df", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(bits)
        ids: list[int | None] = []
        sizes: list[int] = []
        lists: dict[bytes, tuple[list[int], list[int]]] = {}
        k, task = 0, 0

        def cut() -> pa.RecordBatch:
            nonlocal k
            # Places follow the ids, nulls last, so that equal scores are in order by place.
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            size = np.array(sizes, np.uint32)
            segment = task << 32 | k
            docs_, counts_, sizes_ = [], [], []
            for docs, counts in lists.values():
                at = place[docs]
                rank = np.argsort(at)
                docs_.append(at[rank].astype(np.uint16).tobytes())
                counts_.append(np.array(counts, np.uint32)[rank].tobytes())
                sizes_.append(size[docs][rank].tobytes())
            n = len(lists)
            batch = pa.RecordBatch.from_arrays([
                pa.array([segment] * (n + 1), pa.int64()),
                pa.array([None, *(t.decode("utf-8", "replace") for t in lists)], pa.string()),
                pa.array([None, *docs_], pa.binary()), pa.array([None, *counts_], pa.binary()),
                pa.array([None, *sizes_], pa.binary()),
                pa.array([[ids[i] for i in order]] + [None] * n, pa.list_(pa.int64())),
                pa.array([sum(map(bool, sizes))] + [None] * n, pa.int64()),
                pa.array([sum(sizes)] + [None] * n, pa.int64()),
                pa.array([None, *(len(d) for d, _ in lists.values())], pa.int64())], schema=schema)
            ids.clear()
            sizes.clear()
            lists.clear()
            k += 1
            return batch

        for batch in batches:
            tasks = batch.column(1)
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_column(batch, "text"), strict=True):
                own = terms(text)
                here = len(ids)
                ids.append(doc_id)
                sizes.append(len(own))
                for term, count in Counter(own).items():
                    if wanted[term]:
                        held = lists.get(term)
                        if held is None:
                            held = lists[term] = ([], [])
                        held[0].append(here)
                        held[1].append(count)
                if len(ids) == SEGMENT_DOCS:
                    task = tasks[0].as_py()
                    yield cut()
            if batch.num_rows:
                task = tasks[0].as_py()
        if ids:
            yield cut()

    return run


def index(docs: DataFrame, bits: bytes, scratch: Scratch) -> DataFrame:
    return scratch.save(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.spark_partition_id().cast("long").alias("task"), "text",
    ).mapInArrow(_segments(bits), "segment long, term string, docs binary, counts binary, sizes binary, "
                 "ids array<long>, with_terms long, n_terms long, df long"), "index")


def contributions(counts: np.ndarray, sizes: np.ndarray, with_terms: int, n_terms: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L, in whole numbers."""
    tf = counts.astype(np.int64)
    m = 25 + 75 * sizes.astype(np.int64) * with_terms // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _most(with_terms: int, n_terms: int):
    @F.arrow_udf("long")
    def most(counts: pa.Array, sizes: pa.Array) -> pa.Array:
        return pa.array([
            int(contributions(np.frombuffer(c, np.uint32), np.frombuffer(s, np.uint32), with_terms, n_terms).max())
            for c, s in zip(counts.to_pylist(), sizes.to_pylist(), strict=True)], pa.int64())

    return most


# ------------------------------------------------------------------ stages

_BUNDLE = "block long, segment long, item long, docs binary, scores binary, best array<long>"


def _stage(with_terms: int, n_terms: int, top: int, last: bool):
    """Adds one owner's contributions to the bundles of a block of items in a segment."""
    schema = pa.schema([
        ("block", pa.int64()), ("segment", pa.int64()), ("item", pa.int64()), ("docs", pa.binary()),
        ("scores", pa.binary()), ("best", pa.list_(pa.int64()))])

    def run(bundles: pa.Table, lists: pa.Table) -> pa.Table:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        bounds: dict[int, tuple[int, int]] = {}
        block = segment = 0
        for row in bundles.to_pylist():
            block, segment = row["block"], row["segment"]
            held[row["item"]] = (np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["scores"], np.int64))
            bounds[row["item"]] = (row["rest"], row["least"])
        gains: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for row in lists.to_pylist():
            block, segment = row["block"], row["segment"]
            docs = np.frombuffer(row["docs"], np.uint16)
            gain = row["weight"] * contributions(
                np.frombuffer(row["counts"], np.uint32), np.frombuffer(row["sizes"], np.uint32), with_terms, n_terms)
            for user in row["users"]:
                bounds[user["item"]] = (user["rest"], user["least"])
                gains.setdefault(user["item"], []).append((docs, gain * user["often"]))
        out: list[list] = [[], [], [], []]
        total = np.zeros(SEGMENT_DOCS, np.int64)
        for item in held.keys() | gains.keys():
            total[:] = 0
            if item in held:
                total[held[item][0]] = held[item][1]
            for docs, gain in gains.get(item, ()):
                total[docs] += gain  # a list names a document once
            rest, least = bounds[item]
            docs = np.nonzero(total)[0]
            scores = total[docs]
            if len(docs) > top:  # this segment's own tenth is a bound as well
                least = max(least, int(np.partition(scores, -top)[-top]))
            alive = scores + rest >= least
            docs, scores = docs[alive], scores[alive]
            if not len(docs):
                continue
            first = np.lexsort((docs, -scores))[:top]
            if last:
                docs, scores = docs[first], scores[first]
                first = np.arange(len(docs))
            for column, value in zip(out, (
                    item, docs.astype(np.uint16).tobytes(), scores.tobytes(), scores[first].tolist()), strict=True):
                column.append(value)
        n = len(out[0])
        return pa.Table.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(out[0], pa.int64()),
             pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()),
             pa.array(out[3], pa.list_(pa.int64()))], schema=schema)

    return run


def _tenths(bundles: DataFrame, top: int) -> DataFrame:
    """(item, least): the tenth (``top``-th) best partial score of the items that have so many."""
    best = bundles.select("item", F.explode("best").alias("score"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc()))
    return best.withColumn("_r", rank).where(f"_r <= {top}").groupBy("item").agg(
        F.min("score").alias("least"), F.count(F.lit(1)).alias("_n")).where(f"_n = {top}").select("item", "least")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents (doc_id, text) of each row of ``items`` (item_id, text).

    item_id, rank, doc_id, score.  Every row of either table stands for itself: repeated rows are
    found, or rank, as often as they occur; equal scores go by doc_id, null ids last.  Texts that
    are null or without terms are found by nothing and find nothing.  Empty tables give an empty
    result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")
    wanted = item_terms(items, scratch)
    stored = index(docs, term_filter(wanted), scratch)
    with_terms, n_terms = stored.where(F.col("term").isNull()).agg(
        F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not n_terms:
        return empty

    lists = stored.where(F.col("term").isNotNull())
    share = F.col("df") / F.lit(with_terms)
    owner = F.lit(len(OWNER_SHARES))
    for k in reversed(range(len(OWNER_SHARES))):
        owner = F.when(share < OWNER_SHARES[k], k).otherwise(owner)
    weight = F.floor(1000 * F.log(
        (2 * F.lit(with_terms) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    known = lists.groupBy("term").agg(
        F.sum("df").alias("df"), F.max(_most(with_terms, n_terms)("counts", "sizes")).alias("most"))
    plan = scratch.save(
        wanted.join(known, "term").select(
            "item", "block", "term", "often", owner.alias("owner"), weight.alias("weight"),
            (F.col("often") * weight * F.col("most")).alias("bound")), "plan")

    bundles = spark.createDataFrame([], _BUNDLE)
    for stage in range(len(OWNER_SHARES) + 1):
        last = stage == len(OWNER_SHARES)
        # What later owners can add at most, and the tenth best score so far.
        rest = plan.groupBy("item").agg(
            F.coalesce(F.sum(F.when(F.col("owner") > stage, F.col("bound"))), F.lit(0)).alias("rest"))
        bounds = rest.join(_tenths(bundles, top), "item", "left").select(
            "item", "rest", F.coalesce("least", F.lit(1)).cast("long").alias("least"))
        users = plan.where(F.col("owner") == stage).join(bounds, "item").groupBy("block", "term", "weight").agg(
            F.collect_list(F.struct("item", "often", "rest", "least")).alias("users"))  # at most BLOCK_ITEMS
        own = lists.select("segment", "term", "docs", "counts", "sizes").join(users, "term").drop("term")
        left = bundles.drop("best").join(bounds, "item")
        key = ["block", "segment"]
        made = left.groupBy(*key).cogroup(own.groupBy(*key)).applyInArrow(
            _stage(with_terms, n_terms, top, last), _BUNDLE)
        bundles = scratch.save(made, f"bundles-{stage}")
        if stage:
            scratch.drop(f"bundles-{stage - 1}")

    tens = _unpacked(bundles.select("item", "segment", "docs", "scores"))
    places = stored.where(F.col("term").isNull()).select("segment", "ids")
    named = tens.join(places, "segment").select("item", F.get("ids", F.col("doc")).alias("doc_id"), "score")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = wanted.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _unpacked(bundles: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, segments, docs, scores = (c.to_pylist() for c in batch.columns)
            n = [len(s) // 8 for s in scores]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array(items, np.int64), n)),
                pa.array(np.repeat(np.array(segments, np.int64), n)),
                pa.array(np.frombuffer(b"".join(docs), np.uint16).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(scores), np.int64))], ["item", "segment", "doc", "score"])

    return bundles.mapInArrow(run, "item long, segment long, doc int, score long")


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
