"""Document fingerprints: threshold-scaled sketches.

A text's sketch keeps the hash of every word shingle below a fixed fraction of the hash
range.  Whether a hash is kept depends on nothing else, so sketches of parts merge by union,
and two sketches hold comparable samples however unequal their texts are.  A short text keeps
at least its ``FLOOR`` least hashes; which threshold a sketch was cut at follows from its
size, and two sketches are compared at the lower of theirs.

Shingles begin before the text: the first holds one word after empty places, so that a text
of any length has as many shingles as words.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.llm.common import Scratch, read_table, shuffle_partitions

SHINGLE_WORDS = 5
#: Hashes have 32 bits; those below 1 / SCALE of the range are kept.
SCALE = 8
FLOOR = 16
SEED = 5


def sketch(text: bytes | None, shingle_words: int = SHINGLE_WORDS, scale: int = SCALE,
           floor: int = FLOOR) -> np.ndarray:
    """Sorted hashes of a UTF-8 text; A-Z in lower case.  No words, no hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint32)
    padded = b"\n" * (shingle_words - 1) + b"\n".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lengths = np.concatenate([np.zeros(shingle_words - 1, np.int64), lengths])
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    ends = (starts + lengths)[shingle_words - 1:].tolist()
    hashes = np.unique(np.fromiter(
        map(xxhash.xxh32_intdigest,
            [padded[i:j] for i, j in zip(starts.tolist(), ends, strict=False)], repeat(SEED)),
        np.uint32, len(ends)))
    below = int(np.searchsorted(hashes, (1 << 32) // scale))
    return hashes[:max(below, floor)]


def cut_at(hashes: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> int:
    """The bound below which a sketch holds all hashes of its text."""
    fraction = (1 << 32) // scale
    if len(hashes) < floor:
        return 1 << 32
    return max(fraction, int(hashes[-1]) + 1) if len(hashes) == floor else fraction


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> np.ndarray:
    """The sketch of two texts together (but for shingles across their seam)."""
    bound = min(cut_at(a, scale, floor), cut_at(b, scale, floor))
    both = np.union1d(a, b)
    below = int(np.searchsorted(both, max((1 << 32) // scale, 0)))
    return both[:max(below, min(floor, int(np.searchsorted(both, bound))))]


def compared(a: np.ndarray, b: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> tuple[float, float, float]:
    """(Jaccard likeness, share of a in b, share of b in a), all estimates from 0 to 1.

    Two sketches without hashes are alike; one without is unlike any other.
    """
    bound = min(cut_at(a, scale, floor), cut_at(b, scale, floor))
    a, b = a[:int(np.searchsorted(a, bound))], b[:int(np.searchsorted(b, bound))]
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same, same
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common), common / len(a), common / len(b)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


@F.arrow_udf(T.BinaryType())
def sketch_column(texts: pa.Array) -> pa.Array:
    """A text column's sketches, as little-endian unsigned 32-bit hashes in order."""
    return pa.array([sketch(t).astype("<u4").tobytes() for t in _texts(texts)], pa.binary())


@F.arrow_udf(T.DoubleType())
def likeness(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaccard likeness of two columns of sketches."""
    pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
    return pa.array([compared(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"))[0] for a, b in pairs],
                    pa.float64())


@F.arrow_udf(T.StructType().add("in_other", T.DoubleType()).add("of_other", T.DoubleType()))
def containment(left: pa.Array, right: pa.Array) -> pa.Array:
    """Shares of either sketch's text that the other one contains."""
    pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
    found = [compared(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")) for a, b in pairs]
    return pa.StructArray.from_arrays(
        [pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64())],
        ["in_other", "of_other"])


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text, sketch and next_text, next_sketch of every row, a null text as empty.

    The next row is that of the next lower doc_id (null ids last, equal ids by text); after
    the last one comes the first.  Rows are dealt out by ranges of ids, so each range finds
    its next rows by itself; the first row of each range is the next of the range before.
    """
    # Several a task, so that tasks get about equally much.
    ranges = 4 * shuffle_partitions(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # One number a range.
    bounds = texts.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    edges = np.unique(np.array(bounds, np.int64))

    @F.arrow_udf("int")
    def number(ids: pa.Array) -> pa.Array:
        """Ranges are numbered from high ids to low ones; null ids are the last."""
        place = len(edges) - np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        none = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array(np.where(none, len(edges) + 1, place).astype(np.int32))

    dealt = texts.withColumn("range", number("doc_id"))
    # The first row of each range: its greatest id, then the rows of these ids only.
    tops = dealt.groupBy("range").agg(F.max("doc_id").alias("top")).select(F.col("range").alias("_r"), "top")
    # One id a range is broadcast, so no text moves for it.
    heads = dealt.join(F.broadcast(tops), (F.col("range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("top")))
    first = scratch.save(
        heads.groupBy("range").agg(F.max("text").alias("text")).withColumn("sketch", sketch_column("text")),
        "heads")
    # One row a range, with the head of the range after it; the last one gets the very first.
    ahead = Window.partitionBy(F.lit(0)).orderBy("range")
    head = F.struct("text", "sketch")
    following = scratch.save(first.select(
        F.col("range").alias("_r"),
        F.coalesce(F.lead(head).over(ahead), F.first(head).over(ahead)).alias("head")), "following")
    inside = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    step = dealt.withColumn("sketch", sketch_column("text")).withColumns({
        "_text": F.lead("text").over(inside), "_sketch": F.lead("sketch").over(inside)})
    return step.join(following, (F.col("range") == F.col("_r")) & F.col("_sketch").isNull(), "left").select(
        "doc_id", "text", "sketch", F.coalesce("_text", "head.text").alias("next_text"),
        F.coalesce("_sketch", "head.sketch").alias("next_sketch"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last third replaced by as many first characters of ``other``, or all."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(other, F.lit(1), third))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and what they are like.

    A null text is empty.  Repeated rows are neighbours of each other.  Equal texts have equal
    fingerprints, empty texts the empty one.  No rows give an empty result.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = with_next(docs, Scratch(spark, "sketches"))
    changed = pairs.withColumn("_edited", edited(F.col("text"), F.col("next_text"))).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"), "sketch", "next_sketch",
        sketch_column("_edited").alias("_edited_sketch"))
    return changed.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("sketch")).alias("fingerprint"),
        F.lower(F.hex("_edited_sketch")).alias("edited_fingerprint"),
        likeness("sketch", "_edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"))
