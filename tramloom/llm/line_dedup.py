"""Line dedup by a segment-partition edit join.

Two lines within edit distance t share one of t + 1 segments: cut one line into t + 1 parts,
and at most t of them can be touched by t edits.  So each line is indexed under its segments,
with its length, and looks up those of its own substrings that could be a segment of a line
that is up to t characters shorter; t grows with the length of the shorter line.  Where a
segment may start is bounded by the shift that the edits to its left and to its right allow.  Lines that meet are verified by banded
bit-parallel edit distance; linked lines form classes.

Copies of a line are one node from the start.  Lookups that find no second line end in the
shuffle by segment; only lines that met another are fetched as text.  A segment that very
many lines share is dealt out as pairs of parts.  Every pair that meets is verified, and counted
under the first segment that it shares; a task hands on what connects its lines and each line's
number of links, not every pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import (
    Scratch, components, opened, read_table, sealed, split_hot, whole_groups)

EDITS = 2
#: Shorter lines have no row: blank ones only.
LEAST_CHARS = 1
#: One edit for so many characters of a pair's shorter line, up to ``EDITS``: short lines differ
#: by little by chance, so they are linked to equal ones only.
CHARS_PER_EDIT = 20
#: Lines below one segment that a task compares; segments with more are dealt out.
SEGMENT_ROWS = 2_000
_SEEN_LINES = 200_000


# ------------------------------------------------------------------ comparing

def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance of two texts is at most ``most``.

    What both begin and end with is cut off.  The rest is compared column by column; only the
    2 ``most`` + 2 cells around the diagonal are kept, as bits of vertical differences.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    if a == b:
        return True
    low, high = 0, len(b)
    while low < high:  # longest common beginning, by halves
        half = (low + high + 1) // 2
        if a.startswith(b[:half]):
            low = half
        else:
            high = half - 1
    a, b = a[low:], b[low:]
    low, high = 0, len(b)
    while low < high:
        half = (low + high + 1) // 2
        if a.endswith(b[len(b) - half:]):
            low = half
        else:
            high = half - 1
    a, b = a[:len(a) - low], b[:len(b) - low]
    if not b or len(a) <= most:
        return len(a) <= most
    if not most:
        return False
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << i
    # Bit k of a column's band is row (column - most - 1 + k); the top bit is the lowest diagonal.
    width = 2 * most + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    plus, minus = full & ~((1 << (width - most - 1)) - 1), 0
    distance, rows = most, len(a)
    side = top >> 1
    for column, char in enumerate(b):
        shift = column - most - 1
        match = places.get(char, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & full
        diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & full
        right_plus = (minus | ~(diagonal | plus)) & full
        right_minus = diagonal & plus
        if column + most < rows:
            distance += not diagonal & top
        else:
            distance += bool(right_plus & side) - bool(right_minus & side)
            side >>= 1
        if distance > 2 * most + len(a) - len(b):
            return False
        plus = (right_minus | ~((diagonal >> 1) | right_plus)) & full
        minus = (diagonal >> 1) & right_plus
    return distance <= most


# ------------------------------------------------------------------ segments

def segments(length: int, count: int) -> list[tuple[int, int]]:
    """(start, size) of ``count`` parts of nearly equal size, the longer ones last."""
    size, longer = divmod(length, count)
    found, start = [], 0
    for i in range(count):
        own = size + (i >= count - longer)
        found.append((start, own))
        start += own
    return found


def allowed(length: int, edits: int) -> int:
    """Edits between a line of ``length`` characters and one that is not shorter."""
    return min(edits, length // CHARS_PER_EDIT)


def lookups(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(segment, line length, start, size) of the substrings that a line has to look up.

    For a shorter line by d characters, segment i (from 0) may have moved by at most i edits
    on its left, and by at most ``edits`` - i edits on its right, seen from the end.
    """
    found = []
    for shorter in range(edits + 1):
        found += lookups_of(length, length - shorter, edits)
    return found


def lookups_of(length: int, other: int, edits: int) -> list[tuple[int, int, int, int]]:
    """Those of ``lookups`` that are for lines of ``other`` characters, which is not more."""
    found, shorter = [], length - other
    for i, (start, size) in enumerate(segments(other, edits + 1)):
        low = max(0, start - i, start + shorter - (edits - i))
        high = min(length - size, start + i, start + shorter + (edits - i))
        found += [(i, other, at, size) for at in range(low, high + 1)]
    return found


def scaled_lookups(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """``lookups`` at the edits that each length allows; equal lines need none."""
    found = []
    for other in range(length, max(0, length - edits) - 1, -1):
        own = allowed(other, edits)
        if own and length - other <= own:
            found += lookups_of(length, other, own)
    return found


@lru_cache(1 << 16)
def windows_of(length: int, other: int, edits: int) -> tuple[tuple[int, int, int, int], ...]:
    """``lookups_of`` by segment: (start in the shorter line, size, first and last place in the longer one)."""
    found = lookups_of(length, other, edits)
    places = [[at for i, _, at, _ in found if i == own] for own in range(edits + 1)]
    return tuple((start, size, at[0] if at else 0, at[-1] if at else -1)
                 for (start, size), at in zip(segments(other, edits + 1), places, strict=True))


def first_meeting(short: str, long: str, edits: int) -> tuple[int, str] | None:
    """Number and text of the first segment by which two lines meet; ``short`` is not the longer one.

    Equally long lines are both indexed, so either one's segment may be found in the other.
    """
    equal = len(short) == len(long)
    for i, (start, size, low, high) in enumerate(windows_of(len(long), len(short), allowed(len(short), edits))):
        own, other = short[start:start + size], long[start:start + size]
        met = [own] if any(long.startswith(own, at) for at in range(low, high + 1)) else []
        if equal and own != other and any(short.startswith(other, at) for at in range(low, high + 1)):
            met.append(other)
        if met:
            return i, min(met)
    return None


def segment_key(length: int, i: int, segment: str) -> int:
    """Signed 64-bit key of segment ``i`` of a line of ``length`` characters."""
    key = xxhash.xxh64_intdigest(f"{length}:{i}:{segment}".encode("utf-8", "surrogatepass"))
    return key - (1 << 64) if key >> 63 else key


def _segment_rows(edits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        plans: dict[int, list[tuple[int, int, int, int]]] = {}
        for batch in batches:
            keys, owners, indexed = [], [], []
            for h, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if h in seen:
                    continue
                if len(seen) >= _SEEN_LINES:
                    seen.clear()
                seen.add(h)
                n = len(line)
                if n not in plans:
                    plans[n] = scaled_lookups(n, edits)
                own = segments(n, allowed(n, edits) + 1)
                for i, other, at, size in plans[n]:
                    keys.append(segment_key(other, i, line[at:at + size]))
                    owners.append(h)
                    indexed.append(other == n and at == own[i][0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(owners, pa.int64()), pa.array(indexed, pa.bool_())],
                ["key", "h", "indexed"])

    return run


_FOUND = "a long, b long, partners long, copies long"


def _linked(edits: int):
    """Links (a, b) that connect the lines of each group, and for each linked line ``a`` how many
    ``partners`` (lines, copies included) it was counted with, beside its own ``copies``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "part_a", "part_b"]
        for table in whole_groups(batches, keys):
            rows = zip(*[table.column(c).to_pylist() for c in [*keys, "part", "h", "indexed", "line", "copies"]],
                       strict=True)
            links, counts = [], []
            for (key, part_a, part_b), group in groupby(rows, key=lambda r: r[:3]):
                lines = [r[3:] for r in group]
                root = list(range(len(lines)))
                partners = [0] * len(lines)

                def find(i: int) -> int:
                    while root[i] != i:
                        root[i] = root[root[i]]
                        i = root[i]
                    return i

                for i, (part, h, indexed, line, copies) in enumerate(lines):
                    if not indexed:
                        continue
                    most = allowed(len(line), edits)
                    own = next(((k, line[s:s + n]) for k, (s, n) in enumerate(segments(len(line), most + 1))
                                if segment_key(len(line), k, line[s:s + n]) == key), None)
                    for j, (other_part, other_h, other_indexed, other, other_copies) in enumerate(lines):
                        # Two indexed lines are looked at once; lines of one part meet where it is alone.
                        if (j <= i and other_indexed) or (part_a != part_b and part == other_part):
                            continue
                        if not 0 <= len(other) - len(line) <= most or not within(line, other, most):
                            continue
                        if first_meeting(line, other, edits) != own:
                            continue
                        partners[i] += other_copies
                        partners[j] += copies
                        a, b = find(i), find(j)
                        if a != b:
                            root[b] = a
                            links.append((h, other_h, None, None))
                counts += [(r[1], None, n, r[4]) for r, n in zip(lines, partners, strict=True) if n]
            columns = list(zip(*links, *counts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns or [()] * 4], ["a", "b", "partners", "copies"])

    return run


# ------------------------------------------------------------------ documents

def lines_of(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, text_hash, line_no, h, line: the lines that are compared, without outer blanks.

    ``h`` is a hash of the line.  Lines shorter than ``least_chars`` and null texts have none.
    """
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    line = split.withColumn("line", F.trim("raw", F.lit(" \t\r"))).where(F.length("line") >= least_chars)
    return line.select("doc_id", "text_hash", "line_no", F.xxhash64("line").alias("h"), "line")


def line_links(lines: DataFrame, scratch: Scratch, edits: int = EDITS) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of hashes that connect all ``lines`` (h, line) within the edits their length
    allows, and for each line h that has a link to a different one its number of links n_links:
    all other lines, copies of itself and of others included, that it is linked to directly."""
    looked_up = lines.select("h", "line").mapInArrow(
        _segment_rows(edits), "key long, h long, indexed boolean").repartition("key")
    met = Window.partitionBy("key")
    several = (
        looked_up.groupBy("key", "h").agg(F.max("indexed").alias("indexed"))
        .withColumns({"_min": F.min("h").over(met), "_max": F.max("h").over(met),
                      "_any": F.max("indexed").over(met)})
        .where("_min <> _max and _any").select("key", "h", "indexed"))
    found = scratch.save(several, "met")
    wanted = found.select("h").distinct()
    texts = scratch.save(
        lines.select("h", "line").join(wanted, "h", "left_semi").groupBy("h").agg(
            F.first("line").alias("line"), F.count(F.lit(1)).alias("copies")), "texts")
    dealt = split_hot(found, ["key"], "h", SEGMENT_ROWS).join(texts, "h")
    keys = ["key", "part_a", "part_b"]
    near = scratch.save(
        dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_linked(edits), _FOUND), "near")
    counts = near.where("b is null").groupBy(F.col("a").alias("h")).agg(
        (F.sum("partners") + F.max("copies") - 1).alias("n_links"))
    return near.where("b is not null").select("a", "b"), counts


def line_classes(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per compared line: doc_id, text_hash, line_no, n_links, class_doc_id, class_line_no, kept.

    A class is what links of at most ``edits`` edits, fewer between short lines, connect; equal
    lines of any length are in one.  n_links counts the other lines that a line is linked to
    directly, equal ones included.  Blank lines have no row.  A class's first line, by doc_id (null
    last) and line number, is kept.  Repeated rows of a document have equal lines at equal
    places; they are treated alike.  Lines are numbered from 0.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = lines_of(docs, least_chars)
    links, counts = line_links(lines, scratch, edits)
    found = components(links, scratch).withColumnRenamed("node", "h").join(counts, "h")
    placed = lines.select("doc_id", "text_hash", "line_no", "h").join(found, "h", "left").select(
        "doc_id", "text_hash", "line_no", F.coalesce("component", "h").alias("class"), "n_links")
    placed = scratch.save(placed, "placed")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "line_no")
    # Written, so that both sides of the join are plain exchanges and a hot class can be split.
    first = scratch.save(placed.groupBy("class").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("size")), "first")
    return placed.join(first, "class").select(
        "doc_id", "text_hash", "line_no", F.coalesce("n_links", F.col("size") - 1).alias("n_links"),
        F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.line_no").alias("class_line_no"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no")))
        .alias("kept"))


def without_duplicate_lines(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with the same columns, without lines that repeat the first line of their class.

    A document of which only blank lines are left goes.  Documents that lose nothing stay as
    they are, empty and null texts among them.  n_chars, where there is such a column, is
    that of the new text.
    """
    gone = line_classes(docs, edits, least_chars).where(~F.col("kept")).groupBy(
        F.col("doc_id").alias("_gid"), F.col("text_hash").alias("_ghash")).agg(
        F.collect_set("line_no").alias("_gone"))
    joined = sealed(docs).join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("_gid"))
                               & (F.xxhash64("row.text") == F.col("_ghash")), "left")
    whole, same = F.col("row.text"), F.col("_gone").isNull()
    lines = F.split(whole, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.when(same, whole).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    cut = joined.withColumn("text", text).where(same | (F.length(F.trim("text", F.lit(" \t\r\n"))) > 0))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))
    return opened(cut, docs.columns, **changed)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every line that is not blank."""
    return line_classes(read_table(spark, sf_dir, "documents")).drop("text_hash")
