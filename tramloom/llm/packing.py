"""Best-fit packing by a configuration linear program.

Documents become token pieces of at most ``capacity``.  All that decides how many sequences
they need is the histogram of piece lengths, which has ``capacity`` entries at any size of
the corpus.  Over it, a configuration (how many pieces of which length share a sequence) is a
column of a covering program: use as few configurations as cover the histogram.

The program is solved by multiplicative weights.  Each length has a price that is multiplied
down as it gets covered; an unbounded-knapsack dynamic program finds the dearest
configuration, which is used and lowers the prices of its lengths.  The mixture is rounded
down to whole sequences; what is left is placed by best fit, longest first.

Only the histogram and the resulting plan (bounded by capacity and rounds) are on the driver.
Pieces are numbered within their length by a two-level count, and look up their slot by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import Scratch, binary_column, read_table
from tramloom.llm.tokens import ChunkedTokenizer

CAPACITY = 1024
END_ID = 2
ROUNDS = 300
#: Pieces of one length numbered by one task.
NUMBERED_ROWS = 5_000


# ------------------------------------------------------------------ pieces

def pieces(docs: DataFrame, tokenizer_file: str, ranks_file: str, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs``: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document's ids end with ``END_ID``.  One longer than ``capacity`` is cut into full
    pieces, counted from its end, so only its first piece may be shorter.  A null text is an
    empty one: a piece that holds the end id alone.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    names = schema.replace(",", "").split()[::2] + (["ids"] if with_ids else [])
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkedTokenizer.of(tokenizer_file, ranks_file)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(ids, binary_column(batch, "text"), strict=True):
                raw = tokenizer.id_bytes((text or b"").decode("utf-8", "replace")) + end
                total = len(raw) // 4
                first = (total - 1) % capacity + 1
                cuts = [0, *range(first, total + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = raw[4 * a:4 * b]
                    row = (doc_id, k, a, b - a, zlib.crc32(part)) + ((part,) if with_ids else ())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=False)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, schema + (", ids binary" if with_ids else ""))


# ------------------------------------------------------------------ the program

def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: how many pieces of each length make the dearest configuration.

    Among equally dear ones the longest piece is taken first."""
    value = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    lengths = np.nonzero(prices > 0)[0][::-1].copy()
    gains = prices[lengths]
    fitting = np.searchsorted(-lengths, -np.arange(capacity + 1))
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        at = fitting[room]
        if at < len(lengths):
            sums = value[room - lengths[at:]] + gains[at:]
            k = int(sums.argmax())
            if sums[k] > value[room]:
                value[room], choice[room] = sums[k], lengths[at + k]
    counts = np.zeros(capacity + 1, np.int64)
    room = capacity
    while room > 0:
        if choice[room]:
            counts[choice[room]] += 1
            room -= choice[room]
        else:
            room -= 1
    return counts


def mixture(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Fractional solution of the configuration program: configurations with their amounts.

    The amounts sum to the volume bound, one share of it per round.  A length's price starts
    near its size (long pieces a little dearer, as short ones fill gaps later) and is
    multiplied up or down as its demand lags behind or runs ahead of the rounds done.
    """
    wanted = np.nonzero(demand)[0]
    share = float((demand * np.arange(capacity + 1)).sum()) / capacity / rounds
    covered = np.zeros(capacity + 1)
    used: dict[bytes, float] = {}
    for done in range(rounds):
        prices = np.zeros(capacity + 1)
        lag = done / rounds - covered[wanted] / demand[wanted]
        prices[wanted] = (wanted / capacity) ** 1.1 * np.exp(np.clip(2.0 * lag, -30, 30))
        config = best_configuration(prices, capacity)
        covered += config * share
        key = config.tobytes()
        used[key] = used.get(key, 0.0) + share
    return [(np.frombuffer(k, np.int64), amount) for k, amount in used.items()]


def plan(demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[np.ndarray, int]]:
    """Whole configurations (counts per length, number of sequences) that hold ``demand`` exactly.

    The mixture is rounded down to what the demand allows; the rest goes by best fit, longest
    first, into gaps and new sequences.  Sequences of one content are handled as one group,
    so the work and the plan depend on capacity and rounds, not on the number of pieces.
    """
    left = demand.copy()
    sizes = np.arange(capacity + 1)
    open_groups: dict[int, list[tuple[np.ndarray, int]]] = {}
    done: list[tuple[np.ndarray, int]] = []

    def put(config: np.ndarray, times: int) -> None:
        gap = capacity - int((config * sizes).sum())
        if times > 0:
            (open_groups.setdefault(gap, []) if gap else done).append((config, times))

    for config, amount in mixture(left, capacity, rounds) if left.any() else []:
        inside = np.nonzero(config)[0]
        times = min(int(amount), int((left[inside] // config[inside]).min()))
        left[inside] -= times * config[inside]
        put(config, times)
    for length in range(capacity, 0, -1):
        while left[length]:
            gap = min((g for g, own in open_groups.items() if g >= length and own), default=None)
            if gap is None:
                config, times = np.zeros(capacity + 1, np.int64), int(left[length])
                room = capacity
            else:
                config, times = open_groups[gap].pop()
                room = gap
            each = min(room // length, int(left[length]))
            taken = min(times, int(left[length]) // each)
            if gap is not None:
                put(config, times - taken)
            config = config.copy()
            config[length] += each
            left[length] -= taken * each
            put(config, taken)
    return done + [entry for own in open_groups.values() for entry in own]


# ------------------------------------------------------------------ placing

def numbered(cut: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``place``: 0, 1, ... within each length.

    Each length is dealt out over buckets of bounded size; a bucket's first number is the
    count of the buckets before it.  A length that most pieces have is no hot group.
    """
    total = cut.count()
    buckets = max(1, -(-total // NUMBERED_ROWS))
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    return dealt.withColumn("_row", F.row_number().over(inside)).join(
        starts, ["length", "_bucket"]).withColumn(
        "place", F.col("_start") + F.col("_row") - 1).drop("_bucket", "_row", "_start")


def slots(entries: list[tuple[np.ndarray, int]], capacity: int) -> dict[int, np.ndarray]:
    """For each length its runs of slots, by first place: (place, sequence, per sequence, offset)."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    reached = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for config, times in entries:
        offset = 0
        for length in np.nonzero(config)[0][::-1].tolist():
            each = int(config[length])
            found.setdefault(length, []).append((int(reached[length]), sequence, each, offset))
            reached[length] += times * each
            offset += each * length
        sequence += times
    return {length: np.array(runs, np.int64) for length, runs in found.items()}


def pack(docs: DataFrame, tokenizer_file: str | None = None, ranks_file: str | None = None,
         capacity: int = CAPACITY, rounds: int = ROUNDS, with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` (columns doc_id, text) with their place in packed sequences.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).
    Every row is packed: null and empty texts are one end id, repeated rows are packed as
    often as they occur, null ids are carried along.  An empty table gives no sequence.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    cut = scratch.save(pieces(
        docs, tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"),
        ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity, with_ids), "pieces")
    demand = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        demand[row["length"]] = row["count"]
    runs = slots(plan(demand, capacity, rounds), capacity)

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def slot(lengths: pa.Array, places: pa.Array) -> pa.Array:
        size, place = lengths.to_numpy(zero_copy_only=False), places.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for length in np.unique(size).tolist():
            own = size == length
            table = runs[length]
            run = table[np.searchsorted(table[:, 0], place[own], "right") - 1]
            index = place[own] - run[:, 0]
            sequence[own] = run[:, 1] + index // run[:, 2]
            offset[own] = run[:, 3] + index % run[:, 2] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return numbered(cut, scratch).withColumn("_slot", slot("length", "place")).select(
        *cut.columns, "_slot.sequence_id", "_slot.offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in packed sequences."""
    return pack(read_table(spark, sf_dir, "documents"))
