"""Quality by an interpolated modified Kneser-Ney model of words, trained on trusted text.

The model's units are words (what stands between ASCII white space, A-Z lower-cased, known by
64-bit hashes) in n-grams of two; one marker stands before and after a text.  Tasks count the
word pairs of all trusted texts; the counts are summed in shards by pair.  The lower order
counts in how many different contexts a word was seen.  Pair counts are joined with the totals
and the kept-back mass of their contexts and with the lower order, shard by shard.  Below the
lowest order a word is spelled: its characters' Kneser-Ney n-grams of ``ORDER`` give it a
probability, so that words never seen have one.  There characters count by class, and a class
shares its probability among its members.

The logarithm of a text's probability is a sum over its words as if none were known, to which
every known word and every known pair adds a gain.  So each document's distinct words and
pairs are joined with the sharded table of gains, and the gains summed by document.  That
takes ``PASSES`` passes by hash, so that only a part of the rows lies on disk at a time; what
takes more than one part in ``COMMON`` of all words or pairs is looked up in the tasks instead.
Sums are whole millionths, the same in whatever order.

A document is kept up to a quantile of the perplexities (a character) of trusted documents in
its language.  A trusted text is scored as if words and pairs that it alone holds were unknown,
so that its perplexity compares with that of texts the model was not trained on.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm.common import Scratch, binary_column, read_table

#: Characters in an n-gram of the spelling model, and classes of characters.
ORDER = 4
SYMBOLS = 40
#: Parts by hash in which pairs are counted and joined, one after the other; a power of two.
PASSES = 8
#: Words and pairs that take at least one part in so many of all are looked up without a join.
COMMON = 65_536
#: Logarithms are kept as whole parts of one in so many.
UNIT = 1_000_000
#: Bytes of text that a task takes apart at once.
CHUNK_BYTES = 2_000_000
#: Documents above this quantile of trusted perplexities of their language are not kept.
QUANTILE = 0.995
#: Trusted documents that a language needs for a threshold of its own.
LEAST_TRUSTED = 20
#: Precision of the quantile: one part in so many of the rows.
ACCURACY = 100_000

#: Fixed classes of the first code points; the others fall in the last eight by their number.
_CLASSES = np.full(128, 31, np.int64)
_CLASSES[:32] = 0
_CLASSES[ord(" ")] = 1
for _i in range(26):
    _CLASSES[ord("a") + _i] = _CLASSES[ord("A") + _i] = 2 + _i
_CLASSES[ord("0"):ord("9") + 1] = 28
_CLASSES[ord(".")], _CLASSES[ord(",")] = 29, 30
#: Logarithm of the number of characters a class of ASCII has in lower-cased words.
_MEMBERS = np.zeros(32)
_MEMBERS[[0, 28, 31]] = np.log([26, 10, 31])


def symbols(text: str) -> np.ndarray:
    """Classes of the characters: lines and control characters 0, blank 1, letters 2-27 (either
    case), digits 28, full stop 29, comma 30, other ASCII 31, all else 32-39."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points < 128, _CLASSES[np.minimum(points, 127)], 32 + points % 8)


def members(text: str) -> np.ndarray:
    """Minus the logarithm of each character's share of its class, if A-Z are lower-cased: even in
    ASCII, beyond it falling with the code point (every eighth inverse, to U+10FFFF, adds up to
    the logarithm below)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_classes = _MEMBERS[np.minimum(symbols(text), 31)]
    return np.where(points < 128, ascii_classes, np.log(np.maximum(points, 1) * (np.log(0x110000 / 120) / 8)))


def grams(text: str, order: int = ORDER) -> np.ndarray:
    """The code of the n-gram that ends at each character; before the text stand line ends."""
    own = np.concatenate([np.zeros(order - 1, np.int64), symbols(text)])
    code = np.zeros(len(text), np.int64)
    for k in range(order):
        code = code * SYMBOLS + own[k:k + len(text)]
    return code


def counted(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """gram and n over all rows of ``texts`` (column text); summed in each task beforehand."""
    size = SYMBOLS ** order

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    np.add.at(total, grams(text, order), 1)
        seen = np.nonzero(total)[0]
        for start in range(0, len(seen), 50_000):
            part = seen[start:start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["gram", "n"])

    return texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of n-grams seen once, twice and more often."""
    row = counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    one, two = row[0], row[1]
    if not one or not two:
        return [0.5, 0.75, 0.9]
    y = one / (one + 2 * two)
    found = [k - (k + 1) * y * row[k] / row[k - 1] if row[k - 1] else 0.9 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]


def probabilities(counts: DataFrame, scratch: Scratch, order: int = ORDER) -> np.ndarray:
    """Natural logarithm of the probability of every n-gram's last symbol, seen or not."""
    by_order = {order: scratch.save(counts, f"counts-{order}")}
    for k in range(order - 1, 0, -1):
        shorter = (F.col("gram") % SYMBOLS ** k).alias("gram")
        by_order[k] = scratch.save(
            by_order[k + 1].groupBy(shorter).agg(F.count(F.lit(1)).alias("n")), f"counts-{k}")
    lower = np.full(1, 1.0 / SYMBOLS)  # below the first order all symbols are equally likely
    for k in range(1, order + 1):
        one, two, more = discounts(by_order[k])
        discount = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
        context = F.floor(F.col("gram") / SYMBOLS).cast("long")
        totals = by_order[k].groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), F.sum(discount).alias("kept_back"))
        seen = by_order[k].select("gram", "n", context.alias("context")).join(totals, "context").select(
            "gram", "context", (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("share"),
            (F.col("kept_back") / F.col("total")).alias("back")).toArrow()  # at most SYMBOLS ** k rows
        back = np.ones(SYMBOLS ** (k - 1))
        share = np.zeros(SYMBOLS ** k)
        share[seen.column("gram").to_numpy()] = seen.column("share").to_numpy()
        back[seen.column("context").to_numpy()] = seen.column("back").to_numpy()
        every = np.arange(SYMBOLS ** k)
        lower = share + back[every // SYMBOLS] * lower[every % len(lower)]
    return np.log(lower).astype(np.float32)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that some label calls good and none calls bad."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("_good")).where("_good = 1").select(F.col("doc_id").alias("_trusted"))


class Taken(NamedTuple):
    """Texts taken apart: their different words, and the two words of every pair with its text."""

    words: list[bytes]
    hashes: np.ndarray
    first: np.ndarray
    second: np.ndarray
    text: np.ndarray


def taken_apart(texts: Sequence[bytes | None]) -> Taken:
    """Word 0 is the marker (no bytes) before and after each text; texts without words have no pairs."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    rows, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    ends = [numbers[b""]]
    for k, text in enumerate(texts):
        words = text.lower().split() if text else None  # bytes: ASCII letters and white space
        if words:
            sizes[k] = len(words) + 1
            rows.append(np.array([0, *map(numbers.__getitem__, words)], np.int64))
            ends.append(0)
    first = np.concatenate(rows)
    second = np.append(first, 0)[1:] if len(first) else first
    hashes = hash_array(np.array(list(numbers), object), categorize=False).view(np.int64)
    return Taken(list(numbers), hashes, first, second, np.repeat(np.arange(len(texts)), sizes))


def pair_code(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two words' hashes."""
    x = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(32))).astype(np.int64)


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Rows with their texts (column text), about ``CHUNK_BYTES`` of text at a time."""
    for batch in batches:
        texts = binary_column(batch, "text")
        sizes = np.array([len(t or b"") for t in texts], np.int64)
        part = (2 * np.cumsum(sizes) - sizes) // (2 * CHUNK_BYTES)  # a text of twice the size stands alone
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start < end:
                yield batch.slice(start, end - start), texts[start:end]


def spelled(words: Sequence[bytes], table: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Logarithm, in units, of the probability of each word's characters and a blank after them."""
    own = [w.decode("utf-8", "replace") for w in words]
    text = "".join("\n" * (order - 1) + w + " " for w in own)
    logs = table[grams(text, order)].astype(np.float64) - members(text)
    sizes = np.array([len(w) + order for w in own], np.int64)
    starts = np.cumsum(sizes) - sizes
    logs[np.arange(len(text)) - np.repeat(starts, sizes) < order - 1] = 0  # line ends before the word
    return np.rint(np.add.reduceat(logs, starts) * UNIT).astype(np.int64)


def word_counts(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """word (its hash), seen and spelled of all words of ``texts``, the marker included."""
    sent = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in chunks(batches):
            taken = taken_apart(own)
            seen = np.bincount(taken.first, minlength=len(taken.words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (taken.hashes, seen, spelled(taken.words, sent.value))],
                ["word", "seen", "spelled"])

    return texts.select("text").mapInArrow(run, "word long, seen long, spelled long").groupBy("word").agg(
        F.sum("seen").alias("seen"), F.min("spelled").alias("spelled")).where("seen > 0")


def pair_counts(texts: DataFrame, part: int) -> DataFrame:
    """first, second (hashes of words) and n of the pairs of ``texts`` in one of ``PASSES`` parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in chunks(batches):
            taken = taken_apart(own)
            mine = pair_code(taken.hashes[taken.first], taken.hashes[taken.second]) % PASSES == part
            pairs, n = np.unique(
                taken.first[mine] * len(taken.words) + taken.second[mine], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (taken.hashes[pairs // len(taken.words)],
                                       taken.hashes[pairs % len(taken.words)], n)], ["first", "second", "n"])

    return texts.select("text").mapInArrow(run, "first long, second long, n long").groupBy(
        "first", "second").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """Gains of the known words and pairs by part: code, seen and gain in units; the logarithm
    of what the lower order keeps back for words never seen; the spelling model's table."""

    gains: list[DataFrame]
    unseen: int
    table: np.ndarray


def trained(texts: DataFrame, scratch: Scratch, table: np.ndarray) -> Model:
    """The model of all ``texts`` (column text), above the spelling model ``table``."""
    words = scratch.save(word_counts(texts, table), "words")
    parts = [scratch.save(pair_counts(texts, k), f"pairs-{k}") for k in range(PASSES)]
    pairs = parts[0]
    for other in parts[1:]:
        pairs = pairs.union(other)

    def kept_back(n: str, found: list[float]) -> Column:
        return F.when(F.col(n) == 1, found[0]).when(F.col(n) == 2, found[1]).otherwise(found[2])

    own = kept_back("n", discounts(pairs))
    # In how many contexts a word was seen, and how much its own pairs keep back.
    ends = scratch.save(pairs.groupBy(F.col("second").alias("word")).agg(F.count(F.lit(1)).alias("n")), "ends")
    starts = pairs.groupBy(F.col("first").alias("word")).agg(F.sum(own).alias("back"))
    lower = kept_back("n", discounts(ends))
    total, back = ends.agg(F.sum("n"), F.sum(lower)).first()
    unseen = float(np.log(back / total)) if total else 0.0
    share = (F.col("n") - lower + F.lit(back or 0.0) * F.exp(F.col("spelled") / UNIT)) / F.lit(total or 1)
    known = scratch.save(
        words.join(ends, "word").join(starts, "word").select(
            "word", "seen", "spelled", (F.col("back") / F.col("seen")).alias("back"), share.alias("share")), "known")
    gain = F.log("back") + F.log("share") - unseen - F.col("spelled") / UNIT
    words_gain = known.select(
        F.col("word").alias("code"), "seen", F.round(gain * UNIT).cast("long").alias("gain"))

    @F.arrow_udf("long")
    def code(first: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array(pair_code(first.to_numpy(), second.to_numpy()))

    before = known.select(F.col("word").alias("first"), "back", F.col("seen").alias("times"))
    after = known.select(F.col("word").alias("second"), "share")
    lone = F.col("back") * F.col("share")
    more = F.log1p((F.col("n") - own) / F.col("times") / lone)
    gains = []
    for k, part in enumerate(parts):
        found = part.join(before, "first").join(after, "second").select(
            code("first", "second").alias("code"), F.col("n").alias("seen"),
            F.round(more * UNIT).cast("long").alias("gain"))
        gains.append(scratch.save(
            found.union(words_gain.where(F.pmod("code", F.lit(PASSES)) == k)), f"gains-{k}"))
        scratch.drop(f"pairs-{k}")
    return Model(gains, round(unseen * UNIT), table)


class Common(NamedTuple):
    """The gains that tasks look up themselves, by code."""

    code: np.ndarray
    seen: np.ndarray
    gain: np.ndarray

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where each code stands, or -1."""
        if not len(self.code):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.code, codes), len(self.code) - 1)
        return np.where(self.code[at] == codes, at, -1)


def common(model: Model) -> Common:
    """What was seen most: at most ``COMMON`` words and as many pairs, as many as fit by their share."""
    every = model.gains[0]
    for other in model.gains[1:]:
        every = every.union(other)
    # Words and pairs are seen equally often in all, so half the sum is that of either.
    least = (every.agg(F.sum("seen")).first()[0] or 0) / 2 / COMMON
    most = every.where(F.col("seen") >= least).toArrow()
    found = [most.column(c).to_numpy() for c in ("code", "seen", "gain")]
    order = np.argsort(found[0])
    return Common(*[x[order] for x in found])


def _asked(taken: Taken, part: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, code and times of the different words and pairs of each text, in one part or all."""
    size = len(taken.words)
    found = []
    for single in (True, False):
        number = taken.first if single else taken.first * size + taken.second
        text = taken.text
        if part is not None:
            codes = taken.hashes if single else pair_code(taken.hashes[taken.first], taken.hashes[taken.second])
            mine = (codes[number] if single else codes) % PASSES == part
            number, text = number[mine], text[mine]
        # Below 2 ** 63: a batch has some 10,000 texts, a chunk of them at most some 10 million words.
        both, n = np.unique(text * (size * size) + number, return_counts=True)
        text, number = both // (size * size), both % (size * size)
        codes = taken.hashes[number] if single else pair_code(
            taken.hashes[number // size], taken.hashes[number % size])
        found.append((text, codes, n))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near(docs: DataFrame, model: Model, often: Common) -> DataFrame:
    """The rows of ``docs`` with words, their number, and near, the sum of all that needs no join, for text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.table, *often))  # arrays only: workers lack this module
    unseen = model.unseen
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, *found = sent.value
        often = Common(*found)
        for batch, own in chunks(batches):
            taken = taken_apart(own)
            sums = np.zeros(len(own), np.int64)
            np.add.at(sums, taken.text, (spelled(taken.words, table) + unseen)[taken.second])
            text, codes, n = _asked(taken)
            at = often.places(codes)
            held = batch.column(batch.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False)[text]
            known = (at >= 0) & (often.seen[at] > n * held) if len(often.code) else at >= 0
            np.add.at(sums, text[known], n[known] * often.gain[at[known]])
            words = np.maximum(np.bincount(taken.text, minlength=len(own)) - 1, 0)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words), pa.array(sums)], [*others, "words", "near"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(run, f"{kept}, words long, near long")


def far(docs: DataFrame, gains: DataFrame, often: Common, part: int) -> DataFrame:
    """key and far: the gains of the words and pairs in one part, but the common ones, by document."""
    sent = docs.sparkSession.sparkContext.broadcast(often.code)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Common(sent.value, sent.value, sent.value)
        for batch, own in chunks(batches):
            text, codes, n = _asked(taken_apart(own), part)
            rare = often.places(codes) < 0
            text, codes, n = text[rare], codes[rare], n[rare]
            key, held = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[text]
                         for c in ("key", "trusted")]
            for start in range(0, len(text), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[start:start + 100_000]) for x in (codes, key, np.where(held, -n, n))],
                    ["code", "key", "times"])

    asked = docs.select("key", "trusted", "text").mapInArrow(run, "code long, key long, times long")
    # The times of a trusted text are negative: it does not know what it alone holds.
    return asked.join(gains, "code").where(F.col("seen") > -F.col("times")).groupBy("key").agg(
        F.sum(F.abs("times") * F.col("gain")).alias("far"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each query in this block removes its shuffle files when it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def score(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, lang, n_scored, perplexity,
    threshold and kept.

    A text that is null or has no words has no perplexity and is not kept.  A language with
    fewer than ``LEAST_TRUSTED`` trusted documents (or null) takes the quantile of all trusted
    ones; if there are none at all, everything with a perplexity is kept, at a null threshold.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "perplexity")
    with shuffles_removed(spark):
        trusted = scratch.save(trusted_ids(labels), "trusted")
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").join(
            trusted, F.col("doc_id") == F.col("_trusted"), "left").select(
            "doc_id", "text", "lang", F.col("_trusted").isNotNull().alias("trusted"))
        # Rows of one key are copies of one row, so they may share what is summed for the key.
        own = own.withColumn("key", F.xxhash64("trusted", "doc_id", "text"))
        good = own.where("trusted")
        table = probabilities(counted(good, order), scratch, order)
        model = trained(good, scratch, table)
        often = common(model)
        scored = scratch.save(near(own.select(
            "doc_id", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_scored"),
            "trusted", "key", "text"), model, often), "near")
        sums = []
        for part, gains in enumerate(model.gains):
            sums.append(scratch.save(far(own, gains, often, part), f"far-{part}"))
            scratch.drop(f"gains-{part}")
        added = sums[0]
        for other in sums[1:]:
            added = added.union(other)
        copies = scored.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
        added = added.groupBy("key").agg(F.sum("far").alias("far")).join(copies, "key").select(
            "key", (F.col("far") / F.col("copies")).alias("far"))
        log = (F.col("near") + F.coalesce("far", F.lit(0.0))) / UNIT / F.nullif("n_scored", F.lit(0))
        scored = scratch.save(scored.join(added, "key", "left").select(
            "doc_id", "lang", "n_scored", "trusted",
            F.when(F.col("words") > 0, F.exp(-log)).alias("perplexity")), "scored")
        known = scored.where("trusted and perplexity is not null")

        def at_quantile() -> Column:
            return F.percentile_approx("perplexity", quantile, ACCURACY)

        everywhere = known.agg(at_quantile()).first()[0]
        bounds = scratch.save(known.groupBy(F.col("lang").alias("_lang")).agg(
            at_quantile().alias("_bound"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= LEAST_TRUSTED), "bounds")
    threshold = F.coalesce("_bound", F.lit(everywhere).cast("double"))
    return scored.join(F.broadcast(bounds), F.col("lang") == F.col("_lang"), "left").select(
        "doc_id", "lang", "n_scored", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= F.coalesce(threshold, F.lit(float("inf"))), F.lit(False)).alias("kept"))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision of every document."""
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
