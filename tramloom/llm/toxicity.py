"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and their beginnings, hashed to buckets.  The score is
the logistic function of

    bias + sum of weights + sum over pairs of terms of the product of their factor vectors,

so that a pair (an insult beside the mention of a group) can weigh more than its two terms.
Pairs cost nothing extra: their sum is half of |sum of vectors|^2 - sum of |vector|^2.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of their id;
every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm.common import opened, read_table, sealed

BUCKETS = 1 << 18
FACTORS = 6
#: Bound of the labelled rows the model is fitted on.
TRAIN_ROWS = 12_000
#: A bucket takes part if so many of these rows have it.
LEAST_ROWS = 3
#: Standard errors that a term's log odds may differ from none by chance.
NOISE = 2.5
#: Value of a term that does not stand out by itself; it may still matter beside another one.
LEAST_VALUE = 0.3
EPOCHS = 14
THRESHOLD = 0.3
SEED = 11
#: Characters of a word's beginning that count as terms of their own.
STEM_CHARS = (4, 5)
#: Score of everything if nothing can be learnt.
NO_MODEL_BIAS = -4.0
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CACHE_ENTRIES = 200_000


def word_buckets(word: bytes) -> tuple[int, ...]:
    """Buckets of a lower-case word: the word without outer punctuation, and its beginnings."""
    bare = word.strip(_EDGES)
    if not bare:
        return ()
    terms, chars = [b"w" + bare], bare.decode("utf-8", "replace")
    terms += [b"s" + chars[:n].encode() for n in STEM_CHARS if len(chars) > n]
    return tuple(xxhash.xxh32_intdigest(t, SEED) & (BUCKETS - 1) for t in terms)


def text_buckets(text: bytes | None) -> np.ndarray:
    found: set[int] = set()
    for word in set((text or b"").lower().split()):
        found.update(word_buckets(word))
    return np.sort(np.fromiter(found, np.int32, len(found)))


class Model:
    """bias, one weight and one factor vector per bucket; zero where too few rows had it.

    A term's value, by which its parameters are multiplied beforehand, is how far its log odds
    between the labels stand out from chance, and ``LEAST_VALUE`` if they do not: such terms learn
    slowly, or thousands of rare words would explain the few labels by heart."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.weights, self.vectors = bias, weights, vectors
        self.active = (weights != 0) | (vectors != 0).any(1)
        self._cache: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        at = np.nonzero(self.active)[0].astype(np.int32)
        return {"bias": self.bias, "at": at, "w": self.weights[at], "v": self.vectors[at]}

    def __setstate__(self, state: dict) -> None:
        weights = np.zeros(BUCKETS, np.float32)
        vectors = np.zeros((BUCKETS, state["v"].shape[1]), np.float32)
        weights[state["at"]], vectors[state["at"]] = state["w"], state["v"]
        self.__init__(state["bias"], weights, vectors)

    def score(self, text: bytes | None) -> float:
        cache, found = self._cache, set()
        for word in set((text or b"").lower().split()):
            buckets = cache.get(word)
            if buckets is None:
                if len(cache) >= _CACHE_ENTRIES:
                    cache.clear()
                buckets = cache[word] = tuple(b for b in word_buckets(word) if self.active[b])
            found.update(buckets)
        z = self.bias
        if found:
            at = np.sort(np.fromiter(found, np.int64, len(found)))
            vectors = self.vectors[at].astype(np.float64)
            total = vectors.sum(0)
            z += float(self.weights[at].sum(dtype=np.float64))
            z += 0.5 * float(total @ total - (vectors * vectors).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def values_of(rows: Sequence[np.ndarray], labels: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each bucket its value: standard errors of its log odds beyond ``NOISE``, scaled, and no
    less than ``LEAST_VALUE``; 0 if fewer than ``LEAST_ROWS`` rows have it."""
    toxic = np.zeros(BUCKETS)
    for row, label in zip(rows, labels, strict=True):
        if label:
            toxic[row] += 1
    clean = seen - toxic
    base = np.log((labels.sum() + 1) / (len(rows) - labels.sum() + 1))
    odds = np.log((toxic + 1) / (clean + 1)) - base
    errors = np.abs(odds) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1))
    return np.where(seen >= LEAST_ROWS, np.maximum((errors - NOISE) / NOISE, LEAST_VALUE), 0.0)


def fit(rows: Sequence[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS,
        rate: float = 0.15, decay: float = 1.0, seed: int = SEED) -> Model:
    """Logistic loss, AdaGrad over small batches, ``decay`` over the number of rows as L2 weight;
    the same rows give the same model.

    Terms that stand out by themselves learn first, for ``epochs`` rounds.  Then all learn together,
    so that the others, alone or in pairs, explain what those left open and not the labels by heart.
    """
    weights = np.zeros(BUCKETS, np.float32)
    vectors = np.zeros((BUCKETS, factors), np.float32)
    if not len(rows):
        return Model(NO_MODEL_BIAS, weights, vectors)
    seen = np.zeros(BUCKETS, np.int64)
    for row in rows:
        seen[row] += 1
    value_of = values_of(rows, labels, seen)
    buckets = np.nonzero(value_of)[0]
    place = np.full(BUCKETS, -1, np.int64)
    place[buckets] = np.arange(len(buckets))
    values = value_of[buckets]
    every = [p[p >= 0] for p in (place[row] for row in rows)]
    first = [p[values[p] > LEAST_VALUE] for p in every]
    decay /= len(rows)
    rng = np.random.default_rng(seed)
    w = np.zeros(len(buckets))
    v = rng.normal(0, 0.02, (len(buckets), factors))
    share = np.clip(labels.mean(), 0.01, 0.99)
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(w.shape, 1e-2), np.full(v.shape, 1e-2), 1e-2
    number = np.zeros(len(buckets), np.int64)
    for compact in [first] * epochs + [every] * epochs:
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 128):
            batch = order[start:start + 128]
            counts = np.array([len(compact[i]) for i in batch])
            at = np.concatenate([compact[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), counts)
            value = values[at]
            inside = v[at] * value[:, None]
            total = np.zeros((len(batch), factors))
            if len(at):
                total[counts > 0] = np.add.reduceat(inside, (np.cumsum(counts) - counts)[counts > 0])
            z = bias + np.bincount(owner, w[at] * value, len(batch))
            z += 0.5 * ((total * total).sum(1) - np.bincount(owner, (inside * inside).sum(1), len(batch)))
            gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) / len(batch)
            number[at] = -1
            touched = np.flatnonzero(number)
            number[touched] = np.arange(len(touched))
            index = number[at]
            number[touched] = 0
            grad_w = np.bincount(index, gap[owner] * value, len(touched)) + decay * w[touched]
            pull = (gap[owner] * value)[:, None] * (total[owner] - inside)
            grad_v = np.stack([np.bincount(index, p, len(touched)) for p in pull.T], axis=1) + decay * v[touched]
            seen_w[touched] += (len(batch) * grad_w) ** 2 / len(batch)
            seen_v[touched] += (len(batch) * grad_v) ** 2 / len(batch)
            w[touched] -= rate * np.sqrt(len(batch)) * grad_w / np.sqrt(seen_w[touched])
            v[touched] -= 0.3 * rate * np.sqrt(len(batch)) * grad_v / np.sqrt(seen_v[touched])
            slope = float(gap.sum())
            seen_b += slope * slope
            bias -= 0.05 * slope / np.sqrt(seen_b)
    weights[buckets], vectors[buckets] = w * values, v * values[:, None]
    return Model(bias, weights, vectors)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 by 4.  False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, **settings) -> Model:
    """Fit on the labelled rows of ``docs`` that are not held out, at most ``train_rows``.

    Null labels are left out; if an id has several labels, the greatest counts, and of several
    texts of an id the first in order.
    """
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    present = known.where("_toxic is not null").join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = present.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(train_rows)
    # At most train_rows pairs of numbers, so the broadcast is bounded; one row an id reaches the driver.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("_toxic").alias("_toxic"))

    @F.arrow_udf("array<int>")
    def terms(text: pa.Array) -> pa.Array:
        return pa.array([text_buckets(t) for t in text.cast(pa.binary()).to_pylist()], pa.list_(pa.int32()))

    sample = texts.select("doc_id", "_toxic", terms("text").alias("terms")).toArrow().sort_by("doc_id")
    rows = [np.asarray(r.values) for r in sample.column("terms")]
    return fit(rows, np.array(sample.column("_toxic").to_pylist(), float), **settings)


def score_column(spark: SparkSession, model: Model):
    """A function from a text column to its score; null and empty texts have no terms.

    The model is broadcast: it has at most ``BUCKETS`` rows of weights, and a worker then keeps
    one copy of it, and of the words it has looked up, for all its tasks.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = sent.value
        return pa.array([own.score(t) for t in texts.cast(pa.binary()).to_pylist()], pa.float64())

    return score


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document.  Without labels all get the score of the bias.

    Null and empty texts have the score of the bias; repeated rows are scored each.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    score = score_column(spark, train(docs, read_table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with the same columns."""
    score = score_column(docs.sparkSession, train(docs, labels))
    kept = sealed(docs).withColumn("score", score("row.text")).where(F.col("score") < threshold)
    return opened(kept, docs.columns)
