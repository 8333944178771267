"""Whitening, ranked search and first-fit packing against brute force and on corner rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from corner import CLASHING, corner_docs, corner_rows, no_docs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramloom.llm import ffd_packing, ranking, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int"


# ------------------------------------------------------------------ 11 whitening

def plain_whitening(rows, components=4):
    """Rows (vec_id, entries) with finite entries; exact sums, then numpy."""
    width = max(len(v) for _, v in rows)
    x = [[math.floor(256 * c) for c in v] + [0] * (width - len(v)) for _, v in rows]
    fit = sorted({tuple(v) for v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    centred = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = (np.array(x, float) - mean) @ vectors / np.sqrt(values)
    trace = (centred ** 2).sum() / n
    return [(i, n, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)), w, values / trace)
            for (i, _), v, w in zip(rows, x, white, strict=True)]


def check_whitening(found, rows, components=4, close=1e-9):
    expected = plain_whitening(rows, components)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert len(found) == len(rows) * components
    signs = {}
    largest = max(range(len(expected)), key=lambda k: min(abs(expected[k][3])))
    for r in by_id[expected[largest][0]]:
        signs[r["component"]] = np.sign(r["whitened"] * expected[largest][3][r["component"] - 1])
    for i, n, deviation, white, explained in expected:
        own = [r for r in by_id[i] if r["deviation"] == deviation]
        assert {r["component"] for r in own} == set(range(1, components + 1))
        for r in own:
            c = r["component"]
            assert r["n"] == n and r["identity_error"] < 1e-6
            assert r["whitened"] * signs[c] == pytest.approx(white[c - 1], abs=close)
            assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)


def test_whitening_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 7 * 64)  # many small blocks
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 3)
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by vec_id").fetchall()
    check_whitening(whitening.op11_whitening(spark, SF).collect(), rows)


def test_whitening_bears_corner_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.gauss(0, 1 + k) for k in range(5)]) for i in range(60)]
    good += [(100 + i, list(good[0][1])) for i in range(40)]  # copies count once
    good += [(200, [1.5, -0.0]), (201, []), (None, [3.0, 1.0, 2.0, 0.5, 9.0])]  # shorter ones end in zeros
    bad = [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")] * 5), (303, [float("-inf")] + [0.0] * 4)]
    frame = spark.createDataFrame([(*r, 0) for r in good + bad], VECTORS)
    clashing = frame.withColumns({name: F.lit(1) for name in ("x", "h1", "b", "task", "n", "component")})
    check_whitening(whitening.whitened_rows(clashing).collect(), good)
    twice = frame.union(frame.where("vec_id < 3"))
    assert whitening.whitened_rows(twice).count() == 4 * (len(good) + 3)


def test_whitening_of_little_or_nothing(spark):
    def run(rows):
        return whitening.whitened_rows(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, []), (2, [])]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    flat = run([(1, [0.0, 5.0]), (2, [1.0, 5.0])])  # one component has variance
    assert sorted((r["vec_id"], r["component"], abs(round(r["whitened"], 9))) for r in flat) == [(1, 1, 1), (2, 1, 1)]
    huge = run([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])  # ends of the long range
    assert len(huge) >= 3 and all(r["deviation"] is None for r in huge if r["vec_id"] < 3)


# ------------------------------------------------------------------ 12 ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_ranks(docs, items):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    with_terms = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(k for _, c in counts for k in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in counts:
            if not c:
                continue
            m = 25 + 75 * sum(c.values()) * with_terms // total
            score = sum(
                math.floor(1000 * math.log((2 * with_terms + 2) / (2 * df[k] + 1)))
                * (1_000_000_000 * c[k] // (1000 * c[k] + 8 * m)) for k in plain_terms(text) if k in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:10], 1)]
    return sorted(found, key=repr)


def ranks(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=repr)


def test_ranking_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SEGMENT_DOCS", 32)  # many segments, blocks and owners
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 7)
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    assert ranks(ranking.op12_ranking(spark, SF)) == plain_ranks(docs, items)


def test_ranking_bears_corner_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SEGMENT_DOCS", 3)
    texts = corner_rows()
    items = [(1, prose(1, 10).upper()), (1, prose(1, 10)), (2, None), (3, ""), (None, "one ONE nothing"),
             (4, texts[6][1]), (5, "É é x" + "x" * 20), (6, " ".join(prose(k, 30) for k in range(9)))]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns(
        {name: F.lit(7) for name in ("item", "term", "block", "owner", "task")})
    docs = corner_docs(spark, clashing=True)
    assert ranks(ranking.ranked(docs, frame)) == plain_ranks([(r[0], r[1]) for r in texts], items)
    assert ranking.ranked(no_docs(spark), frame).collect() == []
    assert ranking.ranked(docs, frame.limit(0)).collect() == []


def test_equal_scores_rank_by_id_over_all_segments(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SEGMENT_DOCS", 5)
    docs = [(i, "same words here" if i % 3 else "other text") for i in range(90, 0, -1)]
    items = [(1, "words"), (2, "text words text")]
    found = ranking.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert ranks(found) == plain_ranks(docs, items)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = [(i, prose(i % 40, 30)) for i in range(120)]
    items = [(i, prose(i, 12)) for i in range(12)]
    frames = [spark.createDataFrame(t, f"{n}_id long, text string") for n, t in (("doc", docs), ("item", items))]
    monkeypatch.setattr(ranking, "term_filter", lambda wanted: b"\xff" * (ranking.FILTER_BITS // 8))
    assert ranks(ranking.ranked(*frames)) == plain_ranks(docs, items)


# ------------------------------------------------------------------ 13 first-fit decreasing

def check_sequences(found, docs, capacity, end_id=1):
    """Round trip: all ids of all documents, gapless sequences, no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    left = Counter()
    for i, text in docs:
        left[i, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id])] += 1
    sequences, whole = {}, {}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], tuple(ids.tolist())))
    for own in sequences.values():
        reached = 0
        for offset, length in sorted(own):
            assert offset == reached
            reached += length
        assert reached == capacity or reached < capacity and reached & (reached - 1) == 0
    for (i, ids), times in left.items():
        pieces = sorted(whole.pop((i, len(ids))) if (i, len(ids)) in whole else [])
        assert sum(len(p) for _, p in pieces) == times * len(ids)
        for start, piece in pieces:
            assert piece == ids[start:start + len(piece)]
    assert not whole


def test_first_fit_packing_round_trip(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    found = ffd_packing.pack_groups(frame, group_bytes=100_000, with_ids=True).collect()
    check_sequences(found, docs, 2048)
    assert len({r["sequence_id"] >> 32 for r in found}) > 3
    whole = ffd_packing.op13_ffd_packing(spark, SF)
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_first_fit_packing_bears_corner_rows(spark):
    own = [r for r in corner_rows() if r[0] is not None]
    docs = [(r[0], r[1]) for r in own] + [(None, "no id"), (50, "<|endoftext|> á ́b\x1cc  x"),
                                          (51, "ΑΣ σΣ. don't I'LL 12 3.4\t\tx\r\n y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {**{name: F.lit(value) for name, value in CLASHING.items()}, "group": F.lit(1), "ids": F.lit(2), "_h": F.lit(3)})
    check_sequences(ffd_packing.pack_groups(frame, capacity=256, with_ids=True).collect(), docs, 256)
    assert ffd_packing.pack_groups(no_docs(spark)).collect() == []


def plain_first_fit(lengths, capacity):
    bins, found = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, room in enumerate(bins) if room >= lengths[i]), len(bins))
        if b == len(bins):
            bins.append(capacity)
        found[i] = (b, capacity - bins[b])
        bins[b] -= lengths[i]
    return [found[i] for i in range(len(lengths))]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_tournament_tree_is_first_fit_decreasing(n):
    rng = np.random.default_rng(n)
    lengths = rng.integers(1, 101, n)
    bins, offsets = ffd_packing.first_fit_decreasing(lengths, 100)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == plain_first_fit(lengths.tolist(), 100)


def test_chunk_ids_equal_the_tokenizer_file(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, cached = Tokenizer.from_file(path), ffd_packing.SpacedTokenizer(path)
    monkeypatch.setattr(ffd_packing, "_CACHED_CHUNKS", 500)
    monkeypatch.setattr(ffd_packing, "_WORDS_AT_ONCE", 7)
    rng = random.Random(2)
    letters = [*"abAZé ñΣσßİ'\"#1٣½\n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u0301\u0300\u200b\u3000漢😀.,!ä", "<|endoftext|>",
               "'ll", "  ", " the", " Words,", "ǆ", "ﬁ", "e\u0301", "각"]
    latin = [*"aZéÑß×÷«».,;_'\"-İıŉǅ\u0131\xad\xb2\xbd\xaa\xa0 \n3", " ", "H", "h"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 24))) for _ in range(5_000)]
    texts += ["".join(rng.choice(latin) for _ in range(rng.randint(0, 24))) for _ in range(5_000)]
    texts += ["H\u0331 I\u0307 h\u0331,", "Ñ, é! ß.\u00d7,"]
    texts += [prose(i, 30).title().replace(" ", rng.choice([" ", ", ", "\n", ". "])) for i in range(300)]
    texts += ["<|ENDOFTEXT|> <|EndOfText|>.", "x" * 5_000, "ab" * 40 + ".", "İİ ǅ ΑΣ. ΌΣΟΣ"]
    found = []
    for at in range(0, len(texts), 50):
        found += cached.id_bytes(texts[at:at + 50])
    for text, ids in zip(texts, found, strict=True):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, cached.kind).tolist() == expected, text
