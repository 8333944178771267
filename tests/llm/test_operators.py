"""Each operator against brute force on small tables, and on corner rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from corner import DOC_SCHEMA, corner_docs, corner_rows, no_docs, prose
from tokenizers import Tokenizer

from tramloom.llm import chat, embedding_dedup, licenses, line_dedup, mixing, packing, perplexity
from tramloom.llm import simhash, sketches, toxicity
from tramloom.llm.common import Scratch, components, roots

SF = "/root/testdata/sf0.001"


def documents():
    return duckdb.sql(f"select * from '{SF}/documents.parquet'").fetchall()


def united(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ------------------------------------------------------------------ components

def test_components_of_chains_stars_and_pairs(spark):
    rng = random.Random(3)
    names = [rng.getrandbits(63) - (1 << 62) for _ in range(400)]
    pairs = [(i, i + 1) for i in range(0, 149)] + [(200, i) for i in range(201, 300)] + [(300, 301), (301, 300)]
    links = spark.createDataFrame([(names[i], names[j]) for i, j in pairs], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links, Scratch(spark, "t")).collect()}
    expected = united(400, pairs)
    linked = {i for p in pairs for i in p}
    assert found.keys() == {names[i] for i in linked}
    groups = {}
    for i in linked:
        groups.setdefault(expected[i], set()).add(found[names[i]])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set.union(*groups.values()))


# ------------------------------------------------------------------ 1 toxicity

def test_toxicity_learns_from_rows_that_are_not_held_out(spark):
    result = toxicity.op1_toxicity(spark, "/root/testdata/sf0.01")
    assert result.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in result.collect()}
    labels = dict(duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    held = [(rows[i]["score"], t) for i, t in labels.items() if rows[i]["held_out"]]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in bad for b in good]) > 0.8


@pytest.mark.parametrize("vocabulary", [40, 2000])
def test_toxicity_learns_words_that_matter_only_together(vocabulary):
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(1200):
        words = [f"w{k}" for k in rng.integers(0, vocabulary, 12)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(words + ["insult"] * a + ["group"] * b).encode())
        labels.append(float(a != b))
    model = toxicity.fit([toxicity.text_buckets(t) for t in texts[:900]], np.array(labels[:900]))
    scores = [model.score(t) for t in texts[900:]]
    bad = [s for s, t in zip(scores, labels[900:]) if t]
    good = [s for s, t in zip(scores, labels[900:]) if not t]
    assert np.mean([a > b for a in bad for b in good]) > 0.95


def test_toxicity_score_is_that_of_all_pairs():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, 6, replace=False)).astype(np.int32) for _ in range(200)]
    rows[5] = np.empty(0, np.int32)
    model = toxicity.fit(rows, np.array([float(3 in r and 7 in r) for r in rows]))
    text = b"One two, three four five six seven"
    at = toxicity.text_buckets(text)
    model.weights[at] = rng.normal(size=len(at))
    model.vectors[at] = rng.normal(size=(len(at), toxicity.FACTORS))
    model.active[at] = True
    z = model.bias + sum(model.weights[i] for i in at)
    z += sum(float(model.vectors[i].astype(float) @ model.vectors[j]) for i, j in combinations(at, 2))
    assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-5


def test_toxicity_bears_corner_rows(spark, tmp_path):
    corner_docs(spark, clashing=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 1, 1), (3, None, None), (8, 0, 0), (None, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = toxicity.op1_toxicity(spark, str(tmp_path)).collect()
    assert len(found) == corner_docs(spark).count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (4, 5, None)}) == 1  # no terms: the bias
    assert len({r["score"] for r in found if r["doc_id"] == 8}) == 1  # repeated rows


def test_toxicity_takes_one_row_an_id(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels, **_: sizes.append((len(rows), sorted(labels))))
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(90)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, 0)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    kept = [i for i in range(3) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sizes == [(len(kept), sorted([1.0, 1.0, 0.0][i] for i in kept))]


def test_toxicity_pairs_weigh_more_than_their_terms():
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(1200):
        words = [f"w{k}" for k in rng.integers(0, 40, 12)]
        a, b = rng.random() < 0.4, rng.random() < 0.4
        texts.append(" ".join(words + ["insult"] * a + ["group"] * b).encode())
        labels.append(float(a and b))
    model = toxicity.fit([toxicity.text_buckets(t) for t in texts[:900]], np.array(labels[:900]))
    scores = np.array([model.score(t) for t in texts[900:]])
    assert ((scores >= 0.5) == np.array(labels[900:])).mean() > 0.97
    assert toxicity.fit([], np.empty(0)).score(b"any") < 0.3


# ------------------------------------------------------------------ 2 mixing

def exact_shares(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(3))
def test_sainte_lague_equals_seat_by_seat(spark, seed):
    rng = random.Random(seed)
    cells = [(g, k, rng.choice([0, 1, 5, 30, rng.randint(1, 1000)]), s)
             for g, s in (("a", 17), ("b", 200), ("c", 1)) for k in range(9)]
    frame = spark.createDataFrame(cells, "g string, k int, votes long, seats long")
    found = {(r["g"], r["k"]): r["quota"] for r in mixing.sainte_lague(frame, ["g"], ["k"], "votes", "seats").collect()}
    for g, seats in (("a", 17), ("b", 200), ("c", 1)):
        votes = [v for h, _, v, _ in cells if h == g]
        assert [found[g, k] for k in range(9)] == exact_shares(votes, seats)


def expected_targets(sizes):
    sources = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    left, open_, target = 1.5 * sum(sizes.values()), set(sources), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(rows, texts):
    sizes, taken = {}, {}
    for r, (_, text, _, source, _) in zip(rows, texts, strict=True):
        assert r["size"] == len((text or "").encode().split())
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for r, (_, _, _, source, _) in zip(rows, texts, strict=True):
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(expected_targets(sizes)[source])
        assert abs(taken[source] - r["target"]) <= 2 * mixing.BLOCK_WORDS
    return taken


def test_mix_meets_targets_and_repeats_itself(spark):
    texts = sorted(documents())
    first = sorted(mixing.op2_mixing(spark, SF).collect())
    assert first == sorted(mixing.op2_mixing(spark, SF).collect())
    assert [r["doc_id"] for r in first] == [t[0] for t in texts]
    check_mix(first, texts)


def test_mix_of_corner_rows(spark):
    key = lambda r: (r[0] is None, r[0] or 0, len((r[1] or "").split()))
    found = mixing.mix(mixing.sizes(corner_docs(spark))).collect()
    found.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"]))
    check_mix(found, sorted(corner_rows(), key=key))
    assert mixing.mix(mixing.sizes(no_docs(spark))).collect() == []


# ------------------------------------------------------------------ 3 perplexity

def test_probabilities_sum_to_one_and_equal_plain_computation(spark):
    texts = [prose(i, 30) for i in range(20)]
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string")
    order, n = 2, perplexity.SYMBOLS
    counts = perplexity.counted(frame, order)
    table = np.exp(perplexity.probabilities(counts, Scratch(spark, "t"), order).astype(float))
    assert np.allclose(table.reshape(n, n).sum(1), 1, atol=1e-5)
    c2 = np.zeros((n, n))
    for t in texts:
        own = [0, *perplexity.symbols(t).tolist()]
        for a, b in zip(own, own[1:], strict=False):
            c2[a, b] += 1

    def cut(c):
        k = [(c == i).sum() for i in (1, 2, 3, 4)]
        if not k[0] or not k[1]:
            return np.where(c == 1, 0.5, np.where(c == 2, 0.75, 0.9)) * (c > 0)
        y = k[0] / (k[0] + 2 * k[1])
        d = [min(max(i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else 0.9, 0.05), i - 0.05) for i in (1, 2, 3)]
        return np.where(c == 1, d[0], np.where(c == 2, d[1], d[2])) * (c > 0)

    c1 = (c2 > 0).sum(0).astype(float)
    p1 = (c1 - cut(c1)) / c1.sum() + cut(c1).sum() / c1.sum() / n
    total = c2.sum(1, keepdims=True)
    with np.errstate(invalid="ignore"):
        p2 = np.where(total > 0, (c2 - cut(c2)) / total + cut(c2).sum(1, keepdims=True) / total * p1, p1)
    assert np.allclose(table.reshape(n, n), p2, rtol=1e-4)


def test_perplexity_keeps_trusted_text_and_drops_junk(spark):
    rows = [(i, prose(i, 50), "en") for i in range(120)]
    rows += [(500, "#$%&! ;;;; " * 40, "en"), (501, "", "en"), (502, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in perplexity.score(docs, labels).collect()}
    assert sum(found[i]["kept"] for i in range(120)) >= 117
    assert not found[500]["kept"] and found[501]["perplexity"] is None and not found[502]["kept"]
    bare = perplexity.score(corner_docs(spark), labels.limit(0)).collect()
    assert len(bare) == len(corner_rows()) and all(r["threshold"] is None for r in bare)
    assert perplexity.score(no_docs(spark), labels).collect() == []


def test_perplexity_is_that_of_a_plain_model_of_words(spark):
    texts = [prose(i, 30) + " the same end" for i in range(25)] + ["\u0430\u0431 \u0432"] * 3
    # The characters of the last two fall in the classes of a trusted text, its words do not.
    others = [prose(3, 30), prose(99, 20), "A", " \n", "\u0430\u0431 \u0432", "\u0438\u0439 \u043a"]
    rows = [(i, t, "en") for i, t in enumerate(texts + others)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["perplexity"] for r in perplexity.score(docs, labels).collect()}
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    table = perplexity.probabilities(perplexity.counted(frame), Scratch(spark, "t"))

    def pairs_of(text):
        own = ["", *text.lower().split(), ""]
        return list(zip(own, own[1:], strict=False))

    def cut(counts):
        k = [sum(n == i for n in counts.values()) for i in (1, 2, 3, 4)]
        y = k[0] / (k[0] + 2 * k[1])
        d = [min(max(i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else 0.9, 0.05), i - 0.05) for i in (1, 2, 3)]
        return {x: d[min(n, 3) - 1] for x, n in counts.items()}

    pairs = Counter(x for t in texts for x in pairs_of(t))
    times, ends = Counter(a for t in texts for a, _ in pairs_of(t)), Counter(b for _, b in pairs)
    kept, low = cut(pairs), cut(ends)
    back = Counter()
    for (a, _), d in kept.items():
        back[a] += d / times[a]
    total = sum(ends.values())
    unseen = sum(low.values()) / total

    def probability(a, b, own, alone):
        spell = np.exp(perplexity.spelled([b.encode()], table)[0] / perplexity.UNIT)
        p = unseen * spell + ((ends[b] - low[b]) / total if times[b] > alone[b] else 0)
        p *= back[a] if times[a] > alone[a] else 1
        return p + ((pairs[a, b] - kept[a, b]) / times[a] if pairs[a, b] > own[a, b] else 0)

    for i, text, _ in rows:
        own = Counter(pairs_of(text) if i < len(texts) else [])
        alone = Counter(a for a, _ in own.elements())
        if not text.split():
            assert found[i] is None
            continue
        log = sum(np.log(probability(a, b, own, alone)) for a, b in pairs_of(text))
        assert np.isclose(found[i], np.exp(-log / len(text)), rtol=1e-4), text
    assert found[len(rows) - 1] > 1.5 * found[len(rows) - 2]


# ------------------------------------------------------------------ 4 lines

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutate(rng, text, edits, letters):
    chars = list(text)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randint(0, max(len(chars) - 1, 0))
        if kind == 0 and chars:
            chars.pop(at)
        elif kind == 1 or not chars:
            chars.insert(at, rng.choice(letters))
        else:
            chars[at] = rng.choice(letters)
    return "".join(chars)


def test_banded_distance_and_lookups_equal_plain_distance():
    rng = random.Random(5)
    for _ in range(4000):
        most, letters = rng.choice([1, 2, 3]), rng.choice(["ab", "abcdé"])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))
        b = mutate(rng, a, rng.randint(0, most + 2), letters)
        near = plain_distance(a, b) <= most
        assert line_dedup.within(a, b, most) == near
        if near and min(len(a), len(b)) > most:
            long, short = sorted((a, b), key=len, reverse=True)
            own = {(i, len(short), short[s:s + n]) for i, (s, n) in enumerate(line_dedup.segments(len(short), most + 1))}
            assert any((i, n, long[s:s + k]) in own for i, n, s, k in line_dedup.lookups(len(long), most))


def test_line_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEGMENT_ROWS", 4)  # deal common segments out
    rng = random.Random(7)
    lines = [prose(i, 9)[:n].strip().ljust(n, "k") for i, n in enumerate([60, 42, 41, 39, 30, 22, 20, 19, 12, 6] * 3)]
    lines += ["ab" * 21, "aab" * 14, "a" * 41, "ba" * 12, "abb" * 8, "é" * 20]  # segments in many places
    lines += [mutate(rng, rng.choice(lines), rng.randint(0, 3), "abk") for _ in range(110)]
    docs = [(i, "\n".join(rng.choice([x, x, "short", f"  {x}\t"]) for x in rng.sample(lines, 8))) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"], r["kept"], r["n_links"])
             for r in line_dedup.line_classes(frame).collect()}
    places = sorted((i, k, x.strip(" \t\r")) for i, t in docs for k, x in enumerate(t.split("\n"))
                    if len(x.strip(" \t\r")) >= line_dedup.LEAST_CHARS)
    pairs = [(i, j) for i, j in combinations(range(len(places)), 2)
             if plain_distance(places[i][2], places[j][2]) <= min(2, min(len(places[i][2]), len(places[j][2])) // 20)]
    root = united(len(places), pairs)
    links = [0] * len(places)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    assert found == {places[i][:2]: (*places[root[i]][:2], root[i] == i, links[i]) for i in range(len(places))}
    assert any(n >= 3 for n in links) and any(n == 0 for n in links)
    assert line_dedup.line_classes(no_docs(spark)).collect() == []


def test_short_lines_have_rows_and_equal_ones_a_class(spark):
    docs = [(1, "Same short line.\n\n  yes"), (2, "x\nyes\nSame short line!"), (3, "Same short line."),
            (4, "A line of thirty-odd letters now"), (5, "A line of thirty-odd lettersnow")]
    found = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"], r["n_links"])
             for r in line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {(1, 0): (1, 0, 1), (1, 2): (1, 2, 1), (2, 0): (2, 0, 0), (2, 1): (1, 2, 1), (2, 2): (2, 2, 0),
                     (3, 0): (1, 0, 1), (4, 0): (4, 0, 1), (5, 0): (4, 0, 1)}


def test_pairs_meet_first_in_one_segment():
    rng = random.Random(9)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(40, 46)))
        b = mutate(rng, a, rng.randint(0, 2), "ab")
        short, long = sorted((a, b), key=len)
        if len(short) >= 40:
            i, text = line_dedup.first_meeting(short, long, 2)
            either = [line[s:s + n] for line in (short, long) for s, n in [line_dedup.segments(len(line), 3)[i]]]
            assert text in either and text in short and text in long
            if len(a) == len(b):
                assert line_dedup.first_meeting(long, short, 2) == (i, text)
    assert line_dedup.first_meeting("a" * 40, "b" * 40, 2) is None


# ------------------------------------------------------------------ 5 simhash

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    texts = documents()
    prints = [plain_fingerprint(t[1]) for t in texts]
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = united(len(texts), pairs)
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, 1 << 60), texts[i][0])
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op5_simhash(spark, SF).collect()}
    assert found == {t[0]: (f"{prints[i]:016x}", least[root[i]]) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n,flips", [(900, 5), (300, 2), (5000, 12)])
def test_gray_tree_finds_all_links_of_a_node(n, flips):
    rng = np.random.default_rng(n)
    hubs = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = hubs[rng.integers(0, 6, n)]
    for _ in range(flips):
        codes ^= np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
    codes = np.unique(codes)
    i, j = simhash.close_pairs(codes, 4)
    assert (np.bitwise_count(codes[i] ^ codes[j]) >= 0).all()
    a, b = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4)
    assert (roots(len(codes), i, j) == roots(len(codes), a, b)).all()


def test_simhash_parts_of_a_hot_node_still_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_ROWS", 40)
    rng = random.Random(2)
    hub = rng.getrandbits(64)
    prints = list({hub ^ sum(1 << k for k in rng.sample(range(20), rng.randint(0, 5))) for _ in range(400)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long")
    found = components(simhash.fingerprint_links(frame), Scratch(spark, "t")).collect()
    pairs = [(i, j) for i, j in combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = united(len(prints), pairs)
    sizes = sorted(n for n in np.bincount(root).tolist() if n > 1)
    groups = {}
    for r in found:
        groups[r["component"]] = groups.get(r["component"], 0) + 1
    assert sorted(groups.values()) == sizes


def test_simhash_of_corner_rows(spark):
    found = simhash.near_duplicates(corner_docs(spark)).collect()
    assert len(found) == len(corner_rows())
    by_id = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == 1 and by_id[4] == by_id[5] == by_id[11] == 4
    assert simhash.near_duplicates(no_docs(spark)).collect() == []


# ------------------------------------------------------------------ 6 packing

def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, sequences = [], {}
    for doc_id, text, *_ in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected, key=repr)
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(r["length"] for r in rows) // 1024)


def test_packing_is_whole_tight_and_equals_the_tokenizer(spark):
    used, least = check_packing(packing.op6_packing(spark, SF).collect(), documents())
    assert used <= least * 1.02 + 1


def test_packing_of_corner_rows(spark):
    check_packing(packing.pack(corner_docs(spark)).collect(), corner_rows())
    odd = ["a  b", " a", "  a", "a \n b", "a\n", "<|endoftext|> x", "don't  stop\t\tnow", "é ü  ñ", "a b", "\x1c x", " "]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(odd)]
    found = packing.pack(spark.createDataFrame(rows, DOC_SCHEMA), with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in found)
    check_packing(found, rows)
    assert packing.pack(no_docs(spark)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_histogram_exactly(seed):
    rng = np.random.default_rng(seed)
    demand = np.bincount(rng.integers(1, 65, 300 * 4 ** seed) if seed % 2 else rng.integers(20, 65, 50), minlength=65)
    held = np.zeros(65, np.int64)
    for config, times in packing.plan(demand, 64, 60):
        assert times > 0 and (config * np.arange(65)).sum() <= 64
        held += config * times
    assert (held == demand).all()


# ------------------------------------------------------------------ 7 licences

def plain_scan(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lowered).split(" ")
    words = [w for w in words if w]
    places = []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    return len(words), sorted(places)


def check_licenses(spark, docs, texts):
    found = {r["doc_id"]: r for r in docs.collect()}
    for doc_id, text, *_ in texts:
        n, places = plain_scan(text)
        r = found[doc_id]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    return found


def test_licences_on_documents_and_notices(spark, tmp_path):
    check_licenses(spark, licenses.op7_licenses(spark, SF), documents())
    rows = [(1000 + i, prose(i, 40), "en", "a", 1) for i in range(30)]
    rows += [
        (100, prose(1, 20) + " Redistribution and use in source and binary forms, with or without modification, are "
         "permitted provided that the following conditions are met: " + prose(2, 20), "en", "a", 1),
        (101, "Permission is hereby granted, free of charge, to any person obtaining a copy", "en", "a", 1),
        (102, "source and binary forms " + prose(3, 10), "en", "a", 1),
        (103, "the MIT license, and CC-BY; gnu General public LICENSE, apache\tlicense mit", "en", "a", 1),
        (104, "kelvin K mité license", "en", "a", 1),
    ]
    rows += [r for r in corner_rows() if r[0] is not None and r[0] != 8]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = check_licenses(spark, licenses.op7_licenses(spark, str(tmp_path)), rows)
    assert found[100]["labels"] == "bsd" and found[100]["score"] > 0.9
    assert found[101]["labels"] == "mit" and found[102]["labels"] == ""
    assert found[103]["base_labels"] == "apache,cc-by,gpl,mit"
    assert licenses.scan(no_docs(spark)).collect() == []


def test_two_notices_in_one_file_are_both_found(spark, tmp_path):
    rows = [(1000 + i, prose(i, 40), "en", "a", 1) for i in range(30)]
    pairs = list(combinations(licenses.TEMPLATES, 2))
    rows += [(i, f"{a[1]}. {prose(i, 20)} {b[1]}", "en", "a", 1) for i, (a, b) in enumerate(pairs)]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.op7_licenses(spark, str(tmp_path)).collect()}
    assert [i for i, (a, b) in enumerate(pairs) if not {a[0], b[0]} <= found[i]] == []


def test_licences_equal_joins_in_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    expected = con.execute(licenses.ORACLE).fetchall()
    found = licenses.op7_licenses(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


# ------------------------------------------------------------------ 8 chat

def test_chat_keeps_maximal_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 3)  # several stretches in a conversation
    rng = random.Random(1)
    base = [[(rng.choice(["user", "bot", None]), rng.choice(["a", "b", "", None])) for _ in range(12)] for _ in range(3)]
    talks = {i: base[i % 3][:rng.randint(1, 12)] for i in range(40)}
    talks[40] = base[0]
    talks[41] = base[0]
    talks[42] = [("user", "other")]
    talks[43] = base[0][:5] + [("user", "fork")]
    rows = [(i, k, role, text, "x") for i, turns in talks.items() for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, h1 string")
    kept = {i for i, t in talks.items() if not any(
        (len(u) > len(t) or (len(u) == len(t) and j < i)) and u[:len(t)] == t for j, u in talks.items())}
    found = {r["conv_id"]: r for r in chat.render(frame).collect()}
    assert found.keys() == kept
    for i, r in found.items():
        assert r["text"] == "".join(f"<|{a or 'unknown'}|>\n{b or ''}\n" for a, b in talks[i])
        assert r["n_turns"] == len(talks[i])


def test_chat_bears_nulls_ties_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 0, "user", "hi"), (None, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"),
            (2, None, "bot", "x" * 100_000)]
    found = {r["conv_id"]: r["n_turns"] for r in chat.render(spark.createDataFrame(rows, schema)).collect()}
    assert found == {None: 2, 1: 2, 2: 1}
    assert chat.render(spark.createDataFrame([], schema)).collect() == []


# ------------------------------------------------------------------ 9 embeddings

def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF_ROWS", 60)  # deal leaves out
    rng = np.random.default_rng(4)
    hubs = rng.normal(size=(20, 24))
    vectors = [hubs[k % 20] + rng.normal(size=24) * (0.12 if k % 20 < 5 else 0.5) for k in range(600)]
    vectors += [vectors[0]] * 100 + [2 * vectors[1]]
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [1.0] * 23 + [None]), (904, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r for r in embedding_dedup.links(frame).collect()}
    assert found.keys() == {i for i, _ in rows}
    unit = np.array([v for _, v in rows[:-5]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    true, own = near.sum(1) - 1, np.array([found[i]["n_links"] for i in range(len(unit))])
    assert (own <= true).all() and own.sum() >= 0.97 * true.sum()
    i, j = np.nonzero(near)
    least = roots(len(unit), i, j)
    assert np.mean([found[k]["component_id"] == least[k] for k in range(len(unit))]) > 0.97
    for k in (900, 901, 902, 903, 904):
        assert (found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) == (0, k, True)
    assert embedding_dedup.links(frame.limit(0)).collect() == []


# ------------------------------------------------------------------ 10 fingerprints

def check_fingerprints(rows, texts):
    ordered = sorted(texts, key=lambda t: t[0], reverse=True)
    found = {r["doc_id"]: r for r in rows}
    for k, (doc_id, text, *_) in enumerate(ordered):
        text, other = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        new = text[:len(text) - third] + other[:third]
        r = found[doc_id]
        own = [sketches.sketch(t.encode()) for t in (text, new, other)]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == own[0].astype("<u4").tobytes().hex()
        assert r["edited_fingerprint"] == own[1].astype("<u4").tobytes().hex()
        assert (r["near_edited"], r["near_next"]) == (
            sketches.compared(own[0], own[1])[0], sketches.compared(own[0], own[2])[0])


def test_fingerprints_of_documents_and_corner_rows(spark, tmp_path):
    check_fingerprints(sketches.op10_fingerprints(spark, SF).collect(), documents())
    texts = [r for r in corner_rows() if r[0] is not None and r[0] != 8]
    spark.createDataFrame(texts, DOC_SCHEMA).write.parquet(f"{tmp_path}/one/documents.parquet")
    check_fingerprints(sketches.op10_fingerprints(spark, f"{tmp_path}/one").collect(), texts)
    corner_docs(spark).write.parquet(f"{tmp_path}/all/documents.parquet")
    assert sketches.op10_fingerprints(spark, f"{tmp_path}/all").count() == len(corner_rows())
    no_docs(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert sketches.op10_fingerprints(spark, f"{tmp_path}/none").collect() == []


def test_sketches_estimate_containment_and_merge():
    long, short = prose(1, 20_000), " ".join(prose(1, 20_000).split()[:2_000])
    a, b = sketches.sketch(long.encode()), sketches.sketch(short.encode())
    _, in_other, of_other = sketches.compared(b, a)
    assert in_other > 0.98 and abs(of_other - 0.1) < 0.02
    x, y = prose(2, 9).encode(), prose(3, 900).encode()
    both = sketches.merged(sketches.sketch(x), sketches.sketch(y))
    assert sketches.compared(both, sketches.sketch(y))[0] > 0.9
    assert sketches.compared(sketches.sketch(b""), sketches.sketch(None))[0] == 1.0
    assert sketches.sketch(b"one").tolist() == sketches.sketch(b" ONE\n").tolist()


def test_column_functions_agree_with_their_helpers(spark):
    frame = spark.createDataFrame([(prose(1, 50), prose(1, 60))], "a string, b string")
    row = frame.select(sketches.containment(sketches.sketch_column("a"), sketches.sketch_column("b")).alias("c")).first()
    assert row["c"]["in_other"] > 0.9 and row["c"]["of_other"] < 1
