"""License scans by a positional rare-token index, in DataFrame functions.

The templates' words form the index: each word with its positions in each template, and its
rarity (inverse document frequency) over all documents.  For each template that a file's
words could make up, the file looks up the rarest words of the template's key phrase.  Each pair of a position in the file and one in the template votes for their
difference, the place where the template would begin.  A place must hold the key phrase where
it belongs, so one without all these votes can't match; the others are aligned word by word,
weighed by rarity.
A template whose words in the file could not reach the needed weight is not looked up at all.

All of this happens within a document's row.  Only the counts of the licence words, of which
there are fewer than a hundred, cross tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm.common import read_table

#: Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Label, opening words of the common notice, key phrase in it.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file "
     "except in compliance with the license", "apache license version"),
    ("apache", "licensed under the apache license version 2 0", "apache license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", "source and binary forms"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation",
     "gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free "
     "software foundation", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files", "permission is hereby granted"),
    ("mit", "released under the mit license", "the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
)

#: Everything but ASCII letters and digits and what is beyond ASCII separates words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Distinct words that a file looks up in the SQL twin, for all templates together.
RAREST = 12
#: Distinct words of a template's key phrase that a file looks up.
KEY_WORDS = 2
#: Share of a template's weight that must be in place.
COVERAGE = 0.6
VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in text.split()}
                    | {w for phrase, _ in PHRASES for w in phrase.split()})


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rarities(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every licence word over all rows of ``docs``."""
    own = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, VOCABULARY)))
    # One count per licence word, and one for the rows.
    counts = dict(docs.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("word"))
                  .groupBy("word").count().collect())
    rows = counts.get("", 0)
    return {w: log((rows + 2) / (counts.get(w, 0) + 1)) for w in VOCABULARY}


def _template_column(rarity: dict[str, float]) -> Column:
    entries = []
    for label, text, key in TEMPLATES:
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        posts = [F.struct(F.lit(w).alias("word"), F.lit(i).alias("at"), F.lit(rarity[w]).alias("weight"))
                 for i, w in enumerate(words)]
        entries.append(F.struct(
            F.lit(label).alias("label"), F.array(*posts).alias("posts"),
            F.array(*map(F.lit, words)).alias("words"), F.lit(sum(rarity[w] for w in words)).alias("total"),
            F.lit(at).alias("key_at"), F.array(*map(F.lit, phrase)).alias("key")))
    return F.array(*entries)


def _weight(posts: Column, counts: Callable[[Column], Column]) -> Column:
    return F.aggregate(
        F.transform(posts, lambda p: F.when(counts(p), p["weight"]).otherwise(0.0)), F.lit(0.0),
        lambda total, weight: total + weight)


def _base_places(words: Column, own: Column) -> Column:
    """label and start of every place where a base phrase stands."""
    def of_phrase(parts: list[str], label: str) -> Column:
        phrase = F.array(*map(F.lit, parts))
        here = F.transform(words, lambda w, i: F.when(
            (w == parts[0]) & (F.slice(words, i + 1, len(parts)) == phrase), i))
        possible = F.forall(phrase, lambda w: F.array_contains(own, w))
        starts = F.when(possible, F.filter(here, lambda i: i.isNotNull())).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            F.lit(label).alias("label"), i.cast("long").alias("start")))

    return F.concat(*[of_phrase(phrase.split(), label) for phrase, label in PHRASES])


def _aligned(words: Column, own: Column, template: Column) -> Column:
    """label, start and coverage of the verified places of one template in a file.

    ``own`` has the file's licence words, the rarest first.
    """
    rare = F.slice(F.array_intersect(own, template["key"]), 1, KEY_WORDS)
    posts = F.filter(template["posts"], lambda p: F.array_contains(rare, p["word"]) & (
        p["at"] >= template["key_at"]) & (p["at"] < template["key_at"] + F.size(template["key"])))

    def of_posts(looked_up: Column) -> Column:
        hits = F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
            lambda h: F.exists(looked_up, lambda p: p["word"] == h["word"]))
        votes = F.array_sort(F.flatten(F.transform(hits, lambda h: F.transform(
            F.filter(looked_up, lambda p: p["word"] == h["word"]), lambda p: h["at"] - p["at"]))))
        needed = F.size(looked_up)
        return bind(votes, lambda v: F.array_distinct(
            F.filter(v, lambda start, i: F.get(v, i + needed - 1) == start)))

    def checked(start: Column) -> Column:
        covered = _weight(
            template["posts"], lambda p: F.coalesce(F.get(words, start + p["at"]) == p["word"], F.lit(False)))
        phrase = F.transform(template["key"], lambda w, i: F.coalesce(
            F.get(words, start + template["key_at"] + i) == w, F.lit(False)))
        return F.struct(
            template["label"].alias("label"), start.cast("long").alias("start"),
            (covered / template["total"]).alias("coverage"), F.forall(phrase, lambda same: same).alias("key"))

    places = F.transform(bind(posts, of_posts), checked)
    return F.filter(places, lambda p: p["key"] & (p["coverage"] >= COVERAGE))


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``scan`` to ``docs``: n_words, base (label, start) and notices (label, start, coverage).

    Every row is scanned by itself, so repeated rows and null ids need no care.  Null and empty
    texts have no words and no places.  Without rows there is nothing to weigh or scan.
    """
    rarity = rarities(docs)
    ranked = F.array(*[F.lit(w) for w in sorted(VOCABULARY, key=lambda w: (-rarity[w], w))])
    templates = _template_column(rarity)

    def of_file(words: Column) -> Column:
        def of_own(own: Column) -> Column:
            possible = F.filter(templates, lambda t: _weight(
                t["posts"], lambda p: F.array_contains(own, p["word"])) >= COVERAGE * t["total"])
            notices = F.flatten(F.transform(possible, lambda t: _aligned(words, own, t)))
            return F.struct(
                F.size(words).cast("long").alias("n_words"), _base_places(words, own).alias("base"),
                notices.alias("notices"))

        # Licence words of the file, the rarest first.
        return bind(F.array_intersect(ranked, words), of_own)

    return docs.withColumn("scan", bind(words_of(F.col("text")), of_file))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases, labels and score of every document.

    The score is half for a base phrase alone, and half plus half the coverage for a notice.
    """
    scanned = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, notices = F.col("scan.base"), F.col("scan.notices")
    starts = F.transform(base, lambda b: b["start"])
    base_labels = F.transform(base, lambda b: b["label"])
    labels = F.concat(base_labels, F.transform(notices, lambda n: n["label"]))
    covered = F.array_max(F.transform(notices, lambda n: n["coverage"]))

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(found)), ",")

    return scanned.select(
        "doc_id", "scan.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"),
        F.round(F.least(F.coalesce(0.5 + covered / 2, F.when(F.size(base) > 0, 0.5), F.lit(0.0)), F.lit(1.0)), 6)
        .alias("score"))


def _oracle() -> str:
    """The same scan as joins of word and template positions."""
    phrases = ", ".join(f"('{label}', string_split('{text}', ' '))" for text, label in PHRASES)
    templates = ", ".join(
        f"({k}, '{label}', string_split('{text}', ' '), string_split('{key}', ' '), "
        f"{len(text[:text.index(key)].split())})"
        for k, (label, text, key) in enumerate(TEMPLATES))
    return rf"""
with files as (
    select row_number() over () as f, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
phrases(label, parts) as (values {phrases}),
templates(t, label, parts, key, key_at) as (values {templates}),
posts as (select t, unnest(parts) as word, unnest(range(len(parts))) as place from templates),
vocabulary as (select word from posts union select unnest(parts) from phrases),
spots as (select f, word, place from (
    select f, unnest(words) as word, unnest(range(len(words))) as place from files) join vocabulary using (word)),
rarity as (
    select word, ln(((select count(*) from files) + 2)::double / (count(distinct f) + 1)) as weight
    from vocabulary left join spots using (word) group by word),
weighed as (select * from posts join rarity using (word)),
totals as (select t, sum(weight) as total, count(*) as n from weighed group by t),
own as (
    select f, word, row_number() over (partition by f order by weight desc, word) <= {RAREST} as rare
    from (select distinct f, word from spots) join rarity using (word)),
candidates as (
    select f, t, total, count(*) filter (rare) as looked_up
    from own join weighed using (word) join totals using (t)
    group by f, t, total having sum(weight) >= {COVERAGE}::double * total),
starts as (
    select c.f, c.t, c.total, s.place - p.place as start
    from candidates c join own o on o.f = c.f and o.rare
      join weighed p on p.t = c.t and p.word = o.word join spots s on s.f = c.f and s.word = o.word
    group by c.f, c.t, c.total, start, looked_up having count(*) >= greatest(2, ceil(looked_up * {COVERAGE}::double))),
aligned as (
    select s.f, s.t, s.start, sum(p.weight) / any_value(s.total) as coverage
    from starts s join weighed p on p.t = s.t
      join spots o on o.f = s.f and o.place = s.start + p.place and o.word = p.word
    group by s.f, s.t, s.start),
notices as (
    select f, label, coverage from aligned join templates using (t) join files using (f)
    where coverage >= {COVERAGE}::double and words[start + key_at + 1:start + key_at + len(key)] = key),
base as (
    select s.f, label, s.place as start from spots s join files using (f) join phrases on parts[1] = s.word
    where words[s.place + 1:s.place + len(parts)] = parts),
labels as (select f, string_agg(distinct label, ',' order by label) as labels from (
    select f, label from base union select f, label from notices) group by f),
places as (
    select f, count(*) as n_base, min(start) as first_word, max(start) as last_word,
      string_agg(distinct label, ',' order by label) as base_labels from base group by f),
best as (select f, max(coverage) as coverage from notices group by f)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  round(least(coalesce(0.5 + coverage / 2, case when n_base > 0 then 0.5 end, 0)::double, 1), 6) as score
from files left join places using (f) left join labels using (f) left join best using (f)
"""


ORACLE = _oracle()
