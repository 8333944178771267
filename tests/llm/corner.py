"""Rows every operator and stage must bear, and small helpers."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names helper columns might have, too.
CLASHING = {"fp": 1, "_fp": 2, "_id": 3, "_n": 4, "row": "x", "h": 5, "score": 0.5, "range": 6, "_text": "y",
            "component": 7, "_gone": 8, "size": 9, "taken": 10, "key": "k", "class": 11}


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ("ka", "to", "mi", "re", "so", "lun", "pe", "dra", "vi", "no")
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corner_rows() -> list[tuple]:
    base = prose(1, 60)
    near = base.rsplit(" ", 1)[0] + " end"
    lines = "\n".join(prose(50 + i, 12) for i in range(4))
    return [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "b", len(base)),
        (3, near, "en", "a", len(near)),
        (4, "", "en", "a", 0),
        (5, None, None, None, None),
        (6, "one", "de", "c", 3),
        (7, lines, "de", "c", len(lines)),
        (8, lines + "\n" + prose(99, 15), "de", None, None),
        (8, lines + "\n" + prose(99, 15), "de", None, None),
        (None, prose(5, 40), "en", "b", 1),
        (None, None, "en", "b", None),
        (9, prose(6, 30_000), "fr", "b", 1),
        (10, "x" * 200_000, "fr", "é", 1),
        (11, " \t\n\x0b ", "es", "", 5),
    ]


def corner_docs(spark: SparkSession, clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(corner_rows(), DOC_SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        docs = docs.withColumns({name: F.lit(value) for name, value in CLASHING.items()})
    return docs


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOC_SCHEMA)


def rows(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
