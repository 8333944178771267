"""Every pipeline stage on corner rows: same columns, no crash, whole results."""

from __future__ import annotations

import pytest
from corner import CLASHING, DOC_SCHEMA, corner_docs, no_docs, prose

import corpus_pipeline
from tramloom.llm.line_dedup import without_duplicate_lines
from tramloom.llm.mixing import mixed_documents
from tramloom.llm.simhash import keep_one_of_each
from tramloom.llm.toxicity import not_toxic

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 1, 1)], LABELS).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_bears_corner_rows_and_clashing_columns(spark, folder, name, stage):
    docs = corner_docs(spark, clashing=True)
    found = stage(spark, docs, folder)
    if name != "packing":
        assert found.columns == COLUMNS + list(CLASHING)
    out = found.collect()
    ids = {r["doc_id"] for r in out}
    assert ids <= {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None}
    if name == "packing":
        assert ids == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None}
    else:
        assert all(r["_fp"] == 2 and r["row"] == "x" and r["size"] == 9 for r in out)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_bears_an_empty_table(spark, folder, name, stage):
    assert stage(spark, no_docs(spark), folder).collect() == []


def test_near_dedup_keeps_one_row_of_each_group(spark):
    kept = keep_one_of_each(corner_docs(spark)).collect()
    ids = sorted((r["doc_id"] for r in kept if r["doc_id"] is not None))
    assert ids == [1, 4, 6, 7, 8, 9, 10] or ids == [1, 3, 4, 6, 7, 8, 9, 10]
    assert [r["doc_id"] for r in kept].count(8) == 1  # repeated rows
    assert sum(r["doc_id"] is None for r in kept) == 1  # the empty one went with 4


def test_line_dedup_removes_later_lines_only(spark):
    kept = {(r["doc_id"], r["text"]) for r in without_duplicate_lines(corner_docs(spark)).collect()}
    texts = dict((k, t) for k, t in kept if k is not None)
    assert texts[1] == prose(1, 60)
    assert 2 not in texts  # its only line is a copy
    assert texts[7].count("\n") == 3
    assert texts[8] == prose(99, 15)
    assert texts[4] == "" and texts[5] is None and texts[11] == " \t\n\x0b "


def test_mix_repeats_whole_documents_and_cuts_few(spark):
    docs = spark.createDataFrame(
        [(i, prose(i, 100), "en", f"s{i % 4}", 1) for i in range(400)], DOC_SCHEMA)
    out = [(r["doc_id"], r["source"], len(r["text"].split())) for r in mixed_documents(docs).collect()]
    by_source = {}
    for _, source, words in out:
        by_source[source] = by_source.get(source, 0) + words
    # 60,000 words by weights 5, 2, 1, 5 with a limit of 20,000.
    assert by_source.keys() == {"s0", "s1", "s2", "s3"}
    for source, target in (("s0", 20_000), ("s1", 13_333), ("s2", 6_667), ("s3", 20_000)):
        assert abs(by_source[source] - target) <= 16
    assert sum(words < 100 for _, _, words in out) <= 8


def test_toxic_documents_go_and_others_stay(spark):
    toxic = [(i, prose(i, 40) + " vile", "en", "a", 1) for i in range(60)]
    clean = [(i, prose(i, 40), "en", "a", 1) for i in range(100, 500)]
    docs = spark.createDataFrame(toxic + clean, DOC_SCHEMA)
    labels = spark.createDataFrame(
        [(r[0], 1, int(r[0] < 100)) for r in toxic + clean], LABELS)
    kept = {r["doc_id"] for r in not_toxic(docs, labels).collect()}
    assert not kept & set(range(60))
    assert len(kept & set(range(100, 500))) >= 396
