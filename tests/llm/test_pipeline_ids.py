"""Rows without an id or with a shared one: the stages must not drop clean texts with others."""

from __future__ import annotations

import corpus_pipeline

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def left(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.text) for r in stage(spark, docs, SF).collect()), key=str)


def test_a_leak_takes_no_other_row_along(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    words = item.split()
    rows = [(None, f"they said {item} again"), (None, "a clean text"), (None, " ".join(words[:10])), (None, " ".join(words[6:16])),
            (7, f"and {item}"), (7, "a clean text of the same id")]
    clean = sorted([*rows[1:4], rows[5]], key=str)
    assert left(spark, corpus_pipeline.benchmark_decontamination, rows) == clean


def test_different_texts_of_one_id_are_judged_apart(spark):
    base = [f"b{k}" for k in range(60)]
    other = " ".join(f"c{k}" for k in range(60))
    rows = [(5, " ".join(base)), (9, " ".join([*base, "end"])), (9, other), (9, other), (None, other)]
    assert left(spark, corpus_pipeline.ngram_jaccard_join, rows) == sorted([rows[0], (9, other), (None, other)], key=str)


def test_a_corpus_without_labels_stays(spark, plan):
    rows = [(1, "some text", None, "s", 9), (2, "12 34", None, "s", 5), (3, None, None, None, None), (4, "ein Text", None, None, 8)]
    out = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[3]]


def test_texts_are_classified_once(spark, plan):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert plan(corpus_pipeline.language_id(spark, docs, SF)).count("ArrowEvalPython") == 1


def test_of_rows_with_one_id_and_text_the_first_by_the_other_columns_stays(spark):
    rows = [(1, "the same text", lang, source, 13) for lang in ("fr", "en", None) for source in ("b", "a")]
    for seed in range(3):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3 + seed)
        assert [tuple(r) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect()] == [(1, "the same text", None, "a", 13)]
