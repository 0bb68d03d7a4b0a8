"""Rows of the pipeline without an id, or with a repeated one, are judged each by its own text."""

import corpus_pipeline
from lakeops.llm import near_dup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(k):
    return " ".join(f"word{k}x{i}" for i in range(40))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_quality_stage_keeps_clean_rows_under_a_rejected_id(spark):
    df = frame(spark, [(None, "too short", "en"), (None, text(1), "en"), (7, "bad", "de"), (7, text(2), "de"), (8, None, "en"), (9, text(3), None)])
    got = left(corpus_pipeline.quality_stage(spark, df, SF))
    assert got == sorted([(None, text(1)), (7, text(2)), (9, text(3))], key=str)


def test_near_duplicate_stage_keeps_unlike_rows_under_a_rejected_id(spark):
    copy = text(4).replace("word4x39", "other")
    df = frame(spark, [(3, text(4), "en"), (None, text(4), "en"), (None, text(5), "en"), (7, copy, "en"), (7, text(6), "en"), (8, text(7), "en"), (None, "", "en")])
    got = left(corpus_pipeline.near_duplicate_stage(spark, df, SF))
    assert got == sorted([(3, text(4)), (None, text(5)), (7, text(6)), (8, text(7)), (None, "")], key=str)


def test_near_duplicate_stage_keeps_the_smallest_id(spark):
    df = frame(spark, [(9, text(1), "en"), (5, text(1), "en"), (9, text(2), "en"), (6, text(2), "en")])
    assert left(corpus_pipeline.near_duplicate_stage(spark, df, SF)) == [(5, text(1)), (6, text(2))]
    assert near_dup.near_duplicates(df).columns == ["doc_id", "n_shingles", "component_id", "kept"]
