"""Rows that repeat an id and its text, or have no id: none of their texts is lost, and their number costs no more than reading them."""

import hashlib

import corpus_pipeline
from lakeops.llm import suffix_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(k):
    return " ".join(f"clean{k}word{i * 7919 % 1000}" for i in range(80))


def frame(spark, rows, more=""):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or ""), *([1, 2] if more else [])) for k, (i, t) in enumerate(rows)], SCHEMA + more)


ROWS = [
    *[(None, text(1))] * 3, *[(5, text(2))] * 2, (7, text(3)), (7, text(4)), (7, text(4)), (8, text(5)), (9, text(5)), (None, text(6)),
    (10, text(6)), (None, text(7)), (11, text(8)),
]


def through(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    return docs


def test_every_text_survives_the_stages_once(spark):
    left = through(spark, frame(spark, ROWS))
    assert sorted(r["text"] for r in left.collect()) == sorted({t for _, t in ROWS})
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_columns_named_as_those_used_inside(spark):
    left = through(spark, frame(spark, ROWS, ", _key long, _tag long"))
    assert sorted(r["text"] for r in left.collect()) == sorted({t for _, t in ROWS})
    assert {(r["_key"], r["_tag"]) for r in left.collect()} == {(1, 2)}


def test_packing_after_the_stages(spark):
    packed = corpus_pipeline.packing_stage(spark, through(spark, frame(spark, ROWS)), SF).collect()
    assert len(packed) == len({t for _, t in ROWS}) and all(r["start"] == 0 and r["length"] > 80 for r in packed)


def test_many_equal_rows_and_an_edited_copy(spark):
    """Each equal row loses all, the edited copy what it shares; the steps see the equal rows once."""
    words = [f"w{i}" for i in range(320)]
    same, edited = " ".join(words), " ".join([*words[:150], "edited", *words[150:]])
    rows = spark.range(30_000).selectExpr("CAST(NULL AS long) AS doc_id", f"'{same}' AS text").union(spark.createDataFrame([(1, edited), (2, "short")], "doc_id long, text string"))
    found = suffix_dedup.remove_repeats(rows).groupBy("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").count().collect()
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 3
    assert tuple(by_id[None])[1:] == (len(same), len(same), 1, empty, 30_000)
    # both halves are longer than 400 bytes, and each ends at the edit
    shared = len("edited ")
    assert by_id[1]["n_bytes"] - by_id[1]["n_removed"] in (shared - 1, shared, shared + 1)
    assert by_id[2]["n_removed"] == 0


def test_equal_rows_whose_text_repeats_inside(spark):
    inner = " ".join(f"v{i}" for i in range(150))
    rows = [(None, f"{inner} middle {inner}")] * 2000 + [(3, f"start {inner} end")]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = found.groupBy("doc_id").agg({"n_spans": "max", "n_removed": "min"}).collect()
    assert {r[0]: r["max(n_spans)"] for r in spans} == {None: 1, 3: 1}


def test_equal_rows_by_words(spark):
    rows = [(1, text(1)), (1, text(1)), (2, "too short to count"), (2, "too short to count"), (3, "  " + text(1))]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True, words=51).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in found) == [(1, ""), (1, ""), (2, "too short to count"), (2, "too short to count"), (3, "  ")]
