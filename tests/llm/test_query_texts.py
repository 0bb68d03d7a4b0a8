"""op2's query gives the text that is left, beside what says how much of it that is."""

import hashlib

from lakeops.llm import queries


def test_removed_passages_are_gone_from_the_text_of_the_query(spark, tmp_path):
    passage = " ".join(f"word{i:03d}" for i in range(60))
    texts = {1: f"before {passage} after", 2: f"other {passage}", 3: "nothing to remove", 4: None, 5: "", 6: passage + "\u00e9", 7: "\u00e8" + passage}
    rows = [(i, t) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert sorted(found) == sorted(texts)
    for i, r in found.items():
        assert r.n_bytes == len((texts[i] or "").encode()), "the length of the input, whatever is removed"
        assert passage not in r.text and len(r.text.encode()) == r.n_bytes - r.n_removed
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
    # the space before the passage repeats in the first two
    assert [found[i].text for i in sorted(found)] == ["before after", "other", "nothing to remove", "", "", "\u00e9", "\u00e8"]
