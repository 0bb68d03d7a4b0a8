"""Repeated passages of over 50 words in the pipeline."""

import pytest

import corpus_pipeline


def cut_words(texts, n):
    """The words of each text that no run of n words found elsewhere covers."""
    split = [t.split() for t in texts]
    seen = {}
    for i, w in enumerate(split):
        for k in range(len(w) - n + 1):
            seen.setdefault(tuple(w[k : k + n]), []).append((i, k))
    gone = {(i, k + d) for places in seen.values() if len(places) > 1 for i, k in places for d in range(n)}
    return [[x for k, x in enumerate(w) if (i, k) not in gone] for i, w in enumerate(split)]


def texts_with(passage):
    fill = lambda i, n: " ".join(f"f{i}x{k * 7919 % 1009}" for k in range(n))
    return [f"{fill(1, 70)} {passage} {fill(2, 40)}", f"{passage} {fill(3, 30)}", f"{fill(4, 20)}\n{passage}", fill(5, 80)]


@pytest.mark.parametrize("words, letters", [(51, 1), (51, 5), (50, 5), (64, 5), (120, 3)])
def test_passages_of_over_fifty_words_go(spark, words, letters):
    passage = " ".join("abcdefghij"[k % 10 : k % 10 + 1] * letters if k % 3 else chr(107 + k // 3 % 15) * letters for k in range(words))
    texts = texts_with(passage)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        if name.startswith("repeated"):
            df = stage(spark, df, "")
    got = {r.doc_id: r for r in df.collect()}
    assert [got[i].text.split() for i in range(4)] == cut_words(texts, 51)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert (passage in got[0].text) == (words == 50)
