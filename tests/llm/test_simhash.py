"""SimHash fingerprints and their components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from lakeops.llm import simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """The smallest key reachable from each key."""
    root = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[b] < root[a] and bin(prints[a] ^ prints[b]).count("1") <= distance:
                    root[a], changed = root[b], True
    return root


def test_texts_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    found = {r["doc_id"]: r for r in simhash.near_fingerprints(docs).collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in found.items()} == prints
    assert all(len(r["fingerprint"]) == 16 for r in found.values())
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(prints, 3)


@pytest.mark.parametrize("bucket", [16, 40, 2048])
def test_crowded_fingerprints(spark, monkeypatch, bucket):
    """Thousands of fingerprints that agree in most blocks: buckets are cut down to a few bits, and no link is lost."""
    random = np.random.default_rng(5)
    base = int(random.integers(0, 2**63))
    values = {base}
    while len(values) < 500:  # a few flipped bits of one value
        values.add(base ^ sum(1 << int(b) for b in random.choice(64, random.integers(1, 8), replace=False)))
    values |= {int(x) for x in random.integers(0, 2**63, 100)} | {0, (1 << 64) - 1, (1 << 64) - 8}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fp long")
    pairs = set()
    for met in simhash.bucketed(nodes, 3, bucket):
        held = {}
        for r in met.collect():
            held.setdefault((r["mask"], r["part"]), []).append(r["fp"] % (1 << 64))
        assert all(len(x) <= bucket for x in held.values())
        pairs |= {frozenset((a, b)) for x in held.values() for a in x for b in x if a < b and bin(a ^ b).count("1") <= 3}
    assert pairs == {frozenset((a, b)) for a in values for b in values if a < b and bin(a ^ b).count("1") <= 3}


def test_a_bucket_must_be_able_to_end(spark):
    with pytest.raises(ValueError, match="bucket"):
        simhash.near_fingerprints(spark.createDataFrame([(1, "a")], "doc_id long, text string"), bucket=8)


def test_edges(spark):
    long = " ".join(f"x{i * i % 9973}" for i in range(80_000))
    texts = [
        (5, "One two three four"), (5, "one TWO three  four"), (3, None), (4, ""), (9, " \n\t"), (7, long), (8, long + " end"), (None, "one two three four"),
        (None, "nobody has this text"), (None, None), (11, "two words"), (12, "Ünï çode"), (2, "Ünï çode "),
    ]
    docs = spark.createDataFrame([(*t, 1, 2, 3, 4) for t in texts], "doc_id long, text string, fp int, mask int, root int, part int")
    found = simhash.near_fingerprints(docs).collect()
    assert len(found) == len(texts)
    assert sorted((r["doc_id"] or -1, int(r["fingerprint"], 16)) for r in found) == sorted((i or -1, plain_fingerprint(t)) for i, t in texts)
    component = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in found}
    of = lambda i, t: component[i, f"{plain_fingerprint(t):016x}"]
    assert of(5, "one two three four") == of(None, "one two three four") == 5
    assert of(3, None) == of(4, "") == of(9, "") == of(None, "") == 3
    assert of(8, long + " end") == 7
    assert of(None, "nobody has this text") is None
    assert of(12, "Ünï çode") == 2


def test_empty_table(spark):
    found = simhash.near_fingerprints(spark.createDataFrame([], "doc_id long, text string"))
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and found.collect() == []


def test_many_equal_rows(spark):
    docs = spark.range(20_000).selectExpr("id + 10 AS doc_id", "'all the very same words' AS text")
    found = simhash.near_fingerprints(docs).selectExpr("count(*)", "min(component_id)", "max(component_id)", "count(DISTINCT fingerprint)").first()
    assert tuple(found) == (20_000, 10, 10, 1)
