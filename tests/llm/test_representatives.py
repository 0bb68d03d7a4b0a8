"""Large buckets and clusters meet their representative first: few rows, and no link lost."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import components, near_dup


def edited(base, k, seed, edits):
    r = random.Random(seed * 1000 + k)
    words = list(base)
    for at in r.sample(range(len(words)), edits):
        words[at] = f"e{k}x{at}"
    return " ".join(words)


def sets_equal_brute(spark, texts, percent=80, words=3):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(zip(*[t.split()[i:] for i in range(words)])) for t in texts]
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if root[j] < root[i] and 100 * len(a & b) >= percent * len(a | b):
                    root[i], changed = root[j], True
    found = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, words, percent).collect()}
    return found == dict(enumerate(root))


@pytest.mark.parametrize("edits", [1, 3, 6])
def test_clusters_of_all_kinds_keep_their_links(spark, monkeypatch, edits):
    """Tight clusters, chains in which the ends are not alike, and members that are alike to others but not to the representative."""
    monkeypatch.setattr(near_dup, "SET_BLOCK", 5)
    monkeypatch.setattr(near_dup, "SIGNATURE_BLOCK", 7)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(base, k, edits, edits) for k in range(40)]
    chain = list(base)
    for k in range(25):  # each step changes three more words
        chain[4 * k % 120 : 4 * k % 120 + 3] = [f"c{k}a", f"c{k}b", f"c{k}c"]
        texts.append(" ".join(chain))
    random.Random(edits).shuffle(texts)
    assert sets_equal_brute(spark, texts)


def groups_of(spark, n, alike, block=16):
    """Rows dealt into groups, and edges, for one key of n nodes."""
    rows = spark.range(n).selectExpr("7L AS band", "id AS node", "CAST(CAST(id AS string) AS binary) AS sig")
    groups, edges = near_dup.met(rows, "band", "sig", block, alike)
    return groups, edges


def test_a_tight_cluster_costs_a_row_each(spark):
    groups, edges = groups_of(spark, 3000, lambda b: np.ones(len(b), bool))
    assert groups.count() == 0
    assert sorted((r["a"], r["b"]) for r in edges.collect()) == [(i, 0) for i in range(1, 3000)]


def test_those_left_over_meet_all(spark):
    odd = lambda b: ~b["node"].isin(range(1, 3000, 300)).to_numpy()
    groups, edges = groups_of(spark, 3000, odd, 100)
    assert edges.count() == 2989
    rows = groups.collect()
    assert len(rows) < 2 * 3000  # one block of the left with each block of all
    met = {}
    for r in rows:
        met.setdefault((r["i"], r["j"]), set()).add(r["node"])
    for left in range(1, 3000, 300):
        assert set().union(*(m for m in met.values() if left in m)) == set(range(3000))


def test_nothing_alike_meets_in_all_pairs_of_blocks(spark):
    groups, edges = groups_of(spark, 120, lambda b: (b["node"] == 0).to_numpy(), 16)
    assert edges.count() == 0
    met = {}
    for r in groups.collect():
        met.setdefault((r["i"], r["j"]), set()).add(r["node"])
    pairs = {(a, b) for m in met.values() for a in m for b in m if a < b}
    assert pairs == {(a, b) for a in range(120) for b in range(a + 1, 120)}


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 10)
    random_ = random.Random(3)
    edges = [(0, i) for i in range(1, 200)] + [(999, i) for i in range(300, 420)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(random_.randrange(2000, 2100), random_.randrange(2000, 2100)) for _ in range(60)] + [(150, 350), (5, 5), (6, 0), (0, 6)]
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    found = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: r for n, r in root.items() if n != r}


def test_hub_edges_are_not_shuffled_by_the_hub(spark):
    edges = spark.range(20_000).select((F.col("id") % 1 - 1).alias("a"), F.col("id").alias("b"))
    joined = components.with_least(edges, 4096)
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and joined.where("m = 0").count() == 20_000
