"""Clusters by cells against all distances in whole numbers."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from lakeops.llm import queries, va_clusters

SF = "/root/testdata/sf0.01"


def plain_clusters(points, k=8, rounds=10, scale=1024, seed="3:"):
    """(id, cluster, distance, cluster's inertia, inertia, digest) in Python integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in points]
    order = sorted(kept, key=lambda p: (hashlib.sha256(f"{seed}{p[0]}".encode()).hexdigest(), p))
    centroids = [v for _, v in order[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        of = [min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c)) for _, v in kept]
        if turn == rounds:
            break
        for c in range(len(centroids)):
            if mine := [v for (_, v), o in zip(kept, of) if o == c]:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    distance = [apart(v, centroids[c]) for (_, v), c in zip(kept, of)]
    inertia = [sum(d for d, o in zip(distance, of) if o == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), c, d in zip(kept, of, distance))


def table(spark, points, dimension=None):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in points], "vec_id long, embedding array<float>")


def found_in(df):
    return sorted(map(tuple, df.collect()))


def test_given_vectors_against_sql(spark):
    report = []
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert found_in(va_clusters.cluster(vectors, report=report)) == sorted(duckdb.sql(queries.clusters_sql()).fetchall())
    # the cells alone keep most vectors in their cluster
    assert all(r["fetched"] < 200 for r in report[1:]) and all(r["fetched"] >= r["moved"] for r in report)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_few_bits_ties_and_outliers(spark, bits):
    random = np.random.default_rng(1)
    points = [(i, v) for i, v in enumerate(random.integers(-3, 4, (300, 4)) / 2)]
    points += [(7, points[7][1]), (7, points[8][1]), (1000, [100_000.0, -100_000.0, 0, 1e-30]), (1001, [0.0, -0.0, 0.0, 0.0])]
    assert found_in(va_clusters.cluster(table(spark, points), k=5, dimension=4, bits=bits)) == plain_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in points], k=5)


def test_tables_bound_every_difference():
    """The least difference of a cell is never above that of a vector in it."""
    random = np.random.default_rng(2)
    v = random.integers(-500, 500, (400, 6))
    centroids = random.integers(-400, 400, (5, 6))
    first = np.sort(random.integers(-480, 480, (6, 7)), axis=1)
    least = np.concatenate([np.full((6, 1), -500), first], axis=1)
    most = np.maximum(np.concatenate([first - 1, np.full((6, 1), 499)], axis=1), least)
    cells = np.stack([np.searchsorted(least[d], v[:, d], "right") - 1 for d in range(6)], axis=1)
    tables, exact = va_clusters.difference_tables(centroids, least, most), va_clusters.distances(v, centroids)
    for own in range(5):
        low = sum(tables[d][own][cells[:, d]] for d in range(6))
        assert (low <= exact - exact[:, [own]]).all() and (low[:, own] == 0).all()


def test_rows_that_take_no_part(spark):
    good = [(3, [0.5, 1.0]), (None, [2.0, 2.0]), (1, [0.25, -0.3]), (1, [0.25, -0.3])]
    bad = [(4, None), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, None]), (9, [float("nan"), 0.0]), (10, [0.0, float("-inf")]), (11, [1e30, 0.0])]
    rows = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in good + bad], "vec_id long, embedding array<float>, row int, cluster int, v int")
    found = va_clusters.cluster(rows, dimension=2).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in found) == [(False, 1), (False, 1), (False, 3), (True, 0)]
    # four centroids, two of them equal: the smaller number takes both copies
    assert all(r["distance"] == 0 and r["inertia"] == 0 for r in found) and len({r["cluster"] for r in found}) == 3


def test_empty_tables(spark):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for rows in ([], [(1, None)]):
        found = va_clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert found.columns == names and found.collect() == []
