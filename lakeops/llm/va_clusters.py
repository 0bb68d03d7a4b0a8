"""Clusters around centroids, in exact integers, with the vectors compressed to cells (a VA-file).

1. Every component becomes the integer floor(scale * x). Per dimension, cells of a few bits are bounded by approximate quantiles of all
   vectors, and by the exact least and largest value. A vector's cells are one byte per dimension.
2. A round reads the cells alone. Tables hold, per dimension, cell and centroid, the interval of what a value of the cell can add to the squared
   distance, measured against the centroid that the vector is with: that difference is linear in the value, which keeps the intervals far narrower than those of two
   separate distances. Their sums bound how much farther each other centroid is.
3. Full vectors are fetched, by a join on the row number, only where such an interval reaches zero, so that another centroid may be nearer. Sums move
   by the vectors that change their cluster, all of them fetched. A centroid's new place is the floor of its sum divided by its count, in whole numbers.
4. Rounds that change nothing end the loop early; further ones would not change anything either. The driver holds centroids, sums, counts and cell
   bounds: their size depends on the number of centroids, dimensions and cells alone.

Edge cases: vectors that are null, of another dimension, or hold null or non-finite components take no part and get no row; neither do vectors with
a component of more than ``LARGEST`` after scaling, as their squared distances would not fit a long; fewer vectors than centroids give fewer
centroids; repeated rows each count; equal hashes of the start are ordered by id and components; a null id is kept, and hashed as an empty string; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sources.staging import stage

#: Bits of a cell; at most 8, as cells are bytes.
CELL_BITS = 8
#: Largest absolute component: 64 squares of twice as much fit a long.
LARGEST = 1 << 27
#: Vectors bounded at once.
BATCH = 4096


def scaled(vectors: DataFrame, dimension: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, the integer components, of the vectors that take part."""
    value = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    fits = (F.size(vector_col) == dimension) & F.forall(value, lambda x: F.coalesce(F.abs(x) <= LARGEST, F.lit(False)))  # not so of NaN, which is above all
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fits, value).alias("value")).where("value IS NOT NULL")
    return kept.select("vec_id", F.transform("value", lambda x: F.floor(x).cast("int")).alias("v"))


def first_centroids(points: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id; at most k rows come to the driver."""
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(key.alias("key"), "vec_id", "v").orderBy("key", "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cell_edges(points: DataFrame, dimension: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each cell of each dimension."""
    n = 1 << bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    rows = (
        points.select(F.posexplode("v").alias("at", "x"))
        .groupBy("at")
        .agg(F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", shares, F.lit(2000)).alias("inner"))
        .collect()  # a row per dimension
    )
    least, most = np.zeros((dimension, n), np.int64), np.zeros((dimension, n), np.int64)
    for r in rows:
        first = np.r_[r["least"], np.maximum.accumulate(r["inner"])]
        least[r["at"]] = first
        # an empty cell, between equal quantiles, is never used
        most[r["at"]] = np.maximum(np.r_[first[1:] - 1, r["most"]], first)
    return least, most


def compressed(points: DataFrame, least: np.ndarray) -> DataFrame:
    """Points with ``cells``: per dimension the last cell that begins at or before the value."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, len(least)), np.int32)
            cells = np.stack([np.searchsorted(least[d], v[:, d], "right") - 1 for d in range(len(least))], axis=1).astype(np.uint8)
            yield b.assign(vec_id=b["vec_id"].astype("Int64"), cells=[c.tobytes() for c in cells])

    return points.mapInPandas(run, "vec_id long, v array<int>, cells binary")


def difference_tables(centroids: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """By dimension, own centroid, cell and other centroid: the least that a value of the cell adds to the other's squared distance minus the own one's."""
    c = centroids.T  # dimension, centroid
    square, apart = (c * c)[:, None, :] - (c * c)[:, :, None], 2 * (c[:, None, :] - c[:, :, None])
    # the difference is linear in the value, so it is least at an end of the cell
    ends = [square[:, :, None, :] - x[:, None, :, None] * apart[:, :, None, :] for x in (least, most)]
    return np.minimum(*ends)


def still_nearest(state: DataFrame, centroids: np.ndarray, least: np.ndarray, most: np.ndarray) -> DataFrame:
    """State rows with ``stays``: by the cells alone, no other centroid can be nearer than that of their cluster."""
    tables = difference_tables(centroids, least, most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cells = np.frombuffer(b"".join(b["cells"]), np.uint8).reshape(len(b), len(least))
            own, stays = b["cluster"].to_numpy(), np.empty(len(b), bool)
            for at in range(0, len(b), BATCH):
                part, mine = cells[at : at + BATCH], own[at : at + BATCH]
                low = np.zeros((len(part), len(centroids)), np.int64)
                for d in range(len(least)):
                    low += tables[d][mine, part[:, d]]
                # an equally near centroid takes the vector only if its number is smaller
                beyond = (low > 0) | (low == 0) & (np.arange(len(centroids)) >= mine[:, None])
                stays[at : at + BATCH] = beyond.all(axis=1)
            yield b.assign(stays=stays)

    return state.mapInPandas(run, "row long, cells binary, cluster int, stays boolean")


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((v.astype(np.int64) - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def fetched(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows that hold full vectors, with the nearest centroid as ``next``; the smaller number of equally near ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b = b.assign(next=distances(np.stack(b["v"].to_numpy()), centroids).argmin(axis=1).astype(np.int32))
            yield b

    return rows.mapInPandas(run, "row long, cells binary, cluster int, v array<int>, next int")


def moved_sums(rows: DataFrame, k: int, dimension: int) -> tuple[np.ndarray, list[list[int]]]:
    """What counts and sums of the clusters change by, from rows with cluster, next and v; k rows of sums come to the driver."""
    moved = rows.where("cluster != next").select("v", F.inline(F.array(F.struct(F.col("next").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("cluster").alias("c"), F.lit(-1).alias("sign"))))).where("c >= 0")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (c, sign), part in b.groupby(["c", "sign"]):
                yield pd.DataFrame({"c": [c], "n": [sign * len(part)], "sums": [sign * np.stack(part["v"].to_numpy()).sum(axis=0, dtype=np.int64)]})

    # a batch of rows becomes a row per cluster before anything is shuffled
    partial = moved.mapInPandas(run, "c int, n long, sums array<long>")
    total = F.array(*[F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dimension)])
    counts, sums = np.zeros(k, np.int64), [[0] * dimension for _ in range(k)]
    for r in partial.groupBy("c").agg(F.sum("n").alias("n"), total.alias("sums")).collect():
        counts[r["c"]] = r["n"]
        sums[r["c"]] = [int(x) for x in r["sums"]]
    return counts, sums


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimension: int = 64,
    scale: int = 1024,
    seed: str = "3:",
    bits: int = CELL_BITS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    report: list[dict] | None = None,
) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Sums beyond a long are null. ``report`` gets, per round, how many rows were fetched in full and how many moved.
    """
    spark = vectors.sparkSession
    points = stage(scaled(vectors, dimension, scale, id_col, vector_col), "points")
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    least, most = cell_edges(points, dimension, bits)
    # written once: the number of a row must not change
    points = stage(compressed(points, least).withColumn("row", F.monotonically_increasing_id()), "points-and-cells")
    full = points.select("row", "v")
    counts, sums = np.zeros(len(centroids), np.int64), [[0] * dimension for _ in centroids]
    state = points.select("row", "cells", F.lit(-1).alias("cluster"))
    for turn in range(rounds + 1):
        if turn == 0:
            # all vectors are new to their cluster, so all are fetched
            now, decided = stage(fetched(points.select("row", "cells", F.lit(-1).alias("cluster"), "v"), centroids), "fetched"), None
        else:
            seen = stage(still_nearest(state, centroids, least, most), "bounded")
            decided = seen.where("stays").drop("stays")
            # the written size of what is asked for lets Spark choose how to join
            asked = stage(seen.where("NOT stays").drop("stays"), "asked")
            now = stage(fetched(asked.join(full, "row").select("row", "cells", "cluster", "v"), centroids), "fetched")
        state = now.select("row", "cells", F.col("next").alias("cluster"))
        if decided is not None:
            state = decided.unionByName(state)
        if turn == rounds:
            break
        n, moved = moved_sums(now, len(centroids), dimension)
        if report is not None:
            report.append({"fetched": now.count(), "moved": now.where("cluster != next").count()})
        counts += n
        sums = [[x + y for x, y in zip(a, b)] for a, b in zip(sums, moved)]
        after = np.array([[x // int(m) for x in s] if m else c.tolist() for s, m, c in zip(sums, counts, centroids)], np.int64)
        if (after == centroids).all():
            break
        centroids = after

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            apart = ((np.stack(b["v"].to_numpy()).astype(np.int64) - centroids[b["cluster"].to_numpy()]) ** 2).sum(axis=1) if len(b) else np.empty(0, np.int64)
            yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64"), "cluster": b["cluster"], "distance": apart})

    placed = points.select("row", "vec_id", "v").join(state.select("row", "cluster"), "row").select("vec_id", "cluster", "v")
    placed = stage(placed.mapInPandas(final, "vec_id long, cluster int, distance long"), "placed")
    inertia = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values: dict[int, object], kind: str) -> Column:
        return F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(v).cast(kind))])[F.col("cluster")]

    long = lambda x: x if abs(x) < 1 << 63 else None
    return placed.select(
        "vec_id", "cluster", "distance",
        of_cluster({c: long(s) for c, s in inertia.items()}, "long").alias("cluster_inertia"),
        F.lit(long(sum(inertia.values()))).cast("long").alias("inertia"),
        of_cluster(dict(enumerate(digest)), "string").alias("centroid_sha256"),
    )
