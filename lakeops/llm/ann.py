"""Approximate nearest neighbours by a hash-prefix forest (LSH forest).

Vectors are dealt by a hash of their id into shards of bounded size. A shard holds ``TREES`` sorted arrays of long hash strings: a tree
hashes a vector to the signs of its products with random directions, and the vectors that share a prefix of the string are a
range of the array. For a query each tree descends to its longest matching prefix; the trees then ascend together, one bit at a time, until enough
different candidates are in their ranges; all candidates are compared exactly.

How many candidates are enough is fitted per shard on a bounded sample: up to ``SAMPLE`` vectors of the shard are searched by brute force, and the count is the
one that finds ``TARGET`` of their true neighbours. Clustered data need few candidates, vectors without structure need many.
Every row is indexed, and the stated queries go to all shards, in blocks of bounded size; each shard returns its k best for a query, and
the best of these are the result.

Edge cases: vectors that are null, empty, zero, hold null or non-finite components, or differ in length from the query take no part; rows without an
id take no part; with fewer than k candidates all are returned; ties go to the smaller id; rows that repeat an id are candidates each, but
never for a query of the same id; other columns are ignored; an empty table or no query gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sources.staging import stage

TREES, BITS = 24, 24
SHARD_ROWS, QUERY_BLOCK = 8192, 256
SAMPLE, TARGET = 128, 0.96


@functools.lru_cache(maxsize=4)
def directions(size: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((size, TREES * BITS))


def hash_strings(vectors: np.ndarray) -> np.ndarray:
    """TREES columns of BITS-bit strings, the first direction in the highest bit."""
    signs = (vectors @ directions(vectors.shape[1]) > 0).reshape(len(vectors), TREES, BITS)
    return signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, by the same sum for every row, so that equal vectors get equal scores."""
    return (vectors * query).sum(1) / (norms * np.sqrt((query * query).sum()))


class Forest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors * vectors).sum(1))
        strings = hash_strings(vectors)
        self.order = np.argsort(strings, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(strings.T, self.order, 1)
        self.enough = len(ids)
        if len(ids) > 4 * k:
            self.enough = self.fit()

    def ranges(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the prefixes of a string: (TREES, BITS + 1), by prefix length."""
        rest = BITS - np.arange(BITS + 1)
        low = strings[:, None] >> rest << rest
        high = low + (np.int64(1) << rest)
        first = np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, low)])
        return first, np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, high)])

    def ascend(self, strings: np.ndarray, enough: int) -> np.ndarray:
        """Candidates of the first prefix length, from the longest, at which all trees together hold so many."""
        first, last = self.ranges(strings)
        reach = (last - first).sum(0)
        depth = int(np.flatnonzero(reach >= min(enough, len(self.ids)))[-1]) if len(self.ids) else 0
        while True:
            mask = np.zeros(len(self.ids), bool)
            for tree in range(TREES):
                mask[self.order[tree, first[tree, depth] : last[tree, depth]]] = True
            if depth == 0 or int(mask.sum()) >= enough:
                return np.flatnonzero(mask)
            depth -= 1

    def fit(self) -> int:
        """Candidates with which TARGET of the true neighbours of a sample are found."""
        need = []
        sample = np.linspace(0, len(self.ids) - 1, min(SAMPLE, len(self.ids))).astype(int)
        for at in sample:
            score = cosines(self.vectors, self.norms, self.vectors[at])
            score[at] = -2
            true = np.argpartition(-score, self.k)[: self.k]
            first, last = self.ranges(hash_strings(self.vectors[at][None])[0])
            seen = np.zeros(len(self.ids), bool)
            open_ = set(true.tolist())
            for depth in range(BITS, -1, -1):
                for tree in range(TREES):
                    seen[self.order[tree, first[tree, depth] : last[tree, depth]]] = True
                found = {t for t in open_ if seen[t]}
                need += [int(seen.sum())] * len(found)
                open_ -= found
                if not open_:
                    break
        return int(np.quantile(need, TARGET))

    def search(self, query_id: int, query: np.ndarray) -> list[tuple[int, int, float]]:
        found = self.ascend(hash_strings(query[None])[0], self.enough)
        found = found[self.ids[found] != query_id]
        score = cosines(self.vectors[found], self.norms[found], query)
        best = np.lexsort((self.ids[found], -score))[: self.k]
        return [(query_id, int(self.ids[found[i]]), float(score[i])) for i in best]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x != 0)")
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(fine & F.col("id").isNotNull())


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each query's k nearest rows by cosine; both tables have the id and the vector."""
    rows = usable(vectors, id_col, vector_col)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    asked = usable(queries, id_col, vector_col).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = rows.withColumn("shard", shard).withColumn("query", F.lit(0)).unionByName(asked.withColumn("query", F.lit(1)))
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", "query", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forests: dict[int, Forest] = {}
        at, held = None, []
        for b in batches:
            for (number, query), part in b.groupby(["shard", "query"], sort=True):
                if query == 0:
                    if number != at:
                        at, held, forests = number, [], {}
                    held.append(part)
                    continue
                if number != at:
                    at, held, forests = number, [], {}
                if held and not forests:
                    index = pd.concat(held)
                    for size, group in index.groupby(index["v"].map(len)):
                        forests[size] = Forest(group["id"].to_numpy(np.int64), np.stack(group["v"]).astype(float), k)
                found = []
                for query_id, v in zip(part["id"], part["v"]):
                    if len(v) in forests:
                        found += forests[len(v)].search(query_id, np.asarray(v, float))
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = both.mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
