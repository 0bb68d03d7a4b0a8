"""Near-duplicate documents by min-max hashing, exact links, and connected components.

1. A document's set holds the hashes of its distinct word shingles. Each of 70 permutations gives the smallest and the largest hash of the set,
   140 unbiased signature values for 70 evaluations; consecutive minima, and consecutive maxima, form the bands.
2. Documents with equal sets collapse into one class, so that thousands of copies cost one row afterwards.
3. Classes that share a band meet in a bucket. Signatures are compared, for a forest of the plausible pairs (agreement no more than
   five standard deviations below the threshold), never the pairs. The forests' components are the clusters: every link lies within one.
4. Full sets of a cluster meet in the same way. All intersections of a block are a matrix product, for a forest of the pairs with
   100 * intersection >= percent * union, in integers. The forests' components are the result.

A bucket or cluster beyond a block first meets its representative, its smallest node. Members that are alike to it are in one component already, so only the
others still have to meet all members, in blocks. Many copies with small edits thus cost a row each, not a row per pair of blocks.

The number of rows per band is the largest that misses a pair exactly at the threshold with a chance below ``MISS``; for 85 percent that
is 28 bands of 5, for 80 percent 35 bands of 4.

Edge cases: null or empty texts and texts without words have an empty set and are linked with nothing; with fewer words than a shingle the
whole sequence is one shingle; rows that repeat an id count as one document if their texts are equal, otherwise each row joins the
component of its text; rows without an id join the component of an equal text that has an id, otherwise their component_id is null and
they are kept; ties go to the smallest id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import id_and_text
from lakeops.llm.components import connected
from lakeops.sources.staging import stage

PERMUTATIONS = 70
MISS = 1e-6
#: Members of a block of signatures and of a block of sets: what a task compares at once.
SIGNATURE_BLOCK, SET_BLOCK = 512, 96
_U = np.uint64


def rows_per_band(percent: int) -> int:
    share = percent / 100
    fits = [r for r in range(1, 11) if (1 - share**r) ** (2 * (PERMUTATIONS // r)) <= MISS]
    return max(fits, default=1)


class WordHashes(dict):
    """Hash of a word, remembered; emptied when it holds a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@functools.cache
def constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    odd = lambda n: random.integers(0, 2**63, n, dtype=_U) * _U(2) + _U(1)
    return odd(PERMUTATIONS), odd(PERMUTATIONS), odd(64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the lower-cased (A-Z) words."""
    tokens = text.encode().lower().split()  # on bytes, lower() changes A-Z alone and split() knows the six ASCII spaces alone
    if not tokens:
        return np.empty(0, _U)
    h = np.array([hashes[t] for t in tokens], _U)
    odd = constants()[2]
    if len(h) < words:
        return mix((h * odd[: len(h)]).sum(keepdims=True) + _U(len(h)))
    parts = [h[i : len(h) - words + 1 + i] * odd[i] for i in range(words)]
    return np.unique(mix(functools.reduce(np.add, parts) + _U(words)))


def bands(shingles: np.ndarray, rows: int) -> tuple[np.ndarray, bytes]:
    """A signed 64-bit key per band, equal for two documents if all its signature values are; and a byte of each value."""
    if not len(shingles):
        return np.empty(0, np.int64), b""
    scale, shift, odd = constants()
    low = high = None
    for at in range(0, len(shingles), 2048):
        values = shingles[at : at + 2048, None] * scale + shift
        least, most = values.min(0), values.max(0)
        low = least if low is None else np.minimum(low, least)
        high = most if high is None else np.maximum(high, most)
    n = PERMUTATIONS // rows
    grouped = np.concatenate([x[: n * rows].reshape(n, rows) for x in (low, high)])
    keys = mix((grouped * odd[:rows]).sum(1) + np.arange(2 * n, dtype=_U)).view(np.int64)
    return keys, (mix(np.concatenate([low, high])) >> _U(56)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, words: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set), bands, sig; docs has doc_id and text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            sets = [shingle_set(t, words, hashes) for t in b["text"]]
            signed = [bands(s, rows) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "n_shingles": [len(s) for s in sets],
                    "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "bands": [k for k, _ in signed],
                    "sig": [v for _, v in signed],
                }
            )

    return docs.mapInPandas(run, "doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary")


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of n members under the links x-y."""
    label = np.arange(n)
    while len(x):
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if (label[x] == label[y]).all():
            break
    return label


def edges_of(node: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    away = label != np.arange(len(label))
    return pd.DataFrame({"a": node[away], "b": node[label[away]]})


def plausible_edges(frame: pd.DataFrame, agree: int) -> pd.DataFrame:
    """A forest of the pairs of rows with equal (band, i, j) whose signatures agree in so many bytes; rows are sorted by that key."""
    node = frame["node"].to_numpy(np.int64)
    sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(len(frame), -1)
    keys = frame[["band", "i", "j"]].to_numpy(np.int64)
    start = np.r_[True, (keys[1:] != keys[:-1]).any(1)]
    group = np.cumsum(start)
    found_x, found_y, step = [], [], 1
    x = np.arange(len(frame) - 1)
    while len(x := x[x + step < len(frame)]) and len(x := x[group[x] == group[x + step]]):
        for part in np.array_split(x, -(-len(x) // 65536)):
            same = (sig[part] == sig[part + step]).sum(1, dtype=np.int16) >= agree
            found_x.append(part[same])
            found_y.append(part[same] + step)
        step += 1
    if not found_x:
        return pd.DataFrame({"a": node[:0], "b": node[:0]})
    return edges_of(node, forest(len(frame), np.concatenate(found_x), np.concatenate(found_y))).drop_duplicates()


def linked_edges(node: np.ndarray, sets: list[np.ndarray], percent: int) -> pd.DataFrame:
    """A forest of the pairs of sets that are as similar as asked for."""
    size = np.array([len(s) for s in sets])
    k = len(sets)
    if k == 2:
        common = np.array([[size[0], c := len(np.intersect1d(*sets, assume_unique=True))], [c, size[1]]])
    else:
        value, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(k), size)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((k, k))
        for at in range(0, len(value), 8192):
            low, high = np.searchsorted(column, [at, at + 8192])
            held = np.zeros((k, min(8192, len(value) - at)), np.float32)
            held[row[low:high], column[low:high] - at] = 1
            common += held @ held.T
        common = common.astype(np.int64)
    union = size[:, None] + size - common
    x, y = np.nonzero(np.triu(100 * common >= percent * union, 1))
    return edges_of(node, forest(k, x, y))


def blocked(rows: DataFrame, key: str, nodes: str, block: int) -> DataFrame:
    """Rows with (i, j) added: the members of a key, dealt into blocks by hash, go to every pair of blocks that holds theirs."""
    # the count combines before the shuffle, and only keys beyond a block are joined: no task has to order or number a whole key
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    sizes = sizes.select(F.col(key).alias("_large"), F.ceil(F.col("_n") / block).cast("int").alias("_n"))
    placed = rows.join(sizes, F.col(key) == F.col("_large"), "left").withColumn("_blocks", F.coalesce("_n", F.lit(1)))
    return (
        placed.withColumn("_at", F.pmod(F.xxhash64(nodes), "_blocks").cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"i": F.least("_at", "_other"), "j": F.greatest("_at", "_other")})
        .drop("_at", "_other", "_blocks", "_large", "_n")
    )


def met(rows: DataFrame, key: str, payload: str, block: int, alike: Callable[[pd.DataFrame], np.ndarray]) -> tuple[DataFrame, DataFrame | None]:
    """Rows (key, node, payload) dealt into groups (key, i, j), and edges to representatives, which together hold all links within a key.

    ``alike`` tells for a frame with ``mine`` and ``other`` payloads which rows are linked.
    """
    sizes = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), F.min("node").alias("_rep")).where(F.col("_n") > block)
    sizes = stage(sizes, "large-keys")
    one = {"i": F.lit(0).cast("long"), "j": F.lit(0).cast("long")}
    names = [key, "node", payload, "i", "j"]
    small = rows.join(sizes, F.col(key) == F.col("_key"), "left_anti").withColumns(one).select(*names)
    if sizes.isEmpty():
        return small, None

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"_key": b["_key"], "node": b["node"], "_rep": b["_rep"], "near": alike(b) if len(b) else np.empty(0, bool)})

    members = rows.join(sizes, F.col(key) == F.col("_key"))
    first = members.where("node = _rep").groupBy(F.col("_key").alias("_of")).agg(F.min(payload).alias("other"))
    both = members.join(stage(first, "representatives"), F.col("_key") == F.col("_of")).select("_key", "node", "_rep", F.col(payload).alias("mine"), "other")
    judged = stage(both.mapInPandas(judge, "_key long, node long, _rep long, near boolean"), "near-representatives")
    edges = judged.where("near AND node <> _rep").select(F.col("node").alias("a"), F.col("_rep").alias("b"))
    others = judged.where("NOT near").select(F.col("_key").alias("_of"), F.col("node").alias("_other"))
    left = others.groupBy("_of").agg(F.count("*").alias("_left")).join(sizes, F.col("_of") == F.col("_key"))
    left = stage(left.select("_of", "_left", "_n"), "left-over")
    if left.isEmpty():
        return small, edges
    # where most are left, all pairs of blocks are fewer rows than those of the left with all
    most = blocked(rows.join(left.where("2 * _left > _n").select("_of"), F.col(key) == F.col("_of"), "left_semi"), key, "node", block)
    few = left.where("2 * _left <= _n").select("_of", F.ceil(F.col("_left") / block).alias("_i"), F.ceil(F.col("_n") / block).alias("_j"))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    met_by = rows.join(few, F.col(key) == F.col("_of"))
    asking = rows.join(others, (F.col(key) == F.col("_of")) & (F.col("node") == F.col("_other"))).select(*rows.columns).join(few, F.col(key) == F.col("_of"))
    pairs = met_by.withColumn("i", spread("_i")).withColumn("j", place("_j")).select(*names).unionByName(
        asking.withColumn("i", place("_i")).withColumn("j", spread("_j")).select(*names)
    )
    return small.unionByName(most.select(*names[:3], *(F.col(c).cast("long").alias(c) for c in "ij"))).unionByName(pairs), edges


def grouped(batches: Iterator[pd.DataFrame], keys: list[str], at_least: int) -> Iterator[pd.DataFrame]:
    """Frames that hold whole groups of a sorted stream of frames, of about ``at_least`` rows."""
    held: list[pd.DataFrame] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) < at_least:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        whole = len(frame) - int(last.sum())
        if whole:
            yield frame.iloc[:whole].reset_index(drop=True)
        held = [frame.iloc[whole:]]
    if held and len(frame := pd.concat(held, ignore_index=True)):
        yield frame


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id of the component), kept (doc_id is that id)."""
    docs = id_and_text(docs, id_col, text_col)
    signed = stage(signatures(docs, words, rows_per_band(percent)), "signatures")
    classes = stage(
        signed.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"), "classes"
    )
    keyed = signed.withColumnRenamed("doc_id", "node").join(classes, ["node", "set_key"], "left_semi").dropDuplicates(["node", "set_key"])
    rows = keyed.select("node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("band")
    # signatures join only the rows whose band is shared, a small part of all
    bucketed = stage(rows.join(shared, "band", "left_semi").join(keyed.select("node", "sig"), "node").select("band", "node", "sig"), "buckets")
    share = percent / 100
    agree = int(2 * PERMUTATIONS * share - 5.2 * (2 * PERMUTATIONS * share * (1 - share)) ** 0.5)

    def same_signature(b: pd.DataFrame) -> np.ndarray:
        mine, other = (np.frombuffer(b"".join(b[c]), np.uint8).reshape(len(b), -1) for c in ("mine", "other"))
        return (mine == other).sum(1) >= agree

    def same_set(b: pd.DataFrame) -> np.ndarray:
        found = []
        for x, y in zip(b["mine"], b["other"]):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * common >= percent * (len(x) + len(y) - common))
        return np.array(found, bool)

    def links(rows: DataFrame, key: str, payload: str, block: int, alike: Callable, compare: Callable) -> DataFrame:
        groups, edges = met(rows, key, payload, block, alike)
        found = groups.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j").mapInPandas(compare, "a long, b long")
        return found if edges is None else found.unionByName(edges)

    def plausible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["band", "i", "j"], 20_000):
            yield plausible_edges(frame, agree)

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["cluster", "i", "j"], 500):
            for _, group in frame.groupby(["cluster", "i", "j"], sort=False):
                group = group.drop_duplicates(["node", "members"])
                sets = [np.frombuffer(t, _U) for t in group["members"]]
                yield linked_edges(group["node"].to_numpy(np.int64), sets, percent)

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            sets = [shingle_set(t, words, hashes).tobytes() for t in b["text"]]
            yield pd.DataFrame({"node": b["node"], "cluster": b["cluster"], "members": sets})

    clusters = connected(links(bucketed, "band", "sig", SIGNATURE_BLOCK, same_signature, plausible))
    clusters = clusters.union(clusters.select("root", "root").distinct()).toDF("node", "cluster")
    # the members grow with the documents, so they are merged and never broadcast, at any size
    texts = docs.join(clusters.hint("merge"), docs["doc_id"] == clusters["node"]).select("node", "cluster", "text")
    members = stage(texts.mapInPandas(sets_of, "node long, cluster long, members binary").dropDuplicates(["node", "members"]), "sets")
    roots = connected(links(members, "cluster", "members", SET_BLOCK, same_set, linked))
    components = classes.join(roots, "node", "left").select("set_key", F.coalesce("root", "node").alias("root"))
    return signed.select("doc_id", "n_shingles", "set_key").join(components, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("root", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("root", "doc_id")).alias("kept"),
    )
