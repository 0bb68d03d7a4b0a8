"""Near-duplicate documents by 64-bit SimHash fingerprints, pigeonhole blocks and exact Hamming distances.

1. A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles, repeats included.
2. Equal fingerprints become one node, known by the smallest id that has it, so that thousands of copies cost one row afterwards.
3. The 64 bits are cut into four blocks. Fingerprints that differ in at most three bits agree in one block, and meet in the bucket of that block and value.
4. A bucket beyond ``BUCKET`` members is cut again in the same way: its members agree in the bits so far, so the remaining bits, cut into four
   blocks, must agree in one of those too. Buckets get narrower until they fit. A bucket in which r bits remain has at most 2^r members, as fingerprints
   are distinct, so this ends, whatever the fingerprints are, and no pair is left out.
5. A bucket compares its members by exclusive or and bit count, and returns a forest of the pairs within the distance, never the pairs. The components of
   the forests are the result.

Edge cases: null and empty texts and texts without words have fingerprint zero and are linked like others; with fewer words than a shingle the whole
sequence is one shingle; rows that repeat an id are judged each by its own text; rows without an id join the component of their fingerprint, or of
one that links to it, and component_id is null if nothing there has an id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import id_and_text
from lakeops.llm.components import connected
from lakeops.llm.near_dup import forest, grouped
from lakeops.sources.staging import stage

BITS = 64
#: Members that one task compares with each other.
BUCKET = 2048
#: Shingles hashed at once.
CHUNK = 1 << 16
SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the word shingles: lower-cased A-Z, words between ASCII white space, joined by one space; XXH64."""
    tokens = text.encode().lower().split()  # on bytes, lower() changes A-Z alone and split() knows the six ASCII spaces alone
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    end = np.cumsum(size) - 1
    n = max(1, len(tokens) - words + 1)
    start = np.r_[0, end[:-1] + 1][:n].tolist()
    end = end[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(start[at : at + CHUNK], end[at : at + CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; docs has doc_id and text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fp": fp})

    return docs.mapInPandas(run, "doc_id long, fp long")


# --- pigeonhole blocks ---


def blocks(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """The bits from low to high cut into nearly equal parts, those of one bit at least."""
    cuts = [low + (high - low) * k // parts for k in range(parts + 1)]
    return [(s, e) for s, e in zip(cuts, cuts[1:]) if s < e]


def masks(agreed: int, parts: int) -> list[int]:
    """The agreed bits together with each block of the others."""
    others = [b for b in range(BITS) if not agreed >> b & 1]
    return [agreed | sum(1 << b for b in others[s:e]) for s, e in blocks(0, len(others), parts)]


def signed(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def bucketed(nodes: DataFrame, distance: int, bucket: int) -> Iterator[DataFrame]:
    """Tables of (mask, part, fp) whose buckets (mask, part) fit; every pair of the distinct fp within the distance shares one of them."""
    parts = distance + 1
    rows, live = nodes.select("fp", F.lit(0).cast("long").alias("mask")), [0]
    while True:
        # as many masks as the number of blocks to the power of the level, whatever the data
        choice = F.create_map(*[x for m in live for x in (signed(m), F.array(*map(signed, masks(m, parts))))])
        placed = rows.withColumn("mask", F.explode(choice[F.col("mask")])).withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = placed.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stage(sizes.select("mask", "part", (F.col("n") > bucket).alias("large")), "simhash-buckets")
        met = placed.join(sizes, ["mask", "part"])
        yield met.where("NOT large").drop("large")
        live = [r["mask"] % (1 << BITS) for r in sizes.where("large").select("mask").distinct().collect()]
        if not live:
            return
        rows = stage(met.where("large").select("fp", "mask").distinct(), "simhash-large")


def close_edges(frame: pd.DataFrame, distance: int) -> pd.DataFrame:
    """A forest of the pairs of rows of the same bucket, in order, within the distance."""
    fp = frame["fp"].to_numpy(np.int64)
    keys = frame[["mask", "part"]].to_numpy(np.int64)
    bucket = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    found_x, found_y, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 1
    x = np.arange(len(frame) - 1)
    while len(x := x[x + step < len(frame)]) and len(x := x[bucket[x] == bucket[x + step]]):
        near = x[np.bitwise_count(fp[x] ^ fp[x + step]) <= distance]
        found_x.append(near)
        found_y.append(near + step)
        step += 1
    label = forest(len(frame), np.concatenate(found_x), np.concatenate(found_y))
    away = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": fp[away], "b": fp[label[away]]}).drop_duplicates()


def near_fingerprints(docs: DataFrame, words: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id of the component)."""
    if bucket < 2 ** (distance + 1):
        raise ValueError("a bucket must hold every pattern of as many bits as there are blocks")
    rows = stage(fingerprints(id_and_text(docs, id_col, text_col), words), "fingerprints")
    # nodes are known by their fingerprint; ids come in afterwards, so that rows without an id can link others
    first = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["mask", "part"], 20_000):
            yield close_edges(frame, distance)

    edges = None
    for met in bucketed(first, distance, bucket):
        dealt = met.repartition("mask", "part").sortWithinPartitions("mask", "part")
        found = dealt.mapInPandas(compare, "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
    roots = connected(edges).select(F.col("node").alias("fp"), "root")
    labelled = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    components = labelled.join(least, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(components, "fp", "left").select("doc_id", digits.alias("fingerprint"), "component_id")
