"""Removed repeats of all given documents against hashes of every window."""

import hashlib

import numpy as np

from lakeops.llm import suffix_dedup

SF = "/root/testdata/sf0.01"


def windows(data, length, base):
    """A hash of every window, modulo 2^64."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    run = lambda x: np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(values), x, np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * run(base)[: len(values)])])
    return (sums[length:] - sums[:-length]) * run(pow(base, -1, 1 << 64))[:n]


def plain(texts, length=400):
    data = {i: (t or "").encode() for i, t in texts.items()}
    hashes = {i: windows(d, length, 6364136223846793005) ^ (windows(d, length, 0x9E3779B97F4A7C15) << np.uint64(1)) for i, d in data.items()}
    values, counts = np.unique(np.concatenate(list(hashes.values())), return_counts=True)
    repeated = values[counts > 1]
    for i, d in data.items():
        at = np.flatnonzero(np.isin(hashes[i], repeated))
        change = np.zeros(len(d) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        covered = np.cumsum(change[:-1]) > 0
        kept = np.frombuffer(d, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.r_[0, covered.astype(np.int8)]) == 1).sum())
        yield i, len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = sorted(tuple(r) for r in suffix_dedup.remove_repeats(docs).collect())
    assert found == sorted(plain(texts)) and sum(r[2] for r in found) > 0
