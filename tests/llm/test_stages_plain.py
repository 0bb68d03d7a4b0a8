"""The first and the last stage of the pipeline against plain versions on all given documents."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def base_failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    return len(words) < 10 or 100 * len(repeated) > 20 * len(words)


def test_quality_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    left = {r["doc_id"]: r for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()}
    clean = {i for i, r in rows.items() if not base_failed(r["text"])}
    assert set(left) <= clean and all(left[i] == rows[i] for i in left)
    # few labels certify few cutoffs, so most clean documents stay
    assert len(left) > 0.8 * len(clean)


def test_packing_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.packing_stage(spark, docs, SF).collect():
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        held = sorted(pieces[r["doc_id"]], key=lambda p: p["piece"])
        assert sum(p["length"] for p in held) == len(ids) and [p["piece"] for p in held] == list(range(len(held)))
        assert all(p["length"] == 2048 for p in held[1:]) and (len(held) == 1 or len(ids) > 2048)
        for p in held:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
