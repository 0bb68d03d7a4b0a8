"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Each task builds the encoder once from the rank file and streams over its documents; there is no shuffle. Long texts are cut before
encoding at safe boundaries, so that the library never gets an unbounded text: the split pattern matches white space only at the
start of a match or in runs of white space, hence a match always ends between a character that is not white space and a white-space character that
follows it, and encoding the parts gives the ids of the whole. Decoding joins the raw bytes of the ids, never text of single tokens, because a
token may hold part of a character.

Edge cases: a null text is empty and has no ids; special-token strings are ordinary text; texts without any safe boundary are
encoded whole; other columns are ignored; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame

from lakeops.llm.common import id_and_text

#: Texts longer than so many characters are cut into parts of about this size.
PART = 1 << 16
_BOUNDARY = re.compile(r"(?<=[0-9A-Za-z.,;:!?])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in order, cut only at safe boundaries, each cut at the first boundary after ``size`` characters."""
    start = 0
    while len(text) - start > size and (cut := _BOUNDARY.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(enc: tiktoken.Encoding, text: str, size: int = PART) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for part in parts(text, size) for i in enc.encode_ordinary(part)]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int), one row per document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(rank_file, pattern)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [encode(enc, t) for t in b["text"]]})

    return id_and_text(docs, id_col, text_col).mapInPandas(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and data (binary), the raw bytes of the ids; null ids decode to no bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(rank_file, pattern)
        for b in batches:
            data = [b"" if ids is None else enc.decode_bytes([int(i) for i in ids]) for ids in b["ids"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "data": data})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes decoded from the ids).

    Encoding and decoding share a task, so the ids (several times the size of the text) never leave it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(rank_file, pattern)
        names = [str(i) for i in range(enc.n_vocab)]
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = encode(enc, text)
                joined = ",".join([names[i] for i in ids]).encode()
                rows.append((doc, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInPandas(run, schema)
