"""Removal of passages that occur elsewhere, by bounded interval expansion on a Burrows-Wheeler transform.

A byte is removed if a string of ``length`` bytes that covers it also starts at another place, in the same or another document, judged on
the input. Comparing whole corpora in one suffix array can't be spread; so the strings are first dealt out by their content:

1. Every window of ``length`` bytes names one anchor, the leftmost of its ``GRAM``-byte grams with the smallest hash. Equal windows name equal anchors
   at the same place, so windows only meet within an anchor's group. Neighbouring windows share an anchor; together with
   the bytes they cover they are the anchor's context.
2. Anchors found once are done: nothing repeats there. If all contexts of an anchor are equal, all their windows repeat.
3. The distinct contexts of the other anchors, about one per edge of a repeated passage, go through the suffix method: suffixes sorted as
   deep as the length needs, their Burrows-Wheeler transform, and breadth-first backward extension of intervals, which derives the common-prefix values in
   increasing order and stops at the length; suffix neighbours without a value share at least that much.
4. An anchor with very many distinct contexts is split: narrower ranges of windows have a core of bytes in common, and its hash deals them
   out anew, down to single windows. So no task gets a group that grows with the corpus, and nothing is left out.

Rows that repeat an id and its text count once in all of these steps, however many they are: such a text repeats from its first to its last byte, which needs no comparison.

Edge cases: a null or empty text has no bytes and loses none; texts shorter than ``length`` lose nothing, equal or not; copies of a document lose all
their bytes if they are long enough; rows that repeat id and text are copies too; a null id is kept as such; other columns are
ignored; an empty table gives no rows. Texts of any length are read whole, in overlapping chunks.

With ``words`` the unit is the word: passages of that many words that occur elsewhere are removed, however few bytes they have. The same steps run over
texts written as ``CODE`` bytes of each word's hash, so a passage of so many words always has the same length. White space between the words
doesn't matter, and goes with the word before it.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import id_and_text
from lakeops.llm.near_dup import WordHashes, grouped, mix
from lakeops.sources.staging import stage

GRAM = 100
#: Bytes of a word's hash; differing passages are taken for equal with a chance of 2^-48 a pair.
CODE = 6
#: Windows that start in one chunk of a long text.
CHUNK = 1 << 18
#: Distinct contexts of an anchor that one suffix problem takes; beyond it the group is split.
GROUP = 512
#: Contexts, about, that are joined for one suffix problem: its arrays take some hundred times the bytes of a context, and a batch of Arrow holds up to 10,000.
PROBLEM = 512
#: Widths, in windows, into which the contexts of a large group are split, one after the other.
WIDTHS = (43, 7, 1)
_U = np.uint64


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    base, n = 0x9E3779B97F4A7C15 | 1, CHUNK + 4096
    inverse = pow(base, -1, 1 << 64)
    run = lambda x: np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(x), _U)]))
    return run(base), run(inverse)


@functools.cache
def byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, 256, dtype=_U)


def anchors(data: bytes, length: int) -> list[tuple[int, int, int, int, int]]:
    """(anchor, first window, last window, hash of the anchor's gram, hash of the context) over all windows of the bytes, at least one."""
    up, down = powers()
    found = []
    for base in range(0, len(data) - length + 1, CHUNK):
        part = np.frombuffer(data, np.uint8)[base : base + CHUNK + length - 1]
        sums = np.concatenate([[_U(0)], np.cumsum(byte_values()[part] * up[: len(part)])])
        n = len(part) - GRAM + 1
        gram = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
        width = length - GRAM + 1
        # smallest of each run of grams, by running minima forwards and backwards within blocks
        place = (gram & ~_U((1 << 20) - 1)) | np.arange(n, dtype=_U)
        padded = np.full(-(-n // width) * width, np.iinfo(_U).max, _U)
        padded[:n] = place
        cells = padded.reshape(-1, width)
        forward = np.minimum.accumulate(cells, 1).ravel()
        backward = np.minimum.accumulate(cells[:, ::-1], 1)[:, ::-1].ravel()
        windows = n - width + 1
        winner = (np.minimum(backward[:windows], forward[width - 1 : width - 1 + windows]) & _U((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, winner[1:] != winner[:-1]])
        last = np.r_[first[1:] - 1, windows - 1]
        for s, e, p in zip(first.tolist(), last.tolist(), winner[first].tolist()):
            context = data[base + s : base + e + length]
            found.append((base + p, base + s, base + e, int(gram[p]), xxhash.xxh3_64_intdigest(context, seed=p - s)))
    return found


def word_codes(text: str, hashes: WordHashes) -> bytes:
    """CODE bytes of the hash of each word of the text."""
    found = np.array([hashes[w] for w in text.encode().split()], "<u8")
    return found.view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()


def word_starts(data: bytes) -> np.ndarray:
    """Whether a word starts at each byte; spaces are those that split() of bytes knows."""
    values = np.frombuffer(data, np.uint8)
    space = (values == 32) | ((values >= 9) & (values <= 13))
    return ~space & np.r_[True, space[:-1]]


def bytes_of_words(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of bytes, up to the next word, of the words that lie wholly in spans (first and behind the last) of their codes."""
    at = np.r_[np.flatnonzero(word_starts(data)), len(data)]
    whole = [(-(-s // CODE), e // CODE) for s, e in spans]
    return [(int(at[s]), int(at[e])) for s, e in whole if s < e]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least ``depth`` symbols of 9 bits, by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, symbols.dtype)]).astype(_U)
    key, reach = np.zeros(n, _U), 7
    for k in range(7):
        key = key << _U(9) | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.r_[True, key[order[1:]] != key[order[:-1]]]
        if reach >= depth or fresh.all():
            return order
        rank = np.empty(n, _U)
        rank[order] = np.cumsum(fresh).astype(_U)
        beyond = np.zeros(n, _U)
        beyond[: max(0, n - reach)] = rank[reach:]
        key, reach = rank << _U(32) | beyond, reach * 2


def repeated_windows(contexts: list[bytes], length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each place of the joined contexts (one separator after each) also start elsewhere among them."""
    size = np.array([len(c) for c in contexts])
    symbols = np.concatenate([x for c in contexts for x in (np.frombuffer(c, np.uint8).astype(np.int16) + 2, [1])] + [[0]]).astype(np.int64)
    n = len(symbols)
    order = suffix_order(symbols, length + 1)
    transform = symbols[order - 1]
    step_back = np.empty(n, np.int64)  # from a suffix to the one that starts a symbol before it
    step_back[np.argsort(transform, kind="stable")] = np.arange(n)
    common = np.full(n + 1, -1)
    common[0] = common[n] = 0
    low, high = np.array([0]), np.array([n])
    for value in range(length):
        if not len(low):
            break
        span = high - low
        owner = np.repeat(np.arange(len(low)), span)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(span) - span, span) + low[owner]
        # within an interval, the places of each symbol step back to one interval, in order
        key = owner * 512 + transform[place]
        by = np.argsort(key, kind="stable")
        key, place = key[by], place[by]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        low, high = step_back[place[edge]], step_back[place[np.r_[edge[1:], len(place)] - 1]] + 1
        new = common[high] < 0
        low, high = low[new], high[new]
        common[high] = value
    same = np.flatnonzero(common[1:n] < 0) + 1
    marked = np.zeros(n, bool)
    marked[order[same]] = marked[order[same - 1]] = True
    # a string that runs over a separator is none
    end = np.cumsum(size + 1)
    inside = np.concatenate([np.arange(s, -1, -1) for s in size] + [[0]]) >= length
    assert end[-1] + 1 == n
    return marked & inside


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def problems(frame: pd.DataFrame, most: int = PROBLEM) -> Iterator[pd.DataFrame]:
    """Parts of a frame sorted by key that hold whole keys and at most ``most`` rows more than a key has."""
    keys = frame["key"].to_numpy()
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    cut = start[np.r_[True, np.diff(start // most) > 0]].tolist()
    for s, e in zip(cut, [*cut[1:], len(frame)]):
        yield frame.iloc[s:e]


def solve(contexts: DataFrame, length: int, widths: tuple[int, ...] = WIDTHS, group: int = GROUP) -> DataFrame:
    """(key, ctx, first, last): windows of distinct contexts (key, ctx, copies, off, data) that repeat; off is the anchor's place in data."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in (part for whole in grouped(batches, ["key"], PROBLEM) for part in problems(whole)):
            data = [bytes(d) for d in frame["data"]]
            flags, at, rows = repeated_windows(data, length), 0, []
            for key, ctx, d in zip(frame["key"], frame["ctx"], data):
                rows += [(key, ctx, a, b) for a, b in runs(flags[at : at + len(d)])]
                at += len(d) + 1
            yield pd.DataFrame(rows, columns=["key", "ctx", "first", "last"])

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = widths[0]
        for b in batches:
            rows = []
            for key, ctx, off, d in zip(b["key"], b["ctx"], b["off"], b["data"]):
                d, windows, s = bytes(d), len(d) - length + 1, 0
                while s < windows:
                    # ranges begin where the distance to the anchor is a multiple of the width
                    stop = min(windows, s + (off - s - 1) % width + 1)
                    reach = s - ((s - off) % width)
                    core = d[reach + width - 1 : reach + length]
                    new = xxhash.xxh3_64_intdigest(core, seed=key % (1 << 32) + (off - reach) * 7919) - (1 << 63)
                    piece = d[s : stop - 1 + length]
                    rows.append((key, ctx, s, new, xxhash.xxh3_64_intdigest(piece, seed=off - s) - (1 << 63), off - s, piece))
                    s = stop
            yield pd.DataFrame(rows, columns=["pkey", "pctx", "start", "key", "ctx", "off", "data"])

    found = "key long, ctx long, first int, last int"
    # written, so that a hot key's rows are split by the join and not tied to the grouping
    sizes = stage(contexts.groupBy("key").agg(F.count("*").alias("n")), "group-sizes")
    if not widths:
        sizes = sizes.withColumn("n", F.lit(0).cast("long"))
    sized = contexts.join(sizes, "key")
    small = sized.where(f"n <= {group}").select("key", "ctx", "data").repartition("key").sortWithinPartitions("key")
    all_of = contexts.where("copies > 1").selectExpr("key", "ctx", "0 AS first", f"octet_length(data) - {length} AS last")
    result = all_of.unionByName(small.mapInPandas(expand, found))
    large = sized.where(f"n > {group}").select("key", "ctx", "off", "data")
    if large.isEmpty():
        return result
    parts = "pkey long, pctx long, start int, key long, ctx long, off int, data binary"
    live, same, distinct = divide(stage(large.mapInPandas(split, parts), "narrow"), "data")
    inner = solve(distinct, length, widths[1:], group)
    back = live.join(inner, ["key", "ctx"]).selectExpr("pkey AS key", "pctx AS ctx", "start + first AS first", "start + last AS last")
    whole = same.selectExpr("pkey AS key", "pctx AS ctx", "start AS first", f"start + octet_length(data) - {length} AS last")
    return result.unionByName(whole).unionByName(back)


def divide(rows: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of keys with unlike contexts, rows of keys whose contexts are all equal, and the distinct contexts of the former; keys found once go."""
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("n > 1")
    # written, so that a hot key's rows are split by the join and not tied to the grouping
    keys = stage(keys.selectExpr("key", "lo < hi AS mixed"), "shared-keys")
    kept = stage(rows.join(keys, "key"), "shared")
    mixed = kept.where("mixed").drop("mixed")
    first = F.first if carried == ("data",) else F.min
    distinct = mixed.groupBy("key", "ctx").agg(F.count("*").alias("copies"), F.min("off").alias("off"), *(first(c).alias(c) for c in carried))
    return mixed, kept.where("NOT mixed").drop("mixed"), stage(distinct, "contexts")


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per did and tag, and the dids and tags of several rows."""
    repeated = docs.groupBy("did", "tag").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stage(repeated.select(F.col("did").alias("_did"), F.col("tag").alias("_tag")), "repeated-rows")
    if repeated.isEmpty():
        return docs, repeated
    marked = docs.join(repeated, (F.col("did") == F.col("_did")) & (F.col("tag") == F.col("_tag")), "left")
    once = marked.where("_did IS NOT NULL").groupBy("did", "tag").agg(F.min("text").alias("text"))
    return marked.where("_did IS NULL").select("did", "tag", "text").unionByName(once.select("did", "tag", "text")), repeated


def repeated_spans(docs: DataFrame, length: int, coded: bool = False) -> DataFrame:
    """(did, tag, spans): first and last of runs of windows that repeat, of the bytes or the coded words; docs has did, tag and text, once each."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            rows = []
            for did, tag, text in zip(b["did"], b["tag"], b["text"]):
                data = word_codes(text, hashes) if coded else text.encode()
                for p, s, e, key, ctx in anchors(data, length):
                    rows.append((did, tag, s, e, p - s, key - (1 << 63), ctx - (1 << 63)))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=["did", "tag", "s", "e", "off", "key", "ctx"])
                    rows = []
            yield pd.DataFrame(rows, columns=["did", "tag", "s", "e", "off", "key", "ctx"])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            rows = []
            for text, spans in zip(b["text"], b["spans"]):
                data = word_codes(text, hashes) if coded else text.encode()
                for x in spans:
                    rows.append((x["key"], x["ctx"], x["copies"], x["off"], data[x["s"] : x["e"] + length]))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["key", "ctx", "copies", "off", "data"])
                    rows = []
            yield pd.DataFrame(rows, columns=["key", "ctx", "copies", "off", "data"])

    schema = "did long, tag long, s int, e int, off int, key long, ctx long"
    # so many words have twice the bytes, but for one
    long = docs.where(F.octet_length("text") >= (length // CODE * 2 - 1 if coded else length))
    found = stage(long.select("did", "tag", "text").mapInPandas(find, schema), "anchors")
    found = found.withColumn("place", F.struct("did", "tag", "s", "e"))
    mixed, same, distinct = divide(found, "place")
    asked = distinct.groupBy("place.did", "place.tag").agg(
        F.collect_list(F.struct("key", "ctx", "copies", "off", F.col("place.s").alias("s"), F.col("place.e").alias("e"))).alias("spans")
    )
    texts = long.select("did", "tag", "text")
    contexts = stage(
        texts.join(asked, ["did", "tag"]).select("text", "spans").mapInPandas(fetch, "key long, ctx long, copies long, off int, data binary"),
        "context-bytes",
    )
    # what a suffix problem and the copies of a context say may be the same
    marks = mixed.join(solve(contexts, length), ["key", "ctx"]).selectExpr("did", "tag", "s + first AS first", "s + last AS last")
    marks = marks.distinct().union(same.select("did", "tag", "s", "e"))
    return marks.groupBy("did", "tag").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first and behind the last), those that meet put together."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [(s, e) for s, e in merged]


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, words: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_text kept_text and text_tag.

    kept_text is decoded as UTF-8 without the parts of characters that a cut may leave; text_tag is the xxhash64 of the input text,
    which with the id leads back to the row.
    """
    if words is not None:
        length = CODE * words
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    docs = id_and_text(docs, id_col, text_col)
    # a row is known by its id and a hash of its text, as ids may repeat or be missing
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"), F.xxhash64("text").alias("tag"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text", "text_tag"] if with_text else [])]

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, tag, text, spans, again in zip(b["doc_id"], b["tag"], b["text"], b["spans"], b["again"]):
                data, kept = text.encode(), []
                if again:  # all its windows
                    size = len(data) if words is None else CODE * len(data.split())
                    merged = [(0, size)] if size >= length else []
                else:
                    merged = united([(x["first"], x["last"] + length) for x in spans] if spans is not None else [])
                if words is not None:
                    merged = bytes_of_words(data, merged)
                at = 0
                for s, e in merged:
                    kept.append(data[at:s])
                    at = e
                left = b"".join([*kept, data[at:]])
                row = (doc, len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest())
                rows.append((*row, left.decode(errors="ignore"), tag) if with_text else row)
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string, text_tag long" if with_text else "")
    once, repeated = collapsed(docs.select("did", "tag", "text"))
    spans = repeated_spans(once, length, words is not None)
    # a row per did and tag: the list of a repeated text, which all its rows would get, is left out
    spans = spans.join(repeated, (F.col("did") == F.col("_did")) & (F.col("tag") == F.col("_tag")), "left_anti").withColumn("again", F.lit(False))
    whole = repeated.select(F.col("_did").alias("did"), F.col("_tag").alias("tag"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.lit(True).alias("again"))
    found = docs.join(spans.unionByName(whole), ["did", "tag"], "left")
    return found.select("doc_id", "tag", "text", "spans", F.coalesce("again", F.lit(False)).alias("again")).mapInPandas(finish, schema)
