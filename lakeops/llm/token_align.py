"""Alignment of two tokenizers' tokens over the same bytes, and the corpus-wide strength of every pair of ids.

1. Each text is tokenized by A (a ``tokenizers`` file) and B (a ``sentencepiece`` model). Both give the ends of their tokens as byte offsets.
2. The ends of a batch of texts are merged by merge-path partitioning: the merged sequence is cut at equal distances, a binary search along each
   diagonal finds how many ends of A and of B lie before the cut, and every piece, of the same amount of work however long or
   short the texts are, is merged on its own. A piece numbers the groups that it sees, reading one end before its own to know whether its
   first end closes a group; running sums over the pieces stitch groups that reach over a cut.
3. All pairs of an A and a B token of a group are linked. A text's distinct pairs of ids are counted once per text; the counts are summed in the tasks
   before they are shuffled.
4. Counts come back to the texts: the at most ``HOT_PAIRS`` most frequent pairs go to the tasks as a sorted array, the others are joined. A pair
   that is joined is rare, so no key of that join is hot.

Edge cases: a null or empty text, and one whose joined token bytes of A or B differ from a space and the text (such as a text with U+2581), has no
tokens: zeros and no groups; every row counts as a document of its own, also if it repeats another or has no id; very long texts are
read whole; other columns are ignored; an empty table gives no rows.

Texts are tokenized by words that are parted by one space between visible characters, and words seen before are remembered. That gives the ids of the
whole text for byte-level BPE whose split never joins a letter and a later space, and for sentence pieces of which none has its space mark
behind another character; the mark is put before each text, and no other white space is changed. ``Pair`` refuses files for which this doesn't hold.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from lakeops.llm.common import id_and_text
from lakeops.sources.staging import stage

#: Ends that one piece merges, pieces merged at once, characters aligned at once, and links expanded at once.
WORK, SLAB, CHARS, LINKS = 1024, 512, 1 << 20, 1 << 21
#: Pairs whose count goes to all tasks: 24 bytes each, 6 MB.
HOT_PAIRS = 1 << 18
#: Parts of texts whose ids a worker remembers, twice.
REMEMBERED = 150_000
#: Stands for the ids of a part whose bytes they don't lead back to.
UNLIKE = (b"", b"")
#: Bits of an id; both vocabularies are smaller.
ID_BITS = 20
_LOW = (1 << ID_BITS) - 1
#: A single space between characters that are no white space to either tokenizer.
_SAFE_BREAK = re.compile("(?<=[!-~\u00a1-\u167f]) (?=[!-~\u00a1-\u167f])")


# --- the two tokenizers ---


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their ids, and the decimal ids with the sign that precedes them in the written groups."""

    def __init__(self, a_file: str, b_file: str) -> None:
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        marks = [i for i in range(self.b.get_piece_size()) if re.search("[^▁]▁", self.b.id_to_piece(i))]
        if marks or self.a.normalizer is not None or not isinstance(self.a.pre_tokenizer, ByteLevel):
            raise ValueError("words of these tokenizers can't be taken apart at single spaces")
        alphabet = byte_alphabet()
        self.a_bytes = [self._entry(self.a.id_to_token(i) or "", alphabet) for i in range(self.a.get_vocab_size())]
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        ids = [[str(i) for i in range(len(t))] for t in (self.a_bytes, self.b_bytes)]
        self.recent: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.written = [sign + i for sign, names in ((",", ids[0]), (";", ids[0]), (",", ids[1]), ("|", ids[1])) for i in names]

    @staticmethod
    def _entry(entry: str, alphabet: dict[str, int]) -> bytes:
        return bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both for every text as integers of four bytes; of none if the bytes of any part don't lead back to the text."""
        a, b = [], []
        for text in texts:
            parts = parts_of(text) if text else []
            ids = list(map(self.recent.get, parts))
            if None in ids:
                self.learn({p for p, known in zip(parts, ids) if known is None})
                ids = list(map(self.recent.__getitem__, parts))
            whole = UNLIKE not in ids
            a.append(b"".join([x for x, _ in ids]) if whole else b"")
            b.append(b"".join([y for _, y in ids]) if whole else b"")
            if len(self.recent) > REMEMBERED:
                # two halves, so that words of every day stay when rare ones fill the memory
                self.recent, self.older = {}, {p: found for p, found in self.recent.items() if len(p) <= 32}
        return a, b

    def learn(self, parts: set[str]) -> None:
        """Remember the ids of parts, which both tokenizers take to begin with a space; UNLIKE where their bytes are others."""
        new = []
        for part in parts:
            known = self.older.get(part)
            if known is None:
                new.append(part)
            else:
                self.recent[part] = known
        together = " ".join(new)
        if new and not (parts_of(together) == new and self.learn_joined(new, together)):
            for part in new:
                if not self.learn_joined([part], part):
                    self.recent[part] = UNLIKE

    def learn_joined(self, parts: list[str], text: str) -> bool:
        """Remember the ids of parts from those of the text they make together; whether its bytes lead back to it."""
        data = (" " + text).encode()
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        found = []
        for ids, names, sizes in (
            (self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.a_bytes, self.a_size),
            (self.b.encode(text, num_threads=1), self.b_bytes, self.b_size),
        ):
            if b"".join(map(names.__getitem__, ids)) != data:
                return False
            token = np.array(ids, np.uint32)
            behind = np.cumsum(sizes[token])
            at = np.searchsorted(behind, ends)
            assert (behind[at] == ends).all(), "a token reaches over a space between visible characters"
            cuts, held = [0, *(4 * (at + 1)).tolist()], token.tobytes()
            found.append([held[s:e] for s, e in zip(cuts, cuts[1:])])
        self.recent.update(zip(parts, zip(*found)))
        return True


def parts_of(text: str) -> list[str]:
    """The words of the text, as far as one space between two visible characters parts them: neither tokenizer joins anything across such a space."""
    return _SAFE_BREAK.split(text)


@functools.lru_cache(maxsize=1)
def pair_of(a_file: str, b_file: str) -> Pair:
    return Pair(a_file, b_file)


# --- merge path ---


def before_diagonals(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d merged ends are A's, for each diagonal d; of equal ends A's comes first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        earlier = np.zeros(len(low), bool)
        earlier[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & earlier, middle + 1, low), np.where(open_ & ~earlier, middle, high)
    return low


def groups_of(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token, numbered from 0, given their increasing ends; the last ends are equal."""
    n = len(a) + len(b)
    cuts = np.minimum(np.arange(0, n + work, work), n)
    cuts = cuts[: np.searchsorted(cuts, n) + 1]
    from_a = before_diagonals(a, b, cuts)
    from_b = cuts - from_a
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    closed = 0
    for at in range(0, len(cuts) - 1, SLAB):
        upto = min(at + SLAB, len(cuts) - 1)
        ia, ib = from_a[at:upto, None], from_b[at:upto, None]
        n_a = from_a[at + 1 : upto + 1, None] - ia
        size = (cuts[at + 1 : upto + 1] - cuts[at:upto])[:, None]
        column = np.arange(int(size.max()))[None, :]
        is_a, is_b = column < n_a, (column >= n_a) & (column < size)
        merged = np.full(is_a.shape, np.iinfo(np.int64).max)
        merged[is_a] = 2 * a[(ia + column)[is_a]]
        merged[is_b] = 2 * b[(ib + column - n_a)[is_b]] + 1
        merged.sort(axis=1)  # each piece alone
        held = column < size
        side = (merged & 1).astype(bool) & held
        first = held & ~side
        seen_a = ia + np.cumsum(first, axis=1)  # A ends up to each place
        closes = side & (seen_a > 0)
        closes[closes] = a[seen_a[closes] - 1] == merged[closes] >> 1
        total = closes.sum(axis=1)
        group = np.cumsum(closes, axis=1) - closes + (closed + np.cumsum(total) - total)[:, None]
        of_a[from_a[at] : from_a[upto]] = group[first]
        of_b[from_b[at] : from_b[upto]] = group[side]
        closed += int(total.sum())
    return of_a, of_b


def counted(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and how often each occurs."""
    if times is None:
        return np.unique(codes, return_counts=True)
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    start = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[start], np.add.reduceat(times, start) if len(codes) else times


def linked(a_key: np.ndarray, of_a: np.ndarray, b_ids: np.ndarray, of_b: np.ndarray, large: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, A id, B id) codes of all links and how many links each has; ``a_key`` holds text and A id."""
    n_groups = int(of_a[-1]) + 1 if len(of_a) else 0
    n_a, n_b = np.bincount(of_a, minlength=n_groups), np.bincount(of_b, minlength=n_groups)
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    parts = []
    wide = n_a * n_b > large
    for g in np.flatnonzero(wide):  # distinct ids first: a long group repeats few
        x, cx = np.unique(a_key[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
        y, cy = np.unique(b_ids[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
        parts.append(((x[:, None] << ID_BITS | y).ravel(), (cx[:, None] * cy).ravel()))
    mine = np.where(wide[of_a], 0, n_b[of_a])
    upto = np.cumsum(mine)
    at = 0
    while at < len(mine):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, "right")))
        reps = mine[at:end]
        token = np.repeat(np.arange(at, end), reps)
        within = np.arange(len(token)) - np.repeat(np.cumsum(reps) - reps, reps)
        parts.append(counted(a_key[token] << ID_BITS | b_ids[start_b[of_a[token]] + within]))
        at = end
    if len(parts) == 1:
        return parts[0]
    return counted(*(np.concatenate(x) for x in zip(*parts))) if parts else (a_key[:0], a_key[:0])


def written_groups(pair: Pair, a_ids: np.ndarray, of_a: np.ndarray, b_ids: np.ndarray, of_b: np.ndarray, ends: np.ndarray) -> Iterator[str]:
    """Per text ``a1,a2|b1;a3|b2,b3``; ``ends`` are the numbers of A and B tokens together up to the end of each text."""
    n_groups = int(of_a[-1]) + 1 if len(of_a) else 0
    upto_a = np.cumsum(np.bincount(of_a, minlength=n_groups))
    upto_b = np.cumsum(np.bincount(of_b, minlength=n_groups))
    new_a, new_b = (np.r_[True, x[1:] != x[:-1]] if len(x) else np.empty(0, bool) for x in (of_a, of_b))
    sign = np.empty(len(a_ids) + len(b_ids), np.int64)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
    sign[np.arange(len(a_ids)) + np.r_[0, upto_b][of_a]] = a_ids + n_a * new_a
    sign[np.arange(len(b_ids)) + upto_a[of_b]] = 2 * n_a + b_ids + n_b * new_b
    signs, at = sign.tolist(), 0
    for end in ends.tolist():
        yield "".join(map(pair.written.__getitem__, signs[at:end]))[1:]
        at = end


# --- the tables ---

_TEXTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, {groups} string, a array<int>, b array<int>, times array<long>"


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values, kind))


def aligned(pair: Pair, texts: list[str], with_groups: bool) -> list[pa.Array]:
    """The columns after doc_id for a few texts."""
    a, b = pair.encode(texts)
    n_a, n_b = (np.array([len(x) // 4 for x in side], np.int64) for side in (a, b))
    a_ids, b_ids = (np.frombuffer(b"".join(side), np.uint32).astype(np.int64) for side in (a, b))
    # the sizes of a text's tokens add up to the same on both sides, so ends count on from text to text
    of_a, of_b = groups_of(np.cumsum(pair.a_size[a_ids]), np.cumsum(pair.b_size[b_ids])) if len(a_ids) else (a_ids, b_ids)
    text_of = np.repeat(np.arange(len(texts)), n_a)
    codes, times = linked(text_of << ID_BITS | a_ids, of_a, b_ids, of_b)
    upto = np.searchsorted(codes, np.arange(1, len(texts) + 1) << 2 * ID_BITS)
    n_links = np.diff(np.r_[0, np.cumsum(times)][np.r_[0, upto]])
    n_groups = np.diff(np.r_[0, np.r_[0, of_a + 1][np.cumsum(n_a)]])
    groups = list(written_groups(pair, a_ids, of_a, b_ids, of_b, np.cumsum(n_a + n_b)))
    if not with_groups:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    return [
        *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)),
        pa.array(groups, pa.string()),
        lists(codes >> ID_BITS & _LOW, upto, pa.int32()),
        lists(codes & _LOW, upto, pa.int32()),
        lists(times, upto, pa.int64()),
    ]


def token_links(docs: DataFrame, a_file: str, b_file: str, groups: str) -> DataFrame:
    """Per row: its counts, its groups or their hash, and its distinct pairs of ids with their links; docs has doc_id and text."""
    names = [x.strip().split(" ")[0] for x in _TEXTS.format(groups=groups).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a_file, b_file)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            size = np.cumsum([len(t) for t in texts])
            at = 0
            while at < len(texts):
                # few texts at once: their tokens are what takes memory
                end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHARS, "right")))
                found = aligned(pair, texts[at:end], groups == "groups")
                yield pa.RecordBatch.from_arrays([ids.slice(at, end - at).cast(pa.int64()), *found], names)
                at = end

    return docs.mapInArrow(run, _TEXTS.format(groups=groups))


def pair_codes(batch: pa.RecordBatch) -> np.ndarray:
    a, b = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b"))
    return a << ID_BITS | b


def document_counts(links: DataFrame) -> DataFrame:
    """(a, b, n, best): the documents that hold a pair linked, and whether no pair of its A id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.empty(0, np.int64), np.empty(0, np.int64)
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(codes >> ID_BITS, pa.int32()), pa.array(codes & _LOW, pa.int32()), pa.array(n)], ["a", "b", "n"])
        for batch in batches:
            new, times = counted(pair_codes(batch))
            codes, n = counted(np.concatenate([codes, new]), np.concatenate([n, times]))
            if len(codes) > 1_000_000:
                yield emit()
                codes, n = codes[:0], n[:0]
        yield emit()

    summed = links.select("a", "b").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    summed = stage(summed, "pair-counts")
    # a row per pair of ids, so an A id has no more rows than B has ids
    most = summed.groupBy(F.col("a").alias("_a")).agg(F.max("n").alias("_most"))
    return stage(summed.join(most, F.col("a") == F.col("_a")).select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best")), "pair-strengths")


def least_hot(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` pairs have it or more; found on a histogram of a few hundred steps."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, (1 << 62)
    for row in rows:
        total += row["pairs"]
        if total > most:
            break
        least = row["least"]
    return least


def align(
    docs: DataFrame, a_file: str, b_file: str, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, or with_groups the groups themselves.

    n_best are the links whose pair is found in as many documents as any pair of its A id; count_sum adds up the documents of the links' pairs.
    """
    groups = "groups" if with_groups else "groups_sha256"
    rows = token_links(id_and_text(docs, id_col, text_col), a_file, b_file, groups)
    # written once: tokenizing costs most, and the number of a row must not change
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "token-links")
    counts = document_counts(rows)
    least = least_hot(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toPandas()  # at most ``hot_pairs`` rows
    code = hot["a"].to_numpy(np.int64) << ID_BITS | hot["b"].to_numpy(np.int64)
    order = np.argsort(code)
    code, n, best = code[order], hot["n"].to_numpy(np.int64)[order], hot["best"].to_numpy(bool)[order]
    known = docs.sparkSession.sparkContext.broadcast((code, n, best))
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", groups]

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = known.value
        for batch in batches:
            asked = pair_codes(batch)
            times = batch.column("times").flatten().to_numpy()
            size = batch.column("a").value_lengths().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(code, asked), max(len(code) - 1, 0))
            found = code[at] == asked if len(code) else np.zeros(len(asked), bool)
            sums = []
            for value in (np.where(found, n[at] * times, 0), np.where(found & best[at], times, 0)) if len(code) else (0 * times, 0 * times):
                upto = np.r_[0, np.cumsum(value)][np.r_[0, np.cumsum(size)]]
                sums.append(pa.array(np.diff(upto), pa.int64()))
            open_ = np.r_[0, np.cumsum(~found)][np.cumsum(size)]
            rest = [lists(x[~found], open_, t) for x, t in ((asked >> ID_BITS, pa.int32()), (asked & _LOW, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums, *rest], [*kept, "count_sum", "n_best", "a", "b", "times"])

    fields = f"row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, {groups} string, count_sum long, n_best long, a array<int>, b array<int>, times array<long>"
    resolved = rows.mapInArrow(resolve, fields)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups]
    cold = counts.where(F.col("n") < least)
    if cold.isEmpty():
        return resolved.select(*names)
    resolved = stage(resolved, "resolved-links")
    rest = resolved.where(F.size("a") > 0).select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("x")).select("row", "x.*")
    added = rest.join(cold, ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best")
    )
    both = resolved.drop("a", "b", "times").join(added, "row", "left")
    return both.withColumns(
        {"count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0))}
    ).select(*names)
