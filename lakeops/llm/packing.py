"""Best-fit packing of token sequences by a configuration linear program.

Tokenization is one pass over the documents: each is turned into ids once, cut into pieces, and only the piece's place, length and
checksum go on. The packing itself is decided on the histogram of piece lengths, which has at most ``capacity`` entries however large the
corpus is:

* A configuration is a multiset of lengths that fits a sequence. The linear program asks for the fewest configurations that cover the histogram.
* Multiplicative weights solve it: every length has a weight that shrinks as it gets covered; a knapsack by dynamic programming prices
  configurations by weight per piece; the lengths with the largest weights each give the best configuration that contains them.
* The fractional solution is rounded so that no length is covered beyond its count, and the rest is packed best-fit decreasing, also on the histogram. The prices also
  bound from below how few sequences are possible.

Pieces are then numbered per length (a count per task, made global by running sums over tasks), and the number says which copy of which
configuration a piece fills. Every slot of a copy gets a piece, so offsets are gapless. No task sees more than its own pieces.

Edge cases: a null or empty text is the end id alone; a document of exactly the capacity is one piece; longer ones are cut from the end, so
that the first piece takes the remainder; repeated rows are packed as often as they occur; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.common import id_and_text
from lakeops.llm.token_align import byte_alphabet
from lakeops.sources.staging import stage

END_ID = 0
#: Lengths up to which a histogram counts as one of few; price within which pieces count as equally good; part of each length that the program may pack
#: where there are many.
FEW, NEAR, SHARE = 64, 0.0005, 0.85
#: The tokenizer's own split into words for texts of SAFE characters, in the terms of the standard library.
_SPLIT = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
_UNSAFE = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\xa9\\xab-\\xb1\\xb4-\\xb8\\xbb\\xbf-\\u0237\\u2010-\\u2027\\u2030-\\u203a]|<\\|")


#: Words that a worker remembers, twice.
REMEMBERED = 600_000
#: The character that stands for each byte in a byte-level vocabulary.
_LETTERS = {b: c for c, b in byte_alphabet().items()}


class UnsafeWord(ValueError):
    """A word of which the split may be another one than the tokenizer's."""


class Words(dict):
    """Ids of words as little-endian bytes; a word is given to the tokenizer's merges when it is first asked for, and remembered."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.merges = tokenizer, tokenizer.model
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if _UNSAFE.search(word):
                raise UnsafeWord(word)
            # the tokenizer's merges without its split, which is known: most of its time goes into places in the text
            found = self.merges.tokenize(word.encode().decode("latin-1").translate(_LETTERS))
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        if len(self) >= REMEMBERED:  # two halves, so that words of every day stay
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


def whole(tokenizer: Tokenizer, text: str) -> bytes:
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(Tokenizer.from_file(path))


def encode(words: Words, text: str) -> bytes:
    """The library's ids as bytes. Merges never cross words, so a text whose split is known is joined from remembered words."""
    try:
        return b"".join(map(words.__getitem__, _SPLIT.findall(text)))
    except UnsafeWord:
        return whole(words.tokenizer, text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and task and nth: the piece is the task's nth of its length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, task, seen = words_of(tokenizer_file), TaskContext.get().partitionId(), Counter()
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = encode(words, text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


# --- the packing of a histogram: all of it is bounded by the capacity ---


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room up to the capacity, any number of each length allowed, and the index of a length to take (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        k = upto[room]
        gain = best[room - lengths[:k]] + values[:k]
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], take[room] = gain[i], i
        else:
            best[room], take[room] = best[room - 1], -1
    return best, take


def solve(counts: dict[int, int], capacity: int) -> tuple[dict[tuple, float], float]:
    """Multiplicative-weights solution of the program: configuration (sorted (length, copies) pairs) -> how often; and a lower bound of its value.

    In each round all lengths should get covered by an equal further part. A length's price is its size, times a weight that falls exponentially in how
    far it is ahead of that. The knapsack prices configurations. Each length that is behind gets a configuration that contains it, of the best price but for ``NEAR``;
    among equally good pieces it takes those that are needed most, so that configurations differ. It is used as often as the length needs it and as no other length
    runs far ahead. Any prices bound the value from below, by all pieces' price over that of the dearest configuration.
    """
    lengths = np.array(sorted(counts))
    n = np.array([counts[int(v)] for v in lengths], float)
    few = len(lengths) <= FEW
    # few lengths leave time for more rounds, and need weights that tell them apart
    rounds, sharp, near = (60, 2.0, 0.0) if few else (8, 0.5, NEAR)
    covered, times, bound = np.zeros(len(lengths)), defaultdict(float), 0.0
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for turn in range(1, rounds + 1):
        target = turn / rounds
        price = lengths / capacity * np.exp(sharp * np.clip(target - covered, -0.5, 0.5))
        best, _ = knapsack(lengths, price, capacity)
        # less what rounding may add to the sums, so that it stays a bound
        bound = max(bound, float((price * n).sum() / best[capacity]) * (1 - 1e-12))
        for i in np.argsort(-(target - covered) * n * lengths if few else -lengths, kind="stable"):
            behind = target - covered[i]
            if behind <= 1e-9:
                continue
            chosen, room = Counter({int(i): 1}), capacity - int(lengths[i])
            while room >= lengths[0]:
                k = upto[room]
                good = np.flatnonzero(best[room - lengths[:k]] + price[:k] >= best[room] - near)
                if not len(good):
                    room -= 1  # the best contents leave room
                    continue
                j = int(good[((target - covered[good]) * n[good]).argmax()])
                chosen[j] += 1
                room -= int(lengths[j])
            at = np.array(sorted(chosen))
            copies = np.array([chosen[int(j)] for j in at], float)
            ahead = np.maximum(target + (2 if few else 1) / rounds - covered[at], 0.2 / rounds)
            step = min(float((ahead * n[at] / copies).min()), behind * n[i] / chosen[int(i)])
            times[tuple((int(lengths[j]), chosen[int(j)]) for j in at)] += step
            covered[at] += step * copies / n[at]
    return times, bound


def rounded(times: dict[tuple, float], counts: Counter, up: bool) -> Counter:
    """Whole copies of the configurations within the counts, which lose what they hold; fuller configurations first.

    Rounded ``up``, configurations that fill a sequence may hold ``SHARE`` of each length's pieces: the rest keeps pieces of all lengths, which best-fit needs to fill its bins.
    """
    found: Counter = Counter()
    may = Counter({v: c - round((1 - SHARE) * c) for v, c in counts.items()}) if up else Counter(counts)
    fill = max((sum(v * k for v, k in c) for c in times), default=0)
    for config in sorted(times, key=lambda c: (-sum(v * k for v, k in c), -times[c], c)):
        if up and sum(v * k for v, k in config) < fill:
            break
        copies = min(int(times[config] + (0.999 if up else 0)), *(may[v] // k for v, k in config))
        if copies > 0:
            found[config] = copies
            for v, k in config:
                may[v] -= k * copies
                counts[v] -= k * copies
    return found


def best_fit(counts: dict[int, int], capacity: int) -> dict[tuple, int]:
    """Best-fit decreasing for groups of bins that hold the same."""
    rooms: dict[int, Counter] = defaultdict(Counter)  # room left -> contents -> bins
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            room = min((r for r, bins in rooms.items() if r >= length and bins), default=capacity)
            if room == capacity:
                bins, config = todo, ()
            else:
                config = next(iter(rooms[room]))
                bins = min(todo, rooms[room][config])
                rooms[room][config] -= bins
                if not rooms[room][config]:
                    del rooms[room][config]
            grown = dict(config)
            if room == capacity:
                # a new bin takes as many of the length as fit, as the next ones would choose it
                each = min(capacity // length, todo)
                bins = todo // each
                grown[length] = each
                todo -= bins * each
                rooms[room - each * length][tuple(sorted(grown.items()))] += bins
                continue
            grown[length] = grown.get(length, 0) + 1
            todo -= bins
            rooms[room - length][tuple(sorted(grown.items()))] += bins
    found: Counter = Counter()
    for bins in rooms.values():
        found.update(bins)
    return dict(found)


def program(counts: dict[int, int], capacity: int, turns: int = 6) -> tuple[Counter, Counter, float]:
    """Configurations from the program alone, the pieces it leaves, and the lower bound.

    With few lengths, of many pieces each, the solution is rounded down, and what that leaves is solved again up to ``turns`` times. With many lengths most configurations
    are used a few times, and are rounded up.
    """
    found: Counter = Counter()
    left, bound = Counter({v: c for v, c in counts.items() if c}), 0.0
    up = len(left) > FEW
    for turn in range(1 if up else turns):
        if not left:
            break
        times, lower = solve(dict(left), capacity)
        bound = lower if turn == 0 else bound
        part = rounded(times, left, up)
        left = +left
        found.update(part)
        if not part:
            break
    return found, left, bound


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Configurations with their number of copies that hold the histogram exactly.

    They come from the program; its last rest, a few pieces of each length, is packed best-fit. Where best-fit for all pieces would need fewer sequences,
    which can happen by rounding, that is taken.
    """
    found, left, _ = program(counts, capacity)
    found.update(best_fit(dict(left), capacity))
    alone = best_fit(counts, capacity)
    return sorted((found if sum(found.values()) <= sum(alone.values()) else alone).items())


def slots(packing: list[tuple[tuple, int]]) -> pd.DataFrame:
    """Per length and configuration: the number of the first piece that goes there, pieces per copy, the first sequence, the offset of the first slot."""
    rows, first, sequence = [], Counter(), 0
    for config, copies in packing:
        offset = 0
        for length, each in config:
            rows.append((length, first[length], each, sequence, offset))
            first[length] += each * copies
            offset += each * length
        sequence += copies
    return pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut_up = stage(pieces(id_and_text(docs, id_col, text_col), tokenizer_file, capacity), "pieces")
    per_task = cut_up.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = stage(per_task.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-bases")
    counts = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    table = slots(plan(counts, capacity))
    key = table["length"].to_numpy(np.int64) * (1 << 45) + table["first"].to_numpy(np.int64)
    each, sequence, offset, first = (table[c].to_numpy(np.int64) for c in ("each", "sequence", "offset", "first"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            nth, length = b.pop("nth").to_numpy(np.int64), b["length"].to_numpy(np.int64)
            at = np.searchsorted(key, length * (1 << 45) + nth, "right") - 1
            inside = nth - first[at]
            yield b.assign(sequence_id=sequence[at] + inside // each[at], offset=offset[at] + inside % each[at] * length)

    numbered = cut_up.join(per_task, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("nth")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInPandas(place, schema)
