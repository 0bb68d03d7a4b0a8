"""Language-model scores by prediction by partial matching over bytes.

Training counts every context of ``ORDER`` bytes with the symbol that follows it (a byte or the end of the text; the contexts of the first
bytes are filled up with the end symbol), combined in the tasks and summed by a shuffle; the nodes of the shorter contexts are sums of those. A
text's code length is the sum over its symbols: a symbol seen n(s) times in a context seen n times with d different symbols has the probability
n(s) / (n + d), the escape to the next shorter context d / (n + d) (method C), and the symbols of the longer contexts are excluded
below; after the empty context the symbols left are equally likely. A pretrained trie is fixed while texts are scored, so every
(context, symbol) has one value.

The trie is a table of the cluster that grows with the documents; no task and no driver holds it. What is seen after a context is also
seen after its shorter ones, so an escape needs three numbers a context: its different symbols, their count, and the count those same symbols have one
context further down. Values are therefore joins: nodes with their contexts, and the few symbols never seen in their longest context with the
levels below. The ``HOT_NODES`` most frequent nodes (a bounded table, at every size) are summed in the tasks, the others of each document meet their values
in a join.

The base score is a word-unigram model with add-one counts. The ``HOT_WORDS`` most frequent words (a bounded table) are
summed in the tasks; the other words of each document meet their counts in a join on the word's hash.

Edge cases: a null or empty text is the end symbol and the end token alone; without training texts every symbol is equally likely and the base score is
0; a null id counts as the empty text when documents are dealt into training and held-out ones; repeated rows are trained on and
scored each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import id_and_text
from lakeops.llm.near_dup import WordHashes
from lakeops.sources.staging import stage

ORDER, HOT_NODES, HOT_WORDS = 4, 1 << 20, 100_000
END, SYMBOLS, BITS = 256, 257, 9
#: Symbols that a task looks up at once.
CHUNK = 1 << 21
#: The end token: no word, as words hold no line break.
END_TOKEN = b"\n"


def grams(text: bytes, order: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """For each symbol of the text and its end, the symbol with the ``order`` symbols before it, 9 bits each; or of those from start to stop."""
    n = (len(text) + 1 if stop is None else stop) - start
    s = np.full(n + order, END, np.int64)
    low, high = max(start - order, 0), min(start + n, len(text))
    s[low - start + order : high - start + order] = np.frombuffer(text, np.uint8)[low:high]
    key = np.zeros(n, np.int64)
    for k in range(order + 1):
        key = key << BITS | s[k : k + n]
    return key


class Tally:
    """Counts of 64-bit keys, compacted now and then."""

    def __init__(self, limit: int = 2_000_000) -> None:
        self.parts, self.size, self.limit = [], 0, limit

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.parts.append((keys, np.ones(len(keys), np.int64) if counts is None else counts))
        self.size += len(keys)
        if self.size > self.limit:
            self.compact()
            self.limit = max(self.limit, 2 * self.size)

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (list(zip(*self.parts)) or ((), ())))
        keys, inverse = np.unique(keys, return_inverse=True)
        counts = np.bincount(inverse, counts, len(keys)).astype(np.int64)
        self.parts, self.size = [(keys, counts)], len(keys)
        return keys, counts


def escapes(different: int, excluded: int) -> int:
    """The count given to the escape: the different symbols, none if no other symbol is left."""
    return different if different + excluded < SYMBOLS else 0


def adaptive_score(text: bytes, order: int = ORDER) -> float:
    """log10 of the probability of a text under a trie that starts empty and learns each symbol after coding it."""
    seen: dict[tuple, Counter] = defaultdict(Counter)
    history, total = (END,) * order, 0.0
    for symbol in [*text, END]:
        out: set[int] = set()
        for k in range(order, -1, -1):
            fresh = {s: c for s, c in seen[history[order - k :]].items() if s not in out}
            if not fresh:
                continue
            n = sum(fresh.values()) + escapes(len(fresh), len(out))
            if symbol in fresh:
                total += math.log10(fresh[symbol] / n)
                break
            total += math.log10(len(fresh) / n)
            out |= fresh.keys()
        else:
            total -= math.log10(SYMBOLS - len(out))
        for k in range(order + 1):
            seen[history[order - k :]][symbol] += 1
        history = (*history, symbol)[1:]
    return total


def word_hashes(text: str, hashes: WordHashes) -> np.ndarray:
    return np.array([hashes[t] for t in [*text.encode().lower().split(), END_TOKEN]], np.uint64).view(np.int64)


def train(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """kind (0: word, 1: node of the longest contexts), key, n; docs has text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, nodes, hashes = Tally(), Tally(), WordHashes()
        for b in batches:
            for text in b["text"]:
                words.add(word_hashes(text, hashes))
                code = text.encode()
                for at in range(0, len(code) + 1, CHUNK):
                    nodes.add(grams(code, order, at, min(at + CHUNK, len(code) + 1)))
        for kind, tally in enumerate((words, nodes)):
            keys, counts = tally.compact()
            for at in range(0, len(keys), 200_000):
                yield pd.DataFrame({"kind": kind, "key": keys[at : at + 200_000], "n": counts[at : at + 200_000]})

    parts = docs.select("text").mapInPandas(run, "kind int, key long, n long")
    return stage(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")


def low_bits(key: str, symbols: str) -> Column:
    """The last symbols of a key."""
    return F.expr(f"{key} & (shiftleft(1L, {BITS} * ({symbols})) - 1)")


def trie(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (k, key, n) of all context lengths k, and contexts (k, context, different, total, below).

    ``below`` is the count that the symbols seen after the context have after the context one symbol shorter.
    """
    top = counts.where("kind = 1").select("key", "n", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"))
    nodes = stage(top.groupBy("k", low_bits("key", "k + 1").alias("key")).agg(F.sum("n").alias("n")), "lm-nodes", partition_by="k")
    shorter = nodes.select((F.col("k") + 1).alias("k"), F.col("key").alias("short"), F.col("n").alias("short_n"))
    found = nodes.withColumn("short", low_bits("key", "k")).join(shorter, ["k", "short"], "left")
    contexts = found.groupBy("k", F.shiftright("key", BITS).alias("context")).agg(
        F.count("*").alias("different"), F.sum("n").alias("total"), F.coalesce(F.sum("short_n"), F.lit(0)).alias("below")
    )
    return nodes, stage(contexts, "lm-contexts", partition_by="k")


def node_values(nodes: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """key, n, value: log10 of the probability of each symbol seen in its longest context."""
    seen = contexts.where(F.col("k") == order).select("context", "different", "total")
    escape = F.when(F.col("different") < SYMBOLS, F.col("different")).otherwise(0)
    own = nodes.where(F.col("k") == order).withColumn("context", F.shiftright("key", BITS)).join(seen, "context")
    return stage(own.select("key", "n", F.log10(F.col("n") / (F.col("total") + escape)).alias("value")), "lm-values")


def escaped_values(grams: DataFrame, nodes: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """key, value for distinct keys: log10 of the escapes and of their end, with exclusion, level by level."""
    now = grams.select("key", F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("out_n"), F.lit(None).cast("double").alias("value"))
    for k in range(order, -1, -1):
        node = nodes.where(F.col("k") == k).select(F.col("key").alias("short"), "n")
        seen = contexts.where(F.col("k") == k).drop("k")
        fresh = F.col("different") - F.col("out")
        total = F.col("total") - F.col("out_n") + F.when(F.col("different") < SYMBOLS, fresh).otherwise(0)
        now = (
            now.withColumn("short", low_bits("key", str(k + 1)))
            .withColumn("context", F.shiftright("short", BITS))
            .join(node, "short", "left")
            .join(seen, "context", "left")
            .select(
                "key",
                F.when(fresh > 0, F.col("sum") + F.log10(fresh / total)).otherwise(F.col("sum")).alias("sum"),
                F.coalesce("different", "out").alias("out"),
                F.coalesce("below", "out_n").alias("out_n"),
                F.coalesce("value", F.col("sum") + F.log10(F.col("n") / total)).alias("value"),
            )
        )
    left = F.col("sum") - F.log10(SYMBOLS - F.col("out"))
    return now.select("key", F.coalesce("value", left).alias("value"))


def most_frequent(table: DataFrame, bound: int) -> DataFrame:
    """The rows (key, n) of the largest counts, at most ``bound``: as many whole eighths of a power of two as fit."""
    step = F.floor(F.log2("n") * 8)
    held, least = 0, None
    for at, rows in sorted(table.groupBy(step.alias("at")).count().collect(), reverse=True):
        if (held := held + rows) > bound:
            break
        least = at
    return table.where(F.lit(False) if least is None else step >= least)


def in_memory(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and values of a bounded table."""
    held = table.select("key", "value").toArrow()
    keys, values = held["key"].to_numpy(), held["value"].to_numpy()
    return keys[by := np.argsort(keys)], values[by]


def look_up(keys: np.ndarray, held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is held, and its value or 0."""
    known, values = held
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return hit, np.where(hit, values[at], 0.0)


def node_sums(codes: list[bytes], held: tuple[np.ndarray, np.ndarray], order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Per text the sum of the held values, and the other keys with their times."""
    sums, rest = np.zeros(len(codes)), [[] for _ in codes]

    def flush(parts: list[tuple[int, np.ndarray]]) -> None:
        keys, inverse = np.unique(np.concatenate([g for _, g in parts]), return_inverse=True)
        hit, value = look_up(keys, held)
        text = np.repeat([i for i, _ in parts], [len(g) for _, g in parts])
        np.add(sums, np.bincount(text, value[inverse], len(codes)), out=sums)
        away = ~hit[inverse]
        pairs, times = np.unique(text[away] * len(keys) + inverse[away], return_counts=True)
        of = pairs // len(keys)
        for i in np.unique(of):
            low, high = np.searchsorted(of, [i, i + 1])
            rest[i].append((keys[pairs[low:high] % len(keys)], times[low:high]))

    parts, size = [], 0
    for i, code in enumerate(codes):
        for at in range(0, len(code) + 1, CHUNK):
            parts.append((i, grams(code, order, at, min(at + CHUNK, len(code) + 1))))
            size += len(parts[-1][1])
            if size >= CHUNK:
                flush(parts)
                parts, size = [], 0
    if parts:
        flush(parts)
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    return sums, [tuple(map(np.concatenate, zip(*r))) if r else none for r in rest]


def score_documents(docs: DataFrame, order: int = ORDER, adaptive: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per document.

    Training documents are those whose crc32 of the id as text is not 2 modulo 7. ``adaptive`` scores each text by a trie of its own instead
    of the trained one.
    """
    docs = id_and_text(docs, id_col, text_col)
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    spark = docs.sparkSession
    counts = train(docs.where("NOT held_out"), order)
    words = counts.where("kind = 0").select("key", "n")
    total, different = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    below = math.log10(total + different + 1)
    words = words.withColumn("value", F.log10(F.col("n") + 1.0) - below)
    nodes, contexts = trie(counts, order)
    values = node_values(nodes, contexts, order)
    shared = spark.sparkContext.broadcast((in_memory(most_frequent(words, HOT_WORDS)), in_memory(most_frequent(values, HOT_NODES))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot_words, hot_nodes = shared.value
        hashes, task, number = WordHashes(), TaskContext.get().partitionId() << 40, 0
        for b in batches:
            codes = [t.encode() for t in b["text"]]
            if adaptive:
                sums, far = [adaptive_score(c, order) for c in codes], [([], [])] * len(codes)
            else:
                sums, far = node_sums(codes, hot_nodes, order)
            rows = []
            for text in b["text"]:
                tokens, times = np.unique(word_hashes(text, hashes), return_counts=True)
                hit, value = look_up(tokens, hot_words)
                rows.append((times.sum(), times[hit].sum(), times @ value, tokens[~hit], times[~hit]))
            frame = pd.DataFrame(rows, columns=["n_tokens", "hot_known", "hot_score", "words", "word_times"])
            frame.insert(0, "row", np.arange(task + number, task + number + len(b)))
            frame.insert(1, "doc_id", b["doc_id"].astype("Int64").to_numpy())
            frame.insert(2, "held_out", b["held_out"].to_numpy())
            yield frame.assign(nodes=[k for k, _ in far], node_times=[t for _, t in far], hot_code=sums)
            number += len(b)

    lists = "words array<long>, word_times array<long>, nodes array<long>, node_times array<long>"
    schema = f"row long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_score double, {lists}, hot_code double"
    scored = stage(docs.mapInPandas(run, schema), "lm-scored")

    def asked(kind: int, keys: str, times: str) -> DataFrame:
        pairs = scored.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(times).alias("times"))).alias("e"))
        return pairs.select("row", F.lit(kind).alias("kind"), "e.key", "e.times")

    far = asked(1, "nodes", "node_times")
    direct = stage(far.select("key").distinct().join(values.select("key", "value"), "key", "left"), "lm-asked")
    escaped = escaped_values(direct.where("value IS NULL"), nodes, contexts, order)
    known_values = words.select(F.lit(0).alias("kind"), "key", "value").unionByName(
        direct.where("value IS NOT NULL").unionByName(escaped).select(F.lit(1).alias("kind"), "key", "value")
    )
    part = F.col("times") * F.col("value")
    found = asked(0, "words", "word_times").unionByName(far).join(known_values, ["kind", "key"]).groupBy("row").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("times"))).alias("known"),
        F.sum(F.when(F.col("kind") == 0, part)).alias("part"),
        F.sum(F.when(F.col("kind") == 1, part)).alias("code"),
    )
    known = F.col("hot_known") + F.coalesce("known", F.lit(0))
    # an unknown word has the count 0, so the logarithm of 1 less that of the denominator
    return scored.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("part", F.lit(0.0)) - (F.col("n_tokens") - known) * F.lit(below)).alias("base_score"),
        (F.col("hot_code") + F.coalesce("code", F.lit(0.0))).alias("score"),
    )
