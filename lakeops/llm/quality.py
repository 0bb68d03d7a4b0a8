"""Quality rules with risk-controlled thresholds, in DataFrame and SQL functions only.

Fixed heuristics reject a document at once (``base_failed``). Beyond them each rule of ``RULES`` compares a share
with a cutoff, and the cutoff is chosen per stratum from labelled documents under a guarantee: the chance that the rule
rejects more than its part of ``max_false`` of the good documents of the stratum is at most ``delta``, over all strata
and rules together.

How: the grid of cutoffs is fixed beforehand, so every labelled document is a holdout. For a cutoff that rejects k of n good
documents, the exact binomial tail P(Bin(n, a) <= k) is the p-value of "rejects more than a". k grows along the grid, so
testing cutoffs from lenient to strict until the first failure (fixed-sequence testing) needs no correction within a grid;
Bonferroni divides ``delta`` among strata and rules, and the union bound divides ``max_false`` among the rules. Among certified
cutoffs the one with the best balance of bad against good rejections is taken, the most lenient at a tie. A stratum with too few labels
certifies nothing, and none of its documents is rejected beyond the fixed heuristics.

Edge cases: null text counts as no words and fails the base rule; a null stratum is a stratum of its own; a document labelled
more than once counts as bad if one label says so; null labels and labels of unknown documents are ignored; without labels or with an
empty table nothing is certified; other columns pass untouched or are ignored; repeated rows are judged alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import SPACE
from lakeops.sources.staging import stage

#: Rule: share that is compared, cutoffs from lenient to strict (a document is rejected if its share is above).
GRID = [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", GRID),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", GRID),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", GRID),
    "word_length": ("word_chars / greatest(n_words, 1)", [60.0, 40.0, 30.0, 25.0, 20.0, 18.0, 16.0]),
}
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
#: A wrongly rejected good document weighs as many rightly rejected bad ones when cutoffs are compared.
GOOD_WEIGHT = 20


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts per document, with the hash of its text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A document stays in its row: words are hashed, 5-word windows are hashes of five hashes, and only documents with a window
    found twice sort their windows. No shuffle, and no more memory than a multiple of the document.
    """
    pattern = SPACE.replace("\\", "\\\\")
    step = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
    )
    step = step.selectExpr(
        "doc_id",
        "stratum",
        "xxhash64(t) AS text_tag",
        f"transform(filter(split(t, '{pattern}'), x -> x != ''), x -> xxhash64(x)) AS h",
        # the characters taken out are white space of words, then symbols
        r"cast(char_length(translate(t, ' \t\n\u000B\u000C\r', '')) AS long) AS word_chars",
        "cast(char_length(t) - char_length(translate(t, '#*$%&|<>', '')) AS long) AS n_symbols",
        r"filter(split(t, '\n'), x -> translate(x, ' \t\n\u000B\u000C\r', '') != '') AS lines",
    )
    step = step.selectExpr(
        "doc_id",
        "stratum",
        "text_tag",
        "cast(size(h) AS long) AS n_words",
        "word_chars",
        "n_symbols",
        "cast(size(lines) AS long) AS n_lines",
        "cast(size(lines) - size(array_distinct(lines)) AS long) AS n_dup_lines",
        "CASE WHEN size(h) >= 5 THEN transform(sequence(0, size(h) - 5),"
        " i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])) ELSE array() END AS win",
    )
    step = step.withColumn(
        "s",
        F.expr(
            "CASE WHEN size(array_distinct(win)) < size(win) THEN"
            " sort_array(transform(win, (x, i) -> struct(x AS x, i AS i))) END"
        ),
    )
    step = step.withColumn(
        "p",
        F.expr(
            "sort_array(transform(filter(s, (e, j) -> e.x <=> get(s, j - 1).x OR e.x <=> get(s, j + 1).x), e -> e.i))"
        ),
    )
    covered = "aggregate(transform(slice(p, 2, greatest(size(p), 1)), (q, j) -> least(5, q - p[j])), 5, (a, x) -> a + x)"
    return step.select(
        "doc_id", "stratum", "text_tag", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.expr(f"cast(CASE WHEN p IS NULL THEN 0 ELSE {covered} END AS long)").alias("n_repeat_words"),
    )


def binomial_tail(n: str, k: str, a: str) -> str:
    """SQL for P(Bin(n, a) <= k), exact up to rounding; 1 where k is not below the mean, which certifies nothing."""
    ratio = f"ln({a} / (1 - {a}))"
    nxt = f"acc.t + ln(({n} - i + 1) / i) + {ratio}"
    return (
        f"CASE WHEN {k} >= {n} * {a} THEN 1D WHEN {k} = 0 THEN exp({n} * ln(1 - {a})) ELSE aggregate(sequence(1L, {k}),"
        f" struct({n} * ln(1 - {a}) AS t, exp({n} * ln(1 - {a})) AS s),"
        f" (acc, i) -> struct({nxt} AS t, acc.s + exp({nxt}) AS s), acc -> acc.s) END"
    )


def certify(counts: DataFrame, labels: DataFrame, max_false: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per stratum with a map from rule to certified cutoff; rules without one are missing from the map.

    ``counts`` is the result of ``features``; ``labels`` has doc_id and quality (1 good, 0 bad).
    """
    truth = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"))
    )
    rows = counts.where(f"NOT ({BASE_FAILED})").join(truth, "doc_id")
    grid = reduce(
        DataFrame.union,
        (
            rows.selectExpr("stratum", "good", f"'{rule}' AS rule", f"{share} AS share",
                            f"array({', '.join(f'{c}D' for c in cutoffs)}) AS cutoffs")
            for rule, (share, cutoffs) in RULES.items()
        ),
    )
    per = (
        grid.selectExpr("stratum", "good", "rule", "explode(transform(cutoffs, c -> struct(c AS cutoff, share > c AS hit))) AS e")
        .groupBy("stratum", "rule", F.col("e.cutoff").alias("cutoff"))
        .agg(
            F.sum(F.expr("cast(good > 0 AS long)")).alias("n"),
            F.sum(F.expr("cast(good > 0 AND e.hit AS long)")).alias("k"),
            F.sum(F.expr("cast(good = 0 AND e.hit AS long)")).alias("bad"),
        )
    )
    strata = rows.agg(F.countDistinct("stratum").alias("strata"))
    part = f"{max_false / len(RULES)}D"
    tested = per.join(F.broadcast(strata)).withColumn("p_value", F.expr(binomial_tail("n", "k", part)))  # one row
    best = (
        tested.where(f"n > 0 AND bad > 0 AND p_value <= {delta}D / (strata * {len(RULES)})")
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct((F.col("bad") - GOOD_WEIGHT * F.col("k")).alias("gain"), "cutoff")).alias("b"))
        .where("b.gain > 0")
    )
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "b.cutoff"))).alias("cutoffs"))


def quality_rules(docs: DataFrame, labels: DataFrame, max_false: float = 0.02, delta: float = 0.05, **columns: str) -> DataFrame:
    """One row per document: the counts, base_failed, kept (neither rule set rejects it), and text_tag (xxhash64 of the text)."""
    counts = stage(features(docs, **columns), "quality")  # read for the labels and again for the verdicts
    # written, so that the join is chosen by the size of a few rows per stratum and not by an estimate that grows with the documents
    cutoffs = stage(certify(counts, labels, max_false, delta), "cutoffs")
    judged = counts.join(cutoffs, "stratum", "left")
    above = " OR ".join(f"coalesce({share} > cutoffs['{rule}'], false)" for rule, (share, _) in RULES.items())
    return judged.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stratum", "text_tag",
        f"{BASE_FAILED} AS base_failed", f"NOT ({BASE_FAILED}) AND NOT ({above}) AS kept",
    )
