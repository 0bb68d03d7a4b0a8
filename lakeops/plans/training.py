"""The training plan: from the feature table to scored, calibrated models and their reports."""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.constants import SPLIT, TRAIN
from lakeops.operators import models as M
from lakeops.operators.encode import class_weight, encode_splits
from lakeops.operators.quality import both_classes_gate, enforce, train_input_gate
from lakeops.sources.staging import stage


@dataclass(frozen=True)
class Encoded:
    rows: DataFrame
    encodings: DataFrame
    rate: DataFrame


@dataclass(frozen=True)
class Trained:
    encoded: Encoded
    selected: list[str]
    importances: DataFrame
    models: list[M.ScoredModel]
    scored: DataFrame
    thresholds: DataFrame
    metrics: DataFrame
    predictions: DataFrame


def encode(features: DataFrame) -> Encoded:
    """Gate, weight and encode the feature rows; written once, since every model reads them.

    Weights come first: their one-row subquery then counts plain feature rows, not encoded ones.
    """
    enforce(train_input_gate(features))
    enforce(both_classes_gate(features.filter(F.col(SPLIT) == TRAIN)))
    rows, encodings, rate = encode_splits(class_weight(features))
    return Encoded(stage(rows, "encoded"), encodings, rate)


def side_by_side(fit: Callable[[str], M.ScoredModel], names: Iterable[str], train_rows: DataFrame) -> list[M.ScoredModel]:
    """The fits of the named learners, in the order of the names.

    A boosted learner grows its trees level by level, one after the other, and leaves cores idle between the passes; the other learners take these. They run at once as long as
    their rows fit in memory together; more rows keep all cores busy by themselves.
    """
    names = list(names)
    if len(names) < 2 or train_rows.count() > M.ROWS_AT_ONCE:
        return [fit(name) for name in names]
    inherited = inheritable_thread_target(train_rows.sparkSession)
    with ThreadPoolExecutor(len(names)) as pool:
        # each has a context of its own, so that what it stages is known to the block that tidies up
        fits = [pool.submit(inherited(contextvars.copy_context().run), fit, name) for name in names]
        return [f.result() for f in fits]


def train(
    encoded: Encoded,
    names: Iterable[str] = (M.TREE, M.FOREST, M.BOOSTED),
    tuned: bool = False,
    importances: DataFrame | None = None,
    fitted: Iterable[M.ScoredModel] = (),
) -> Trained:
    """Select inputs (unless their ``importances`` are given), fit and calibrate the named learners, choose thresholds and evaluate.

    Learners among the ``fitted`` models, which must read the same inputs, are taken as they are.
    ``tuned`` searches each learner's grid first (off by default, as it multiplies the fits).
    """
    train_rows = encoded.rows.filter(F.col(SPLIT) == TRAIN)
    if importances is None:
        importances = M.select_features(train_rows)
    selected = M.top_features(importances)
    learners = M.estimators()
    names, given = list(names), {m.name: m for m in fitted}
    missing = [n for n in names if n not in given]

    def fit(name: str) -> M.ScoredModel:
        if not tuned:
            return M.fit_and_calibrate(name, learners[name], encoded.rows, selected)
        base, _ = M.tune(learners[name], M.grids()[name], train_rows, selected)
        return M.ScoredModel(name, base, M.calibrated(base, M.validation_half(encoded.rows, 1)))

    # a search runs several fits at once by itself
    found = [fit(n) for n in missing] if tuned else side_by_side(fit, missing, train_rows)
    given |= dict(zip(missing, found, strict=True))
    models = [given[n] for n in names]
    scored = M.score_models(models, encoded.rows)
    thresholds = M.choose_thresholds(scored)
    metrics = stage(M.metrics_table(scored, thresholds, selected), "metrics")
    predictions = M.predictions_table(scored, thresholds)
    return Trained(encoded, selected, importances, models, scored, thresholds, metrics, predictions)
