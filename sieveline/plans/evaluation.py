"""Evaluation of one scored table with several sets (train, validation, test) side by side."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from sieveline.operators.lift import bin_summary, gain_table, lift_gain_table, lift_table
from sieveline.operators.metrics import recall, roc_auc, roc_curve
from sieveline.sources.scratch import written


@dataclass(frozen=True)
class Evaluation:
    recall: DataFrame
    auc: DataFrame
    roc: DataFrame
    lift: DataFrame
    gain: DataFrame
    lift_gain: DataFrame


def evaluate_sets(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    prediction: str = "prediction",
    id: str = "id",
    split: str = "split",
    bins: int = 10,
    weight: str | None = None,
    stored: bool = False,
) -> Evaluation:
    """All diagnostics with ``split`` as an extra group key: each is one plan for all sets.

    ``score`` may be a probability or a hard 0/1 prediction. The columns needed are stored first, so
    that the model behind them scores each row once; ``stored`` says that ``scored`` is a table already.
    """
    columns = dict.fromkeys([id, split, label, score, prediction, *([weight] if weight else [])])
    scored = scored.select(*columns)
    if not stored:
        scored = written(scored, "scored")
    summary = bin_summary(scored, label, score, id, bins, weight, split)
    return Evaluation(
        recall=recall(scored, label, prediction, by=split),
        auc=roc_auc(scored, label, score, by=split),
        roc=roc_curve(scored, label, score, by=split),
        lift=lift_table(summary, split),
        gain=gain_table(summary, split),
        lift_gain=lift_gain_table(summary, split),
    )
