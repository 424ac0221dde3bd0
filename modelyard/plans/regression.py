"""Regression trial: load -> filter -> split -> fit candidates -> score -> rank.

The plan mirrors an AutoML run on a table with a numeric label: a filter
stage, a seeded 80/20 split, a set of candidates, hold-out scores for every
candidate and a leaderboard.  Every step is a DataFrame transformation; the
only values that reach the driver are the fitted coefficients (a few
numbers per model) and the leaderboard itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.closed_form import LinearModel, fit_closed_form, measure_wide
from ..operators.measure import leaderboard
from ..functions.ids import numeric_keys
from ..operators.split import hash_split_col


@dataclass
class TrialResult:
    train: DataFrame
    holdout: DataFrame
    models: list[LinearModel]
    board: DataFrame


def split_frame(df: DataFrame, keys: Sequence[str], train_share: float = 0.8,
                seed: int = 1) -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn("_split", hash_split_col(keys, [train_share, 1 - train_share], seed,
                                                    numeric_keys(df, keys)))
    train = tagged.where(F.col("_split") == 0).drop("_split")
    hold = tagged.where(F.col("_split") == 1).drop("_split")
    return train, hold


def regression_trial(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                     where: str | None = None, train_share: float = 0.8, seed: int = 1,
                     filter_holdout: bool = False, sort_metric: str = "rmse") -> TrialResult:
    """Fit closed-form candidates on filtered train rows, rank on the hold-out.

    ``where`` is the filter stage (e.g. ``"p_size > 10"``): it always applies
    to the train rows; ``filter_holdout`` chooses whether it also applies to
    the hold-out (a pipeline replays it at predict time, the bare models do
    not).  The split is a hash of ``keys``, so filtering before or after it
    picks the same rows.
    """
    cols = list(dict.fromkeys([*keys, label, *features]))
    base = df.select(*cols)
    train, hold = split_frame(base, keys, train_share, seed)
    if where:
        train = train.where(where)
        if filter_holdout:
            hold = hold.where(where)
    models = fit_closed_form(train, label, features)
    board = leaderboard(measure_wide(hold, models, label), sort_metric)
    return TrialResult(train, hold, models, board)
