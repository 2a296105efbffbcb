"""The bounded labelled sample that classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import remainder

#: A third of the ids is held out: nothing is learned from their labels.
FOLDS, HELD_OUT = 3, 1


def held_out(column) -> F.Column:
    return remainder(column, FOLDS) == HELD_OUT


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled ids outside the held-out fold, texts distinct.

    The ids are chosen by their hash, so the choice does not depend on the layout.
    At most ``rows`` ids are broadcast. Rows without id, label or text are left out.
    """
    usable = labels.where(
        F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column))
    ).select(F.col(id_column).alias("__id"), F.col(label).cast("int").alias("label"))
    # The share stays a little below the bound, so that the limit is a guard and cuts nothing.
    share = 0.95 * rows / max(usable.count(), 1)
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = usable.limit(rows)
    return (
        docs.select(F.col(id_column).alias("__id"), F.col(text_column).cast("string").alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "__id")
        .groupBy("text")
        .agg(F.max("label").alias("label"))
    )


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept."""
    design = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], penalty * len(design))
    ridge[-1] = 1e-6
    for _ in range(steps):
        chance = sigmoid(design @ weights)
        gradient = design.T @ (chance - labels) + ridge * weights
        hessian = (design * (chance * (1 - chance) + 1e-9)[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights
