"""Bounded samples of labelled documents, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import fold_of, stored

#: Learning never sees rows whose crc32(id) modulo FOLDS is HELD.
FOLDS, HELD = 4, 2


def held_out(id_column: str = "doc_id"):
    return fold_of(id_column, FOLDS) == HELD


def sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, name: str) -> tuple[DataFrame, dict[int, int]]:
    """(stored rows: text, y, part; label counts by class over all rows that may be learned from).

    At most ``per_class`` labels of each class, those with the smallest hash of the id; their documents
    come by a broadcast join of these at most ``2 * per_class`` ids. ``part`` is a further hash bit.
    """
    usable = labels.where(F.col(target).isin(0, 1) & ~held_out()).select("doc_id", F.col(target).cast("int").alias("y")).distinct()
    counts = {int(r["y"]): int(r["n"]) for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64(F.lit(7), F.col("doc_id")), F.col("doc_id")]
    picked = None
    for y in (0, 1):
        some = usable.where(F.col("y") == y).orderBy(*order).limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    part = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id")), F.lit(2)).cast("int").alias("part")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "y", part)
    return stored(rows.repartition(12), name), counts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients (constant last) by Newton's method on the weighted, ridge-penalised log loss."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([l2] * (x.shape[1] - 1) + [1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def prior(counts: dict[int, int]) -> float:
    """Share of label 1, drawn a little to one half; one half without labels."""
    return (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
