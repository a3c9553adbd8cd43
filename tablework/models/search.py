"""Choosing a penalty or a number of neighbours by cross-validation, without fitting again for each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.features import all_present, folds
from tablework.operators.neighbors import nearest


@dataclass(frozen=True)
class Moments:
    """Number, means and population covariances of some rows; the label is the last column."""

    n: int
    mean: np.ndarray
    spread: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        away = other.mean - self.mean
        spread = (self.n * self.spread + other.n * other.spread) / n + np.outer(away, away) * self.n * other.n / n**2
        return Moments(n, self.mean + away * other.n / n, spread)

    def ridge(self, penalty: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept with ``penalty`` on the plain coefficients; the least ones where many fit equally."""
        p = len(self.mean) - 1
        a = self.n * self.spread[:p, :p] + penalty * np.eye(p)
        coefficients = np.linalg.lstsq(a, self.n * self.spread[:p, p], rcond=None)[0]
        return coefficients, float(self.mean[p] - coefficients @ self.mean[:p])

    def r2(self, coefficients: np.ndarray, intercept: float) -> float | None:
        """R2 of a linear model on these rows; None where their label is constant."""
        p, n = len(self.mean) - 1, self.n
        bias = self.mean[p] - intercept - coefficients @ self.mean[:p]
        left = self.spread[p, p] - 2 * coefficients @ self.spread[:p, p] + coefficients @ self.spread[:p, :p] @ coefficients
        return float(1 - n * (left + bias**2) / (n * self.spread[p, p])) if self.spread[p, p] else None


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, Moments]:
    """Moments of each fold, by one aggregation over the rows that have all columns; a few numbers per fold come back."""
    columns = [*features, label]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    rows = df.filter(all_present(columns)).groupBy(fold).agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(c) for c in columns]).alias("mean"),
        F.array(*[F.covar_pop(columns[i], columns[j]) for i, j in pairs]).alias("spread")).collect()
    out = {}
    for r in rows:
        spread = np.zeros((len(columns), len(columns)))
        for (i, j), v in zip(pairs, r["spread"]):
            spread[i, j] = spread[j, i] = v
        out[r[fold]] = Moments(r["n"], np.array(r["mean"]), spread)
    return out


def penalty_search(
    df: DataFrame, features: Sequence[str], label: str, penalties: Sequence[float], keys: Sequence[str], n_folds: int = 4
) -> DataFrame:
    """(penalty, fold, r2): ridge regression without each fold, scored on it.

    Rows are read once: a fold is scored, and the others are fitted, from their moments. A fold without rows is not
    scored, nor is any if only one has rows.
    """
    found = fold_moments(folds(df, keys, n_folds), features, label, "fold")
    rows = []
    for fold, held in sorted(found.items()):
        others = [m for k, m in found.items() if k != fold]
        if others:
            learned = reduce(Moments.__add__, others)
            rows += [(float(p), fold, held.r2(*learned.ridge(p))) for p in penalties]
    return df.sparkSession.createDataFrame(rows, "penalty double, fold int, r2 double")


def best_penalty(scores: DataFrame) -> float:
    """The penalty of the highest mean score, the larger of two that score alike."""
    means = scores.groupBy("penalty").agg(F.avg("r2").alias("r2"))
    return means.orderBy(F.desc("r2"), F.desc("penalty")).first()["penalty"]


def k_search(
    df: DataFrame, features: Sequence[str], label: str, ks: Sequence[int], id_col: str
) -> DataFrame:
    """(k, n, r2): each row's label from the mean of its ``k`` nearest other rows, by one search with the largest k.

    The neighbours of a smaller k are the first of those of the largest. A row with fewer others has all of them.
    """
    near = nearest(
        df.select(id_col, label, *features), df.select(id_col, label, *features), id_col=id_col, features=features,
        k=max(ks), carry=[label], exclude_self=True)
    lists = near.groupBy(id_col, label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", f"n_{label}"))), lambda s: s[f"n_{label}"].cast("double")).alias("near"))
    y = F.col(label).cast("double")

    def mean(k: int):
        some = F.slice("near", 1, k)
        return F.aggregate(some, F.lit(0.0), lambda a, b: a + b) / F.size(some)

    errors = [F.sum((y - mean(k)) * (y - mean(k))).alias(f"sse_{k}") for k in ks]
    sums = lists.agg(F.count("*").alias("n"), (F.var_pop(y) * F.count("*")).alias("sst"), *errors)
    per_k = [F.struct(F.lit(k).alias("k"), "n", (1 - F.try_divide(F.col(f"sse_{k}"), "sst")).alias("r2")) for k in ks]
    return sums.select(F.inline(F.array(*per_k)))
