"""Scores of predictions, each from one aggregation over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def r2(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """1 - SSE / SST, from sums over the rows with a label; null when the label is constant.

    A labelled row without a prediction has no error to count, so it fails the query instead of raising the score.
    """
    df = df.filter(F.col(label).isNotNull())
    missing = F.raise_error(F.lit("a labelled row has no prediction")).cast("double")
    y, p = F.col(label).cast("double"), F.coalesce(F.col(prediction).cast("double"), missing)
    sums = df.agg(
        F.sum((y - p) * (y - p)).alias("sse"), (F.var_pop(y) * F.count(y)).alias("sst")
    )
    return sums.select((1 - F.try_divide("sse", "sst")).alias("r2"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of equal labels, and the same in whole percent; a labelled row without a prediction counts as wrong."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    share = F.avg(F.when(F.col(label).isNotNull(), hit.cast("double")))
    return df.agg(share.alias("accuracy")).select("accuracy", F.round(100 * F.col("accuracy")).cast("int").alias("percent"))


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Count per (actual, predicted) on the full grid."""
    cells = [
        F.struct(
            F.lit(a).alias("actual"),
            F.lit(p).alias("predicted"),
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias("n"),
        )
        for a in classes
        for p in classes
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def classification_report(df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means; undefined is 0."""
    counts = []
    for c in classes:
        is_c, said_c = F.col(label) == c, F.col(prediction) == c
        counts += [
            F.count_if(is_c & said_c).alias(f"tp_{c}"),
            F.count_if(said_c).alias(f"said_{c}"),
            F.count_if(is_c).alias(f"support_{c}"),
        ]
    totals = df.agg(*counts, F.count_if(F.col(label) == F.col(prediction)).alias("hits"), F.count("*").alias("rows"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def row(name, p, r, f, support):
        return F.struct(
            F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
            support.cast("long").alias("support"),
        )

    rows, scores = [], []
    for c in classes:
        p = ratio(F.col(f"tp_{c}"), F.col(f"said_{c}"))
        r = ratio(F.col(f"tp_{c}"), F.col(f"support_{c}"))
        f = ratio(2 * p * r, p + r)
        scores.append((p, r, f, F.col(f"support_{c}")))
        rows.append(row(str(c), p, r, f, F.col(f"support_{c}")))
    total = F.col("rows")
    acc = ratio(F.col("hits"), total)
    rows.append(row("accuracy", acc, acc, acc, total))
    macro = [sum(s[i] for s in scores) / len(classes) for i in range(3)]
    weighted = [ratio(sum(s[i] * s[3] for s in scores), sum(s[3] for s in scores)) for i in range(3)]
    rows.append(row("macro avg", *macro, total))
    rows.append(row("weighted avg", *weighted, total))
    return totals.select(F.inline(F.array(*rows)))
