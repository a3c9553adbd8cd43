"""Frequencies, top lists and code membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequency(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, nulls left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))


def valid_code_counts(facts: DataFrame, code: str, valid: DataFrame, valid_code: str) -> DataFrame:
    """Rows of an inner join of facts to the valid list, counted per code.

    Both sides are counted before they meet, so the join has one row per code on each side however often a code
    occurs; a code listed twice still counts twice.
    """
    left = facts.select(F.col(code).cast("string").alias("code"))
    right = valid.select(F.col(valid_code).cast("string").alias("code"))
    counted = frequency(left, "code", "_facts").join(frequency(right, "code", "_listed"), "code")
    return counted.select("code", (F.col("_facts") * F.col("_listed")).alias("n"))


def top_codes(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent codes, ties in code order."""
    return counts.orderBy(F.desc("n"), "code").limit(k)


def entities_with_codes(facts: DataFrame, entity: str, code: str, codes: DataFrame) -> DataFrame:
    """Number of distinct entities with at least one of the codes."""
    wanted = codes.select(F.col("code").cast("string").alias("_code")).distinct()
    hits = facts.join(wanted, F.col(code).cast("string") == F.col("_code"), "left_semi")
    return hits.select(entity).distinct().agg(F.count("*").alias("n_entities"))


def null_safe_extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum and maximum per column; a column with any null has null extremes."""

    def guarded(agg: Column, c: str) -> Column:
        return F.when(F.count(c) == F.count(F.lit(1)), agg)

    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            guarded(F.min(c), c).cast("double").alias("min_value"),
            guarded(F.max(c), c).cast("double").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def text_widths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Longest value per column written as text, from one pass over the table."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.max(F.length(F.col(c).cast("string"))).alias("max_length"))
        for c in columns or df.columns
    ]
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows and non-null rows of the table."""
    pairs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(t).alias("column_type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(c).alias("n_present"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def category_widths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column and the vector width they suggest, ``min(600, round(1.6 n^0.56))``."""
    cells = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
        )
    )
    counts = cells.filter("v is not null").distinct().groupBy("column_name").agg(F.count("*").alias("n_values"))
    width = F.least(F.lit(600.0), F.round(1.6 * F.pow(F.col("n_values").cast("double"), F.lit(0.56))))
    return counts.withColumn("width", width.cast("int"))
