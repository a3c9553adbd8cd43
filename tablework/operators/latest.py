"""Newest row per key, replacement by key, merge with keep-last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each task sends on one row per key it
    saw, so a key with a large share of the rows costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def open_first(end: str, *ties: str) -> list[Column]:
    """Order in which a missing end wins, then the latest end, then the tie columns descending."""
    return [F.desc_nulls_first(end), *(F.desc(t) for t in ties)]


def upsert(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key does not arrive again, and all rows of ``new``."""
    return current.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def merge_keep_last(frames: Sequence[DataFrame], keys: Sequence[str], arrival: Sequence[Column] = ()) -> DataFrame:
    """Union by name, where a later frame wins over an earlier one and ``arrival`` decides within a frame."""
    ranked = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    merged = ranked[0]
    for frame in ranked[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return latest_per_key(merged, keys, [F.desc("_source"), *arrival]).drop("_source")


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
