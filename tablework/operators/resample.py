"""Class balancing: interpolated minority rows, and removal of rows at odds with their neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.hashing import hash_number, hash_unit
from tablework.operators.neighbors import nearest
from tablework.operators.position import global_position
from tablework.session import pin

#: copies of a row that one task makes at a time
COPIES = 4096


def category_penalty(minority: DataFrame, numeric: Sequence[str]) -> float:
    """Squared distance of two different categories: half the square of the median spread of the numeric columns."""
    spreads = minority.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first()
    ordered = sorted(float(v) for v in spreads)
    mid = len(ordered) // 2
    median = ordered[mid] if len(ordered) % 2 else (ordered[mid - 1] + ordered[mid]) / 2
    return median * median / 2


def _mode(values: Column) -> Column:
    """Most frequent entry of a short array, the smallest on ties."""
    counted = F.transform(
        F.array_sort(F.array_distinct(values)),
        lambda v: F.struct(F.size(F.filter(values, lambda x: x == v)).alias("n"), (-v).alias("v")),
    )
    return -F.array_max(counted)["v"]


def numbered_copies(rows: DataFrame, most: int, keys: Sequence[str]) -> DataFrame:
    """Each row as often as its ``_copies`` say, numbered in ``copy`` from 1; ``most`` bounds the copies of a row.

    The copies of one row are made in pieces of limited length. Where there are several, the pieces are dealt out before
    any copy is made, so that a few rows with very many copies keep all tasks busy and none makes them all.
    """
    begins = F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES))
    pieces = rows.select("*", F.explode(begins).alias("_begin"))
    if most > COPIES:
        pieces = pieces.repartition(*keys, "_begin")
    ends = F.least(F.col("_begin") + COPIES, F.col("_copies"))
    return pieces.select("*", F.explode(F.sequence(F.col("_begin") + 1, ends)).alias("copy")).drop("_copies", "_begin")


def oversample(
    df: DataFrame, *, id_col: str, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
    k: int = 5, seed: int = 42,
) -> DataFrame:
    """All rows plus synthetic minority rows up to a 1:1 ratio, with ``synthetic`` telling them apart.

    A synthetic row lies on the line from a minority row to one of its ``k`` nearest minority rows; its categories
    are the most frequent ones among those neighbours. ``id_col`` is unique. Which neighbour and where on the line follow from a hash of
    (seed, id, copy). A minority of a single row is repeated.
    """
    per_class = df.groupBy(label).agg(F.count("*").alias("n")).limit(3).collect()
    counts = {r[label]: r["n"] for r in per_class}
    if len(counts) != 2:
        raise ValueError(f"need two classes, found {sorted(counts)}")
    (small, n_small), (_, n_large) = sorted(counts.items(), key=lambda c: (c[1], c[0]))
    missing = n_large - n_small
    minority = df.filter(F.col(label) == small)
    columns = [*numeric, *categorical]
    penalty = category_penalty(minority, numeric) if categorical else 0.0
    near = nearest(
        minority.select(id_col, *columns), minority.select(id_col, *columns), id_col=id_col, features=numeric,
        categorical=categorical, mismatch=penalty, k=k, carry=columns, exclude_self=True,
    )
    lists = near.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("rank", *[f"n_{c}" for c in columns]))).alias("_near")
    )
    # every minority row is copied equally often, the first ones in hash order once more
    placed = global_position(
        minority.select(id_col, *columns).withColumn("_order", hash_number(seed, id_col)), ["_order", id_col], "_pos",
        unique=True,
    )
    n_copies = F.lit(missing // n_small) + F.when(F.col("_pos") < missing % n_small, 1).otherwise(0)
    copies = (
        placed.join(lists, id_col, "left")
        .withColumn("_near", F.coalesce("_near", F.array()))
        .filter(n_copies > 0)
        .withColumn("_copies", n_copies)
    )
    copies = numbered_copies(copies, missing // n_small + 1, [id_col])
    pick = F.get("_near", F.pmod(hash_number(seed, id_col, "copy"), F.greatest(F.size("_near"), F.lit(1))).cast("int"))
    gap = hash_unit(seed, F.lit("gap"), id_col, "copy")
    drawn = copies.withColumn("_pick", pick).withColumn("_gap", gap)
    synthetic = drawn.select(
        id_col,
        "copy",
        *[
            (F.col(c) + F.col("_gap") * (F.coalesce(F.col(f"_pick.n_{c}"), F.col(c)) - F.col(c))).cast("double").alias(c)
            for c in numeric
        ],
        *[
            F.when(F.size("_near") > 0, _mode(F.col(f"_near.n_{c}")))
            .otherwise(F.col(c))
            .alias(c)
            for c in categorical
        ],
        F.lit(small).alias(label),
        F.lit(True).alias("synthetic"),
    )
    original = df.select(
        id_col,
        F.lit(0).alias("copy"),
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *categorical,
        label,
        F.lit(False).alias("synthetic"),
    )
    return original.unionByName(synthetic)


def drop_disputed(
    df: DataFrame, *, id_cols: Sequence[str], label: str, features: Sequence[str], k: int = 3
) -> DataFrame:
    """Rows all of whose ``k`` nearest other rows carry the same label."""
    keyed = df.withColumn("_id", F.concat_ws(":", *id_cols))
    near = nearest(
        keyed.select("_id", label, *features), keyed.select("_id", label, *features), id_col="_id",
        features=features, k=k, carry=[label], exclude_self=True,
    )
    disputed = near.filter(F.col(f"n_{label}") != F.col(label)).select("_id").distinct()
    return keyed.join(disputed, "_id", "left_anti").drop("_id")


def oversample_and_clean(
    df: DataFrame, *, id_col: str, label: str, numeric: Sequence[str], k: int = 5, k_clean: int = 3, seed: int = 0
) -> DataFrame:
    """Oversample to 1:1, then drop rows whose nearest rows disagree with their label."""
    grown = pin(oversample(df, id_col=id_col, label=label, numeric=numeric, k=k, seed=seed), "grown")
    return drop_disputed(grown, id_cols=[id_col, "copy"], label=label, features=numeric, k=k_clean)
