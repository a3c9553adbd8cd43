"""Row positions, fixed-size groups, packed lists and rolling means over a total order.

A window without a key, or with one hot key, would sort a large share of the rows in one task. Here rows are
range partitioned on (key, order) so that a hot key is spread over many partitions; only the per-partition
counts, as many as there are partitions, are combined to turn local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.joins import join_null_safe
from tablework.session import pin

_ROW_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: the row number inside its partition


def _ranged(df: DataFrame, order: Sequence[str | Column], unique: bool) -> DataFrame:
    """Rows sorted over range partitions, tagged with partition number and row number, stored once.

    Rows with equal order values cannot be split by range, so unless the order is known to be unique, each row
    first gets a number of its own, fixed by storing it, and ends the order with it.
    """
    if not unique:
        df = pin(df.withColumn("_tie", F.monotonically_increasing_id()), "numbered")
        order = [*order, "_tie"]
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"),
        )
    )
    return pin(tagged.drop("_tie"), "ranged")


def global_position(
    df: DataFrame, order: Sequence[str | Column], name: str = "position", *, unique: bool = False
) -> DataFrame:
    """Add the zero-based position of each row in ``order``; equal rows take any order among themselves.

    ``unique`` states that no two rows are equal in ``order``, and saves one copy of the data.
    """
    stored = _ranged(df, order, unique)
    # one row per partition, so the unkeyed window below is as small as the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_part", "_row", "_before")
    )


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", *, unique: bool = False
) -> DataFrame:
    """Add the zero-based position of each row within its key, without gathering a key in one task."""
    stored = _ranged(df, [*keys, *order], unique)
    local = Window.partitionBy("_part", *keys).orderBy("_row")
    numbered = stored.withColumn("_local", F.row_number().over(local) - 1)
    pieces = stored.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    # a key that spans partitions is the first or the last key of each partition it touches, so at most two rows
    # per partition are left
    last = pieces.groupBy("_part").agg(F.max("_first").alias("_last"))
    edges = pieces.join(F.broadcast(last), "_part").filter("_first = 0 or _first = _last")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select("_part", *keys, F.sum("_n").over(before).alias("_before")).filter("_before is not null")
    return (
        join_null_safe(numbered, offsets, ["_part", *keys], "left")
        .withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_local")).cast("long"))
        .drop("_part", "_row", "_local", "_before")
    )


def batches_of_n(
    df: DataFrame, order: Sequence[str], size: int = 20, *, full_only: bool = True
) -> DataFrame:
    """Distinct records cut into groups of ``size`` in ``order``; the incomplete last group waits."""
    rest = [c for c in df.columns if c not in order]
    placed = global_position(df.dropDuplicates(), [*order, *rest], "_position", unique=True)
    batched = placed.withColumn("batch_id", F.floor(F.col("_position") / size).cast("long"))
    if full_only:
        total = placed.agg(F.count("*").alias("n")).scalar()
        batched = batched.filter(F.col("_position") < total - total % size)
    return batched.drop("_position")


def list_per_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One row per key with the sorted list of its distinct values.

    A list is one value of one row; for keys whose list would not fit a row there is ``values_in_order``.
    """
    pairs = df.select(key, value).filter(F.col(value).isNotNull()).dropDuplicates()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(name))


def values_in_order(df: DataFrame, key: str, value: str, name: str = "position") -> DataFrame:
    """The same in long form: (key, value, position), without gathering a key in one task."""
    pairs = df.select(key, value).filter(F.col(value).isNotNull()).dropDuplicates()
    return position_in_group(pairs, [key], [value], name, unique=True)


def rolling_mean(
    df: DataFrame, order: Sequence[str | Column], value: str, window: int, name: str, block: int = 1 << 16,
    *, unique: bool = False,
) -> DataFrame:
    """Mean of the last ``window`` values in ``order``; null where fewer rows, or a null among them, are there.

    Positions are cut into blocks, each preceded by a copy of the ``window`` rows before it. A running sum inside
    the block, less the running sum ``window`` rows earlier, gives each mean in constant time per row.
    """
    block = max(block, window)
    placed = global_position(df, order, "_position", unique=unique)
    home = F.floor(F.col("_position") / block)
    copies = F.when(F.col("_position") % block >= block - window, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.select("*", home.alias("_home"), F.explode(copies).alias("_block"))
    in_block = Window.partitionBy("_block").orderBy("_position")
    totals = {"_sum": F.coalesce(F.sum(value).over(in_block), F.lit(0)), "_seen": F.count(value).over(in_block)}
    running = spread.withColumns(totals).withColumns(
        {f"{c}_before": F.coalesce(F.lag(c, window).over(in_block), F.lit(0)) for c in totals}
    )
    mean = (F.col("_sum") - F.col("_sum_before")).cast("double") / window
    return (
        running.filter(F.col("_block") == F.col("_home"))
        .withColumn(name, F.when(F.col("_seen") - F.col("_seen_before") == window, mean))
        .drop("_position", "_home", "_block", *totals, *[f"{c}_before" for c in totals])
    )
