"""File sinks whose batches can be written again without duplicating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a folder together, so that files are as many as rows need and not tasks times folders; adaptive execution
    splits a large folder over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append JSON lines below ``path``, in one folder per partition value."""
    rebalanced(df, partition_by).write.mode("append").partitionBy(*partition_by).json(path)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), fmt: str = "json") -> None:
    """Write one micro-batch to its own folder ``batch_id=<n>``; a replayed batch replaces what it wrote before."""
    writer = rebalanced(df, partition_by).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/batch_id={batch_id}")


def land_raw(df: DataFrame, path: str) -> None:
    """Keep received text unaltered beside the batch it belongs to (columns ``batch_id`` and ``value``).

    Batches are small and many, so the batch is a column and not a folder.
    """
    df.select("batch_id", "value").write.mode("append").parquet(path)


def to_parquet(df: DataFrame, path: str) -> DataFrame:
    """Copy a frame to parquet and return the copy."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
