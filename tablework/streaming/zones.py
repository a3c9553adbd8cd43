"""Raw zone to stage zone to tables, each step a stream over the files of the one before."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablework.operators.latest import merge_keep_last
from tablework.sinks.files import write_batch
from tablework.sinks.tables import VersionedTable
from tablework.streaming.ingest import file_stream, run_batches


def run_zone(
    spark: SparkSession, source: str, schema: T.StructType | str, sink: str, checkpoint: str,
    transform: Callable[[DataFrame], DataFrame], *, fmt: str = "json", glob: str | None = None,
    files_per_trigger: int | None = None, archive: str | None = None, whole_file: bool = False,
) -> None:
    """Carry all new files of one zone to the next and stop."""
    stream = file_stream(
        spark, source, schema, fmt=fmt, glob=glob, files_per_trigger=files_per_trigger, archive=archive,
        whole_file=whole_file)
    run_batches(stream, lambda frame, batch_id: write_batch(transform(frame), sink, batch_id), checkpoint)


def merge_zone(
    spark: SparkSession, source: str, schema: T.StructType | str, table: VersionedTable, checkpoint: str,
    keys: Sequence[str], arrival: Sequence, *, glob: str | None = None,
) -> None:
    """Merge all new staged rows into a table by key, the newest winning, and stop.

    Each batch writes the whole table anew, which suits tables that are replaced as a whole; a large table under
    frequent batches is kept as ``LatestImage``.
    """

    def handle(frame: DataFrame, batch_id: int) -> None:
        frames = [table.read(), frame] if table.exists() else [frame]
        # a replayed batch may read the very image it wrote before, so every attempt has a folder of its own
        table.replace(merge_keep_last(frames, keys, arrival), f"batch-{batch_id}-{uuid.uuid4().hex}")

    run_batches(file_stream(spark, source, schema, glob=glob), handle, checkpoint)
