"""Micro-batch ingestion: file stream, enrichment, partitioned sink, restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablework.functions.dates import INGEST_COLUMNS, with_ingest_columns
from tablework.functions.text import with_text_features
from tablework.operators.mapping import apply_mapping
from tablework.sinks.files import write_batch

# Layout of an enriched post, as (source, source type, target, target type).
POST_MAPPING = [
    ("subreddit", "string", "subreddit", "string"),
    ("title", "string", "title", "string"),
    ("selftext", "string", "selftext", "string"),
    ("upvote_ratio", "double", "upvote_ratio", "double"),
    ("ups", "double", "ups", "integer"),
    ("downs", "double", "downs", "integer"),
    ("score", "double", "score", "integer"),
    ("created_utc", "string", "created_utc", "string"),
    ("id", "string", "id", "string"),
    ("kind", "string", "kind", "string"),
    ("title_length", "integer", "title_length", "integer"),
    ("selftext_length", "integer", "selftext_length", "integer"),
    ("python_mentions", "integer", "python_mentions", "integer"),
]


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, *, fmt: str = "json",
    files_per_trigger: int | None = None, glob: str | None = None, archive: str | None = None, whole_file: bool = False,
) -> DataFrame:
    """All files below ``path``, oldest first, with a declared schema. JSON files are lines of records, or with
    ``whole_file`` one record or one array of records each.

    ``archive`` moves consumed files there; the last files of a run move in a later run, after their batch is
    known to be complete.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if whole_file:
        reader = reader.option("multiLine", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, offsets_per_trigger: int) -> DataFrame:
    """Values of a topic from the earliest offset (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Call ``handle(frame, batch_id)`` per non-empty micro-batch.

    ``every`` is a processing-time interval such as ``100 seconds``; without it the stream handles what is there
    and stops. A batch is handled again with the same id if its run did not complete.
    """

    def guarded(frame: DataFrame, batch_id: int) -> None:
        if not frame.isEmpty():
            handle(frame, batch_id)

    writer = stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def enrich_posts(posts: DataFrame, word: str = "python") -> DataFrame:
    """Text measures, then the declared layout."""
    measured = with_text_features(posts, "title", "selftext", word, "python_mentions")
    return apply_mapping(measured, POST_MAPPING)


def ingest(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, *,
    at: Column | None = None, every: str | None = None, partition_by: Sequence[str] = INGEST_COLUMNS,
) -> StreamingQuery:
    """Transform each micro-batch, stamp it with ingestion time (or ``at``) and write it as partitioned JSON."""

    def handle(frame: DataFrame, batch_id: int) -> None:
        write_batch(with_ingest_columns(transform(frame), at), sink, batch_id, partition_by)

    return run_batches(stream, handle, checkpoint, every=every)
