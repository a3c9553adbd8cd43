"""Record sinks: topics of a message log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablework.operators.mapping import to_records


def send_records(df: DataFrame, servers: str, topic: str) -> None:
    """Send rows as JSON records under random keys (needs the Kafka connector on the class path)."""
    records = to_records(df).withColumnsRenamed({"Data": "value", "PartitionKey": "key"})
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
