"""Projection to a declared layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of a mapping and the Spark types they stand for.
MAPPING_TYPES = {"string": "string", "integer": "int", "long": "bigint", "double": "double", "boolean": "boolean"}


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Select, rename and cast by (source, source type, target, target type); other columns are dropped.

    A value that does not fit its target becomes null. Doubles lose their fraction on the way to integers.
    """
    return df.select(
        *[F.col(src).try_cast(MAPPING_TYPES.get(kind, kind)).alias(dst) for src, _, dst, kind in mapping]
    )


def first_columns(df: DataFrame, n: int) -> list[str]:
    """Names of the first ``n`` columns, the features of a table whose label comes last."""
    return df.columns[:n]


def to_records(df: DataFrame) -> DataFrame:
    """Stream records: the row as JSON text in ``Data`` and a random ``PartitionKey``."""
    return df.select(F.to_json(F.struct("*")).alias("Data"), F.uuid().alias("PartitionKey"))


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame itself, or an error when its columns drift from the declared schema."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if have != want:
        raise ValueError(f"schema drift: expected {want}, got {have}")
    return df
