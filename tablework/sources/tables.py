"""Saved tables, the catalog and JDBC tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A saved table, only the listed columns."""
    table = spark.table(name)
    return table.select(*columns) if columns else table


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of a database."""
    return (
        spark.sql(f"SHOW TABLES IN {database}")
        .filter(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
    )


def create_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def define_table(
    spark: SparkSession, name: str, columns: str, location: str, *, file_format: str = "json",
    partitioned_by: Sequence[str] = (),
) -> str:
    """Declare a table over a folder; with partition columns, existing partitions are registered."""
    parts = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {file_format} {parts} LOCATION '{location}'")
    return register_partitions(spark, name) if partitioned_by else name


def register_partitions(spark: SparkSession, name: str) -> str:
    """Make partition folders written since the last call known to the catalog."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def read_jdbc(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], *, split_column: str | None = None,
    lower: int = 0, upper: int = 0, splits: int = 1, **options: str,
) -> DataFrame:
    """Listed columns of a database table, read in ``splits`` ranges of ``split_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_column:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", splits)
        )
    return reader.load().select(*columns)
