"""Table sinks: create, append, replace by version, bucketed layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.joins import HOT_SHARE, is_hot
from tablework.operators.mapping import require_schema


def create_as(df: DataFrame, name: str, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("errorifexists").format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def append_to(df: DataFrame, name: str) -> None:
    """Append rows; a frame whose columns drift from the table's is refused."""
    table = df.sparkSession.table(name)
    aligned = require_schema(df.select(*table.columns), table.schema)
    aligned.write.insertInto(name)


def bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: Sequence[str] = (), *, share: float = HOT_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Save a table hashed by ``key``, and beside it the rows of keys that hold more than ``share`` of the table.

    Two such tables with equal bucket counts join without a shuffle. A bucket is read by one task, so the rows of
    a hot key would all meet there; they go to the plain table ``<name>_hot`` instead. Returns (bucketed, hot).
    """
    hot = is_hot(df, [key], share)
    hot = F.lit(False) if hot is None else hot
    (
        df.filter(~hot)
        .repartition(buckets, key)
        .write.format("parquet")
        .option("path", f"{path}/cold")
        .bucketBy(buckets, key)
        .sortBy(*(sort_by or [key]))
        .saveAsTable(name)
    )
    df.filter(hot).write.format("parquet").option("path", f"{path}/hot").saveAsTable(f"{name}_hot")
    spark = df.sparkSession
    return spark.table(name), spark.table(f"{name}_hot")


def join_bucketed(
    facts: tuple[DataFrame, DataFrame], lookup: tuple[DataFrame, DataFrame], key: str, how: str = "inner"
) -> DataFrame:
    """Join two tables saved by ``bucketed`` under one key name, the lookup with one row per key.

    ``how`` is one of inner, left, left_semi and left_anti. The bucketed parts meet without a shuffle. The facts' hot
    keys, however many their share let through, are joined to the whole lookup, where adaptive execution broadcasts
    a small side or splits a skewed one.
    """
    cold, hot = facts
    wanted, wanted_hot = lookup
    everything = wanted.unionByName(wanted_hot)
    cold_part = cold.join(wanted if wanted_hot.isEmpty() else everything, key, how)
    if hot.isEmpty():
        return cold_part
    return cold_part.unionByName(hot.join(everything, key, how))


class VersionedTable:
    """A table replaced as a whole: each image is written to a folder of its own, then the name is switched.

    The switch is one change of the table's location in the catalog, so readers see the old image or the new one; all
    images have the columns of the first. The previous image stays readable as ``<name>_old``.
    """

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.root = spark, name, root

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(f"{self.name}_current")

    def read(self) -> DataFrame:
        return self.spark.table(f"{self.name}_current")

    def previous(self) -> DataFrame:
        return self.spark.table(f"{self.name}_old")

    def replace(self, image: DataFrame, version: str) -> DataFrame:
        """Write ``image``, which may read the current one, and make it current."""
        path = f"{self.root}/{version}"
        if self.exists():
            columns = self.read().columns
            if sorted(columns) != sorted(image.columns):
                raise ValueError(f"{self.name} has the columns {columns}, the new image {image.columns}")
            image = require_schema(image.select(*columns), self.read().schema)
        image.write.mode("overwrite").parquet(path)
        if self.exists():
            self._point("old", self._location())
        self._point("current", path)
        return self.read()

    def _location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name}_current").filter("col_name = 'Location'")
        return rows.first()["data_type"]

    def _point(self, role: str, path: str) -> None:
        table = f"{self.name}_{role}"
        if self.spark.catalog.tableExists(table):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(table)
        else:
            self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table through a staging table of the database's own choosing (truncate and load)."""
    df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table).option(
        "truncate", "true"
    ).options(**options).save()
