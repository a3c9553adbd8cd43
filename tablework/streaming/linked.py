"""Keyed tables in buckets, merged batch by batch, and a pair of them with a link table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.latest import merge_keep_last
from tablework.sinks.files import rebalanced
from tablework.sources.files import path_exists


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class BucketedTable:
    """A table with one row per key, in folders ``bucket=<n>`` by a hash of the key.

    A merge writes the buckets of the keys that arrive and leaves the others' files as they are. New buckets are first
    written in full beside the table under the batch's name, then put in place by overwriting their folders. A merge that
    broke off while folders were replaced finds what it staged when the batch is handled again, and puts it in place.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 32):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets

    def _bucket(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _at(self, path: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], self.schema).withColumn("bucket", F.lit(0))
        return self.spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])).parquet(path)

    def read(self) -> DataFrame:
        return self._at(self.path).drop("bucket")

    def stage(self, frame: DataFrame, batch: str, arrival: Sequence[Column] = ()) -> DataFrame:
        """The whole new buckets of the keys of a batch, with their ``bucket``; the batch wins over what is there, and
        ``arrival`` decides within it."""
        path = f"{self.path}-staged/{batch}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            arrived = frame.select(*self.schema.names).withColumn("bucket", self._bucket(self.keys))
            touched = [r["bucket"] for r in arrived.select("bucket").distinct().collect()]
            current = self._at(self.path).filter(F.col("bucket").isin(touched))
            merged = merge_keep_last([current, arrived], [*self.keys, "bucket"], arrival)
            rebalanced(merged, ["bucket"]).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self._at(path)

    def put(self, rows: DataFrame, touched: Sequence[int] = ()) -> None:
        """Put whole buckets in place; of the ``touched`` ones those without a row become empty."""
        rebalanced(rows, ["bucket"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket").parquet(self.path)
        if touched:
            filled = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
            for bucket in set(touched) - filled:
                _delete(self.spark, f"{self.path}/bucket={bucket}")

    def merge(self, frame: DataFrame, batch: str, arrival: Sequence[Column] = ()) -> None:
        self.put(self.stage(frame, batch, arrival))
        self.finish(batch)

    def finish(self, batch: str) -> None:
        _delete(self.spark, f"{self.path}-staged/{batch}")


class OwnedLists:
    """Owners with a list of ids in each row, kept as a table of owners and a table of links (owner, id).

    When an owner arrives again, its links are those of its new list. Links lie in the buckets of their owners, so that a
    batch writes the same few buckets in both tables.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, ids: str, link: str, buckets: int = 32
    ):
        self.owners = BucketedTable(spark, f"{path}/owners", schema, [key], buckets)
        kind = schema[ids].dataType.elementType
        self.links = BucketedTable(
            spark, f"{path}/links", T.StructType([schema[key], T.StructField(link, kind)]), [key], buckets)
        self.key, self.ids, self.link = key, ids, link

    def merge(self, frame: DataFrame, batch: str, arrival: Sequence[Column] = ()) -> None:
        staged = self.owners.stage(frame, batch, arrival)
        touched = [r["bucket"] for r in staged.select("bucket").distinct().collect()]
        linked = staged.select(self.key, F.explode(F.array_distinct(self.ids)).alias(self.link), "bucket")
        self.links.put(linked, touched)
        self.owners.put(staged)
        self.owners.finish(batch)
