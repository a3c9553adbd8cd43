"""A stream sink that is a catalog table: new partitions are registered, batches of another layout are logged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.sinks.files import rebalanced

DRIFT = "batch string, column string, expected string, found string"


class RegisteringSink:
    """Writes micro-batches to a partitioned table of the catalog.

    Each batch has a partition of its own below those of ``partition_by``, so that a batch that is handled again replaces
    what it wrote, and only the partitions it writes are registered. A batch with other columns or types than the table
    is not written to it: the differences go to the log and the rows are kept beside it, as JSON with their own columns.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Sequence[str], log: str
    ):
        self.spark, self.name, self.path, self.schema, self.log = spark, name, path.rstrip("/"), schema, log.rstrip("/")
        self.partition_by = [*partition_by, "batch"]
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema, T.StructField("batch", T.StringType())])
            parts = ", ".join(f"`{c}`" for c in self.partition_by)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION '{self.path}'")

    def drift(self, frame: DataFrame) -> list[tuple[str, str | None, str | None]]:
        """Columns that differ from the table's, with the type expected and the type found; None where there is none."""
        want = {f.name: f.dataType.simpleString() for f in self.schema}
        have = {f.name: f.dataType.simpleString() for f in frame.schema}
        return [(c, want.get(c), have.get(c)) for c in {**want, **have} if want.get(c) != have.get(c)]

    def write(self, frame: DataFrame, batch: str) -> bool:
        """Write one batch; False if it went to the log. ``batch`` names it among the batches of all streams."""
        if found := self.drift(frame):
            rows = self.spark.createDataFrame([(batch, *f) for f in found], DRIFT)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.log}/columns/entry={batch}")
            frame.write.mode("overwrite").json(f"{self.log}/rows/entry={batch}")
            return False
        rows = frame.select(*self.schema.names).withColumn("batch", F.lit(batch))
        rebalanced(rows, self.partition_by[:-1]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by).parquet(self.path)
        self._register(rows)
        return True

    def _register(self, rows: DataFrame) -> None:
        """Tell the catalog the folders of a batch, a bounded number in each statement."""
        parts = [self._value(r) for r in rows.select(*self.partition_by).distinct().collect()]
        for k in range(0, len(parts), 500):
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS " + " ".join(parts[k:k + 500]))

    def _value(self, row: T.Row) -> str:
        def text(v) -> str:
            return "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

        return "PARTITION (" + ", ".join(f"`{c}` = {text(row[c])}" for c in self.partition_by) + ")"

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop("batch")

    def drifted(self) -> DataFrame:
        """(batch, column, expected, found) of all batches that were not written."""
        schema = f"{DRIFT}, entry string"
        return self.spark.read.schema(schema).parquet(f"{self.log}/columns").drop("entry")
