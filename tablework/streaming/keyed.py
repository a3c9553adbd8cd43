"""Streams with a key: each record once, newest record, latest image per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablework.functions.text import full_name
from tablework.operators.latest import latest_per_key
from tablework.sinks.files import rebalanced, write_batch
from tablework.sources.files import path_exists
from tablework.streaming.ingest import run_batches


class OncePerKey:
    """A sink that takes each record once, however late it comes first or again.

    A record is known by its keys and the day of its time, however batches are cut; a key with another day is another
    record. Files lie in ``day=<d>/batch_id=<n>``, so a micro-batch lists and reads the days that it has records of, however
    many batches and days there are, and no state grows with the stream. A batch writes under its own number and is not
    compared with itself, so a replay replaces what it wrote before.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], time: str):
        self.spark, self.path, self.keys, self.time = spark, path, list(keys), time
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("day", T.StringType())])

    def absorb(self, frame: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.date_format(self.time, "yyyy-MM-dd"), F.lit("none"))
        fresh = frame.withColumn("day", day).dropDuplicates([*self.keys, "day"])
        days = [r["day"] for r in fresh.select("day").distinct().collect()]  # the days of one batch
        met = [path for path in (f"{self.path}/day={day}" for day in days) if path_exists(self.spark, path)]
        if met:
            known = self.spark.read.schema(self._stored()).option("basePath", self.path).parquet(*met)
            known = known.filter(F.col("batch_id") != batch_id).select(
                *[F.col(k).alias(f"_{k}") for k in [*self.keys, "day"]])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*self.keys, "day"]])
            fresh = fresh.join(known, same, "left_anti")
        rebalanced(fresh.withColumn("batch_id", F.lit(batch_id)), ["day"]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(self.path)

    def run(self, stream: DataFrame, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
        return run_batches(stream, self.absorb, checkpoint, every=every)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self._stored()).parquet(self.path).select(*self.schema.names)


def cursor(df: DataFrame, kind: str, key: str, time: str, previous: str | None = None) -> DataFrame:
    """Full name of the newest record, as the position to continue from; ``previous`` stays if there is none."""
    newest = F.max_by(full_name(kind, key), F.struct(time, key))
    return df.agg(F.coalesce(newest, F.lit(previous)).alias("cursor"))


class LatestImage:
    """Latest row per key of a stream, as an image and a short log of newer batches.

    Each micro-batch adds only its own newest row per key, in a folder named by its batch id, so a replay replaces
    and never duplicates. After ``longest`` batches the log is merged into a new image, so that a read meets the live
    rows and a few batches, however long the stream runs.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[Column],
        longest: int = 16,
    ):
        self.spark, self.path, self.schema, self.longest = spark, path.rstrip("/"), schema, longest
        self.keys, self.order = list(keys), list(order)

    def absorb(self, frame: DataFrame, batch_id: int) -> None:
        image, log = self._folders()
        if image is not None and batch_id <= image:
            return  # handled again after its rows went into the image
        write_batch(latest_per_key(frame, self.keys, self.order), self.path, batch_id, fmt="parquet")
        if len({*log, batch_id}) > self.longest:
            self.shorten()

    def run(self, stream: DataFrame, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
        return run_batches(stream, self.absorb, checkpoint, every=every)

    def _files(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self) -> tuple[int | None, list[int]]:
        """The last batch of the newest complete image, and the batches after it."""
        root, files = self._files()
        names = [f.getPath().getName() for f in files.listStatus(root)] if files.exists(root) else []
        images = [int(n.removeprefix("image_")) for n in names if n.startswith("image_")]
        images = [n for n in images if path_exists(self.spark, f"{self.path}/image_{n}/_SUCCESS")]
        image = max(images, default=None)
        batches = [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]
        return image, sorted(n for n in batches if image is None or n > image)

    def read(self) -> DataFrame:
        """The newest batch wins entirely; within a batch its order decided already."""
        image, log = self._folders()
        parts = [] if image is None else [(f"{self.path}/image_{image}", -1)]
        parts += [(f"{self.path}/batch_id={n}", n) for n in log]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        frames = [self.spark.read.schema(self.schema).parquet(p).withColumn("_batch", F.lit(n)) for p, n in parts]
        return latest_per_key(reduce(DataFrame.unionAll, frames), self.keys, [F.desc("_batch")]).drop("_batch")

    def shorten(self) -> None:
        """Merge the log into a new image; what it replaces goes only when the image is complete."""
        old, log = self._folders()
        if not log:
            return
        self.read().write.mode("overwrite").parquet(f"{self.path}/image_{log[-1]}")
        root, files = self._files()
        for name in [*(f"batch_id={n}" for n in log), *([] if old is None else [f"image_{old}"])]:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(root, name), True)

    def compact(self, path: str) -> DataFrame:
        """Write the merged image to a new folder and return it."""
        self.read().write.parquet(path)
        return self.spark.read.parquet(path)
