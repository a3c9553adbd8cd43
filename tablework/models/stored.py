"""Fitted models that keep tables or other models: written beside their parameters and read back, alone or as a stage of
a pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession


class StoredModel(Model, MLWritable, MLReadable):
    """A model that is its parameters, the tables of ``frames`` and the models of ``models``."""

    def frames(self) -> dict[str, DataFrame]:
        return {}

    def models(self) -> dict[str, Model]:
        return {}

    @classmethod
    def restored(cls, frame: Callable[[str], DataFrame], model: Callable[[str, type], Model]) -> StoredModel:
        """The model from its tables by name, and its models by name and class; parameters are set afterwards."""
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: StoredModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for name, frame in self.model.frames().items():
            frame.write.mode("overwrite").parquet(f"{path}/{name}")
        for name, model in self.model.models().items():
            model.write().overwrite().save(f"{path}/{name}")


class _Reader(MLReader):
    def __init__(self, kind: type[StoredModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> StoredModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.kind.restored(
            lambda name: spark.read.parquet(f"{path}/{name}"), lambda name, kind: kind.load(f"{path}/{name}"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
