"""Regressor that predicts the mean label of a row's group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.models.stored import StoredModel
from tablework.operators.joins import lookup_join
from tablework.session import pin


class _GroupMeanParams(HasLabelCol, HasPredictionCol):
    """Parameters of the regressor and its model."""

    groupCol = Param(Params._dummy(), "groupCol", "column whose groups are averaged", TypeConverters.toString)


class GroupMeanModel(StoredModel, _GroupMeanParams):
    """Stored means per group; a group that was not seen gets the mean of all labels."""

    def __init__(self, means: DataFrame | None = None, overall: float | None = None):
        super().__init__()
        self.means, self.overall = means, overall

    def _transform(self, df: DataFrame) -> DataFrame:
        group, name = self.getOrDefault("groupCol"), self.getOrDefault("predictionCol")
        means = self.means.toDF(group, name)
        return lookup_join(df, means, [group], "left").withColumn(name, F.coalesce(name, F.lit(self.overall)))

    def frames(self) -> dict[str, DataFrame]:
        overall = self.means.sparkSession.range(1).select(F.lit(self.overall).cast("double").alias("mean"))
        return {"means": self.means, "overall": overall}

    @classmethod
    def restored(cls, frame: Callable[[str], DataFrame], model: Callable) -> GroupMeanModel:
        return cls(frame("means"), frame("overall").first()["mean"])


class GroupMeanRegressor(Estimator, _GroupMeanParams):
    """``GroupMeanRegressor(groupCol="city", labelCol="stars").fit(train).transform(test)``.

    The means are written once when they are fitted; the mean of all labels follows from the sums of the groups.
    """

    @keyword_only
    def __init__(self, *, groupCol: str = "group", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GroupMeanModel:
        group, label = self.getOrDefault("groupCol"), self.getOrDefault("labelCol")
        sums = pin(df.groupBy(group).agg(F.sum(label).alias("total"), F.count(label).alias("n")), "means")
        means = sums.select(group, (F.col("total") / F.col("n")).alias("mean"))
        overall = sums.agg((F.sum("total") / F.sum("n")).alias("m")).first()["m"]
        return self._copyValues(GroupMeanModel(means, overall))
