"""Models over models: trees on what a linear model leaves, neighbours as a model, and blends of different models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasInputCols, HasLabelCol, HasPredictionCol, HasSeed, Param, Params, TypeConverters)
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.models.stored import StoredModel
from tablework.operators.features import all_present, folds
from tablework.operators.neighbors import knn_predict, nearest
from tablework.session import pin


class _StackParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    """Parameters of the stack and its model."""

    linearCol = Param(Params._dummy(), "linearCol", "features of the linear part", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "boosted trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "of each tree", TypeConverters.toInt)


class ResidualStackModel(StoredModel, _StackParams):
    """Adds ``linear``, ``correction`` and their sum, the prediction. Works on tables and streams."""

    def __init__(self, linear: LinearRegressionModel | None = None, boosted: GBTRegressionModel | None = None):
        super().__init__()
        self.linear, self.boosted = linear, boosted

    def _transform(self, df: DataFrame) -> DataFrame:
        both = self.boosted.transform(self.linear.transform(df))
        return both.withColumn(self.getOrDefault("predictionCol"), F.col("linear") + F.col("correction"))

    def models(self) -> dict:
        return {"linear": self.linear, "boosted": self.boosted}

    @classmethod
    def restored(cls, frame: Callable, model: Callable) -> ResidualStackModel:
        return cls(model("linear", LinearRegressionModel), model("boosted", GBTRegressionModel))


class ResidualStackRegressor(Estimator, _StackParams):
    """A linear model, then boosted trees on what it leaves. The linear part may have features of its own."""

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", linearCol: str = "features", labelCol: str = "label",
        predictionCol: str = "prediction", trees: int = 10, depth: int = 4, seed: int = 1,
    ):
        super().__init__()
        self._setDefault(linearCol="features", trees=10, depth=4, seed=1)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ResidualStackModel:
        get = self.getOrDefault
        linear = LinearRegression(featuresCol=get("linearCol"), labelCol=get("labelCol"), predictionCol="linear").fit(df)
        rest = linear.transform(df).withColumn("residual", F.col(get("labelCol")) - F.col("linear"))
        boosted = GBTRegressor(
            featuresCol=get("featuresCol"), labelCol="residual", predictionCol="correction", maxIter=get("trees"),
            maxDepth=get("depth"), seed=get("seed")).fit(rest)
        return self._copyValues(ResidualStackModel(linear, boosted))


class _NeighborParams(HasInputCols, HasLabelCol, HasPredictionCol):
    """Parameters of the neighbour regressor and its model."""

    idCol = Param(Params._dummy(), "idCol", "unique id of a row", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)


class NeighborModel(StoredModel, _NeighborParams):
    """The stored points; adds the mean label of the nearest ones. For tables: a search needs all its queries."""

    def __init__(self, points: DataFrame | None = None):
        super().__init__()
        self.points = points

    def _transform(self, df: DataFrame) -> DataFrame:
        id_col, inputs, label = self.getOrDefault("idCol"), self.getOrDefault("inputCols"), self.getOrDefault("labelCol")
        near = nearest(
            df.select(id_col, *inputs), self.points, id_col=id_col, features=inputs, k=self.getOrDefault("k"), carry=[label])
        return df.join(knn_predict(near, [id_col], label, self.getOrDefault("predictionCol")), id_col, "left")

    def frames(self) -> dict[str, DataFrame]:
        return {"points": self.points}

    @classmethod
    def restored(cls, frame: Callable, model: Callable) -> NeighborModel:
        return cls(frame("points"))


class NeighborRegressor(Estimator, _NeighborParams):
    """Mean label of the ``k`` nearest rows; rows without an input or a label are no neighbours."""

    @keyword_only
    def __init__(
        self, *, inputCols: Sequence[str] | None = None, labelCol: str = "label", predictionCol: str = "prediction",
        idCol: str = "id", k: int = 5,
    ):
        super().__init__()
        self._setDefault(idCol="id", k=5)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> NeighborModel:
        columns = [self.getOrDefault("idCol"), *self.getOrDefault("inputCols"), self.getOrDefault("labelCol")]
        points = pin(df.filter(all_present(columns)).select(*columns), "points")
        return self._copyValues(NeighborModel(points))


def out_of_fold(
    df: DataFrame, parts: dict[str, Estimator], keys: Sequence[str], n_folds: int = 4, seed: int = 7
) -> DataFrame:
    """All rows with one prediction column per part, each made by a model that was fitted without the row's fold.

    ``parts`` are estimators by the name of their prediction column. Folds follow from a hash of ``keys``.
    """
    numbered = pin(folds(df, keys, n_folds, seed, "_fold"), "folds")
    out = None
    for fold in range(n_folds):
        others, held = numbered.filter(F.col("_fold") != fold), numbered.filter(F.col("_fold") == fold)
        if held.isEmpty() or others.isEmpty():
            continue
        for name, part in parts.items():
            held = part.fit(others).transform(held).select(*held.columns, name)
        out = held if out is None else out.unionAll(held)
    if out is None:
        raise ValueError("out-of-fold predictions need rows in two folds")
    return pin(out.drop("_fold"), "out-of-fold")


def fit_blend(
    df: DataFrame, predicted: DataFrame, parts: dict[str, Estimator], final: Estimator, features: str = "blend_features"
) -> PipelineModel:
    """The parts fitted on all rows of ``df``, and behind them ``final``, which takes their predictions from ``features``.

    ``final`` learns from ``predicted``, the out-of-fold predictions: from the parts' own rows it would learn to trust
    the part that repeats its labels best.
    """
    assembler = VectorAssembler(inputCols=list(parts), outputCol=features)
    last = final.fit(assembler.transform(predicted))
    return PipelineModel([*[_alone(part.fit(df)) for part in parts.values()], assembler, last])


def _alone(model) -> PipelineModel:
    return model if isinstance(model, PipelineModel) else PipelineModel([model])


def on_columns(inputs: Sequence[str], name: str, model: Estimator) -> Pipeline:
    """A model of Spark ML on columns: they are assembled as ``name``_features, which it must read."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol=f"{name}_features"), model])
