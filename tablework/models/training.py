"""Spark ML pipelines: regression with penalties, residual stacks, blends, networks, cross-validation, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.models.network import NetworkClassifier
from tablework.models.stacks import ResidualStackModel, ResidualStackRegressor
from tablework.operators.features import all_present, folds


def feature_stages(scaled: Sequence[str], passthrough: Sequence[str] = (), features: str = "features") -> list:
    """Scaled columns first, the others unchanged behind them, as one vector column."""
    stages = [
        VectorAssembler(inputCols=list(scaled), outputCol=f"{features}_raw"),
        StandardScaler(inputCol=f"{features}_raw", outputCol=f"{features}_scaled", withMean=True, withStd=True),
    ]
    return stages + [VectorAssembler(inputCols=[f"{features}_scaled", *passthrough], outputCol=features)]


def category_stages(columns: Sequence[str]) -> tuple[list, list[str]]:
    """Index and one-hot encode category columns; returns the stages and the vector columns."""
    indexed = [f"{c}_index" for c in columns]
    encoded = [f"{c}_vec" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
    ], encoded


def ridge(df: DataFrame, label: str, alpha: float, features: str = "features", prediction: str = "prediction"):
    """Ridge regression with penalty ``alpha`` on the plain coefficients and a free intercept.

    The solver divides the squared error by n and measures the label in its own deviation, so the penalty is
    rescaled to mean the same.
    """
    stats = df.agg(F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
    estimator = LinearRegression(
        featuresCol=features, labelCol=label, predictionCol=prediction, elasticNetParam=0.0, standardization=False,
        solver="normal", regParam=alpha * float(stats["s"]) / stats["n"],
    )
    return estimator.fit(df)


def line(label: str, *, penalty: float = 0.0, features: str = "features") -> LinearRegression:
    """Linear regression by the normal equations, with a penalty on the plain coefficients."""
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal")


def residual_stack(
    df: DataFrame, label: str, features: str = "features", trees: int = 10, depth: int = 4, seed: int = 1,
    linear: str | None = None,
) -> ResidualStackModel:
    """A linear model, then boosted trees on what it leaves; the prediction is the sum of both. The linear part may have
    features of its own, ``linear``."""
    return ResidualStackRegressor(
        featuresCol=features, linearCol=linear or features, labelCol=label, trees=trees, depth=depth, seed=seed).fit(df)


def blend(df: DataFrame, label: str, feature_sets: dict[str, Sequence[str]], *, final: str = "linear", seed: int = 1):
    """One linear model per feature set, and a linear model or a forest over their predictions."""
    stages = []
    for name, columns in feature_sets.items():
        stages += [
            VectorAssembler(inputCols=list(columns), outputCol=f"{name}_features"),
            LinearRegression(featuresCol=f"{name}_features", labelCol=label, predictionCol=f"{name}_prediction"),
        ]
    stages.append(VectorAssembler(inputCols=[f"{n}_prediction" for n in feature_sets], outputCol="blend_features"))
    if final == "forest":
        stages.append(RandomForestRegressor(
            featuresCol="blend_features", labelCol=label, predictionCol="prediction", numTrees=10, maxDepth=5, seed=seed
        ))
    else:
        stages.append(LinearRegression(featuresCol="blend_features", labelCol=label, predictionCol="prediction"))
    return Pipeline(stages=stages).fit(df)


def network(label: str, layers: Sequence[int], *, epochs: int, step: float, batch: int = 128, seed: int = 43, **more):
    """Feed-forward classifier of labels 0 and 1 with ``layers``: inputs, units of each hidden layer, and 2 classes."""
    return NetworkClassifier(labelCol=label, hidden=layers[1:-1], epochs=epochs, rate=step, batch=batch, seed=seed, **more)


def loss_history(model) -> list[float]:
    """Training loss per epoch of a fitted network."""
    return [epoch.train_loss for epoch in model.history]


def cross_validate(
    df: DataFrame, estimator, grid: Sequence[dict], evaluator: Evaluator, keys: Sequence[str], n_folds: int = 4,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Mean and spread of a metric per parameter set; folds follow from a hash of the row's key."""
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=n_folds, foldCol="fold",
        parallelism=parallelism,
    )
    return validator.fit(folds(df, keys, n_folds))


def accuracy_evaluator(label: str) -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def r2_evaluator(label: str) -> Evaluator:
    return RegressionEvaluator(labelCol=label, metricName="r2")


def train_and_store(df: DataFrame, stages: Sequence, path: str) -> PipelineModel:
    """Fit a pipeline, scaler included, store it and return the stored one."""
    Pipeline(stages=list(stages)).fit(df).write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, inputs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Predictions of a table or stream, and the rows that miss an input."""
    complete = all_present(inputs)
    return model.transform(df.filter(complete)), df.filter(~complete)


def logistic(label: str, *, penalty: float = 0.0, epochs: int = 40) -> LogisticRegression:
    """Linear classifier that says 1 from probability 0.5."""
    return LogisticRegression(featuresCol="features", labelCol=label, regParam=penalty, threshold=0.5, maxIter=epochs)
