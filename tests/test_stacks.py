"""Stacks and blends: stored with their parts, used on streams, and blind to the labels they are judged by."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tablework.models import stacks
from tablework.models.group_mean import GroupMeanRegressor
from tablework.operators import evaluate
from tablework.operators.features import folds


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(300).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("double").alias("b"),
        F.concat(F.lit("g"), F.col("id") % 5).alias("group"))
    return df.withColumn("y", 3 * F.col("a") - F.col("b") + F.when(F.col("a") > 8, 20.0).otherwise(0.0)).cache()


@pytest.fixture(scope="module")
def parts(spark):
    line = LinearRegression(featuresCol="line_features", labelCol="y", predictionCol="line")
    return {
        "mean": GroupMeanRegressor(groupCol="group", labelCol="y", predictionCol="mean"),
        "line": stacks.on_columns(["a"], "line", line),
        "near": stacks.NeighborRegressor(inputCols=["a", "b"], labelCol="y", predictionCol="near", idCol="id", k=3),
    }


def test_stored_stack_scores_tables_and_streams(spark, table, tmp_path):
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"),
              GroupMeanRegressor(groupCol="group", labelCol="y", predictionCol="mean"),
              stacks.ResidualStackRegressor(labelCol="y", trees=5, depth=3)]
    model = Pipeline(stages=stages).fit(table)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    want = {r["id"]: (r["prediction"], r["mean"]) for r in model.transform(table).collect()}
    assert {r["id"]: (r["prediction"], r["mean"]) for r in again.transform(table).collect()} == want
    scored = again.transform(table)
    assert evaluate.r2(scored, "y", "prediction").first()[0] > evaluate.r2(scored, "y", "linear").first()[0]

    table.write.parquet(str(tmp_path / "in"))
    stream = again.transform(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in")))
    stream.select("id", "prediction", "mean").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert {r["id"]: (r["prediction"], r["mean"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_stored_neighbours_predict_alike(spark, table, parts, tmp_path):
    model = parts["near"].fit(table)
    model.write().overwrite().save(str(tmp_path / "n"))
    again = stacks.NeighborModel.load(str(tmp_path / "n"))
    one, two = ({r["id"]: r["near"] for r in m.transform(table).collect()} for m in (model, again))
    assert one == two and len(one) == 300
    holes = table.withColumn("y", F.when(F.col("id") != 4, F.col("y")))
    assert parts["near"].fit(holes).points.count() == 299


def test_predictions_out_of_fold_never_see_their_labels(table, parts):
    first = stacks.out_of_fold(table, parts, ["id"], 3)
    assert first.columns == [*table.columns, *parts] and first.count() == 300
    hidden = folds(table, ["id"], 3).withColumn("y", F.when(F.col("fold") == 1, 1e6).otherwise(F.col("y"))).drop("fold")
    second = stacks.out_of_fold(hidden, parts, ["id"], 3)
    rows = folds(first, ["id"], 3).join(second.select("id", *[F.col(c).alias(f"{c}_2") for c in parts]), "id").collect()
    for r in rows:
        same = all(r[c] == pytest.approx(r[f"{c}_2"], abs=1e-6) for c in parts)
        assert same == (r["fold"] == 1)  # only the other folds' predictions know the changed labels


def test_blend_is_stored_and_better_than_its_parts(spark, table, parts, tmp_path):
    predicted = stacks.out_of_fold(table, parts, ["id"], 3)
    final = LinearRegression(featuresCol="blend_features", labelCol="y", predictionCol="prediction")
    model = stacks.fit_blend(table, predicted, parts, final)
    model.write().save(str(tmp_path / "b"))
    scored = PipelineModel.load(str(tmp_path / "b")).transform(table)
    assert evaluate.r2(scored, "y", "prediction").first()[0] > max(
        evaluate.r2(scored, "y", c).first()[0] for c in ("mean", "line"))
    with pytest.raises(ValueError, match="two folds"):
        stacks.out_of_fold(table.limit(1), parts, ["id"], 3)
