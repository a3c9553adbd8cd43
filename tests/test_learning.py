"""Features, scores and models on small tables."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tablework.functions.hashing import hash_number, hash_unit
from tablework.models import training
from tablework.models.group_mean import GroupMeanModel, GroupMeanRegressor
from tablework.operators import evaluate, features
from tablework.operators.counts import category_widths
from tablework.operators.neighbors import nearest


def test_unseen_group_gets_the_overall_mean(spark, tmp_path):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "city string, stars double")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "city string")
    model = GroupMeanRegressor(groupCol="city", labelCol="stars").fit(train)
    assert {r["city"]: r["prediction"] for r in model.transform(test).collect()} == {"a": 2.0, "z": 3.0, None: 3.0}
    model.write().overwrite().save(str(tmp_path / "means"))
    again = GroupMeanModel.load(str(tmp_path / "means"))
    assert {r["city"]: r["prediction"] for r in again.transform(test).collect()} == {"a": 2.0, "z": 3.0, None: 3.0}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 4), (3, 4)], "x int, c int")
    rows = features.standard_scale(df, ["x", "c"]).collect()
    assert [(r["x_scaled"], r["c_scaled"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    assert features.scale_selected(df, ["c"]).columns == ["c", "x"]


def test_indicators(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (1, "c"), (2, None)], "id int, cat string")
    assert sorted(map(tuple, features.multi_hot_long(df, "id", "cat").collect())) == [(1, "b", 1), (1, "c", 1)]
    wide = features.multi_hot(df, "id", "cat", features.vocabulary(df, "cat"))
    assert sorted(map(tuple, wide.collect())) == [(1, 1, 1), (2, 0, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        features.vocabulary(df, "cat", limit=1)


def test_term_weights(spark):
    df = spark.createDataFrame([(1, "The cat the"), (2, "the dog"), (3, "")], "id int, text string")
    out = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(df, "id", "text").collect()}
    the, cat = 2 * (math.log(4 / 3) + 1), math.log(4 / 2) + 1
    assert set(out) == {(1, "the"), (1, "cat"), (2, "the"), (2, "dog")}
    assert out[(1, "the")] == pytest.approx(the / math.hypot(the, cat))


def test_widths(spark):
    df = spark.createDataFrame([(i, "x") for i in range(50)], "a int, b string")
    out = {r["column_name"]: (r["n_values"], r["width"]) for r in category_widths(df, ["a", "b"]).collect()}
    assert out == {"a": (50, 14), "b": (1, 2)}


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    one = features.split_train_test(df.repartition(3), ["id"])
    two = features.split_train_test(df.coalesce(1), ["id"])
    assert one.exceptAll(two).count() == 0
    assert 0.64 < one.filter("is_train").count() / 2000 < 0.70
    unit = df.select(hash_unit(1, "id").alias("u"), hash_number(1, "id").alias("n")).agg(F.min("u"), F.max("u"), F.min("n")).first()
    assert 0 <= unit[0] and unit[1] < 1 and unit[2] >= 0


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    out = {r["name"]: tuple(r)[1:] for r in evaluate.classification_report(df, "y", "p").collect()}
    assert out["1"] == (0.0, 0.0, 0.0, 1)
    assert out["0"][0] == pytest.approx(2 / 3) and out["0"][1] == 1.0
    assert out["macro avg"][1] == 0.5 and out["accuracy"][3] == 3
    assert out["weighted avg"][1] == pytest.approx(2 / 3)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion(df, "y", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert tuple(evaluate.accuracy(df, "y", "p").first()) == (pytest.approx(2 / 3), 67)


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    assert evaluate.r2(df, "y", "p").first()["r2"] == pytest.approx(0.5)
    flat = df.withColumn("y", F.lit(1.0))
    assert evaluate.r2(flat, "y", "p").first()["r2"] is None


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("double").alias("b")
    ).withColumn("y", 3 * F.col("a") - F.col("b") + F.when(F.col("a") > 8, 10.0).otherwise(0.0))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def test_ridge_equals_closed_form(spark, table):
    import numpy as np

    x = np.array([[r["a"], r["b"]] for r in table.collect()])
    y = np.array([r["y"] for r in table.collect()])
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(2), xc.T @ yc)
    got = training.ridge(table, "y", 25.0).coefficients.toArray()
    assert got == pytest.approx(want, rel=1e-6)


def test_stack_and_blends_improve_on_their_parts(table):
    def r2(df):
        return evaluate.r2(df, "y", "prediction").first()["r2"]

    linear = training.ridge(table, "y", 0.0).transform(table)
    assert r2(training.residual_stack(table, "y", trees=5, depth=3).transform(table)) > r2(linear)
    parts = {"one": ["a"], "two": ["b"]}
    plain = table.drop("features")
    assert r2(training.blend(plain, "y", parts).transform(plain)) > 0.8
    assert r2(training.blend(plain, "y", parts, final="forest").transform(plain)) > 0.8


def test_network_learns_and_keeps_its_history(table):
    labelled = table.withColumn("big", (F.col("a") > 8).cast("double"))
    model = training.network("big", [2, 8, 2], epochs=60, step=0.03).fit(labelled)
    history = training.loss_history(model)
    assert history[-1] < history[0]
    assert evaluate.accuracy(model.transform(labelled), "big", "prediction").first()["accuracy"] > 0.9


def test_cross_validation_and_scoring(spark, table, tmp_path):
    labelled = table.drop("features").withColumn("big", (F.col("a") > 8).cast("double"))
    stages = training.feature_stages(["a"], ["b"])
    model = training.train_and_store(labelled, [*stages, training.logistic("big")], str(tmp_path / "m"))
    holes = labelled.withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    scored, rejected = training.score(model, holes, ["a", "b"])
    assert scored.count() == 396 and rejected.count() == 4
    assert scored.filter("prediction <> big").count() < 20
    estimator = training.logistic("big")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.0, 5.0]).build()
    prepared = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(labelled)
    cv = training.cross_validate(prepared, estimator, grid, training.accuracy_evaluator("big"), ["id"])
    assert cv.avgMetrics[0] >= cv.avgMetrics[1] and len(cv.stdMetrics) == 2


def test_category_stages(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    stages, out = training.category_stages(["c"])
    rows = Pipeline(stages=stages).fit(df).transform(df).select(out).collect()
    assert rows[0][0] == rows[2][0] != rows[1][0]


def test_missing_predictions_do_not_raise_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None)], "y double, p double")
    with pytest.raises(Exception, match="no prediction"):
        evaluate.r2(df, "y", "p").collect()
    assert evaluate.r2(df.na.fill(0.0), "y", "p").first()["r2"] == -3.5
    assert evaluate.accuracy(df, "y", "p").first()["percent"] == 67
    assert evaluate.accuracy(df.unionByName(spark.createDataFrame([(None, 1.0)], df.schema)), "y", "p").first()["percent"] == 67


def test_neighbours_refuse_missing_features(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id long, x double")
    with pytest.raises(Exception, match="x is null"):
        nearest(df, df.filter("id = 1"), id_col="id", features=["x"], k=1).collect()
