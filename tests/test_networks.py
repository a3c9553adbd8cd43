"""Networks: gradients against differences, rates that act, tasks that share the work, folds and stored models."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablework.models import network
from tablework.models.network import Network, NetworkClassifier, train, training_rows
from tablework.operators import evaluate
from tablework.operators.features import folds


@pytest.fixture(scope="module")
def points(spark):
    """Inside or outside of a circle: no line tells them apart."""
    rng = np.random.default_rng(5)
    xy = rng.uniform(-1, 1, (1200, 2))
    rows = [(k, float(a), float(b), float(a * a + b * b < 0.6)) for k, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id long, a double, b double, inside double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = Network(3, (5, 4), rate=1.0, dropout=0.0)
    x, y = rng.normal(size=(16, 3)), (rng.random(16) < 0.5).astype(float)
    state = net.start()
    state[:net.n_weights] += rng.normal(0, 0.1, net.n_weights)

    def loss(weights):
        some = np.concatenate([weights, state[net.n_weights:]])
        return net.step(some, x, y, rng) / len(y)  # the loss before the step

    moved = state.copy()
    net.step(moved, x, y, rng)
    got = state[:net.n_weights] - moved[:net.n_weights]
    for k in rng.permutation(net.n_weights):
        up, down = state[:net.n_weights].copy(), state[:net.n_weights].copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        assert got[k] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=2e-6)


def test_rate_dropout_and_rule_change_the_weights(points):
    rows = training_rows(points, "features", "inside")
    nets = [Network(2, (8, 8), 0.01), Network(2, (8, 8), 0.001), Network(2, (8, 8), 0.01, 0.5), Network(2, (8, 8), 0.01, adam=True)]
    found = train(rows, [(net, None) for net in nets], 2)
    weights = [t.state[:nets[0].n_weights] for t in found]
    start = nets[0].start()[:nets[0].n_weights]
    steps = [np.abs(w - start).sum() for w in weights]
    assert steps[0] > 5 * steps[1] > 0  # a tenth of the rate goes about a tenth of the way
    assert all(not np.allclose(weights[0], w) for w in weights[1:])
    assert len({t.epochs[0].n_train for t in found}) == 1


def test_networks_learn_what_a_line_cannot(points):
    net = NetworkClassifier(labelCol="inside", hidden=[16, 16], rate=0.05, dropout=0.0, epochs=30, batch=32)
    model = net.fit(points)
    assert model.history[-1].train_loss < model.history[0].train_loss
    share = points.agg(F.avg("inside")).first()[0]
    got = evaluate.accuracy(model.transform(points), "inside", "prediction").first()["accuracy"]
    assert got > 0.9 > max(share, 1 - share) + 0.2


def test_many_tasks_learn_together(points, monkeypatch):
    """Weights of tasks are averaged by their rows; all rows count."""
    monkeypatch.setattr(network, "TASK_ROWS", 200)
    rows = training_rows(points, "features", "inside")
    assert rows.rdd.getNumPartitions() >= 4
    found, = train(rows, [(Network(2, (16, 16), 0.05, batch=16), None)], 25)
    assert found.epochs[0].n_train == 1200 and found.epochs[-1].train_loss < 0.6 * found.epochs[0].train_loss


def test_same_rows_give_the_same_weights(points):
    some = [train(training_rows(points, "features", "inside"), [(Network(2, (6,), 0.01, 0.2), None)], 2)[0] for _ in range(2)]
    assert np.array_equal(some[0].state, some[1].state)


def test_held_out_folds_are_scored_and_never_learned(spark, points):
    rows = training_rows(folds(points, ["id"], 3), "features", "inside", "fold")
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    nets = [Network(2, (8,), 0.05), Network(2, (8,), 0.001)]
    found = network.cross_validate(rows, nets, epochs=4, n_folds=3)
    assert len(found) == 6
    for (net, fold), t in found.items():
        assert all((e.n_train, e.n_held) == (1200 - sizes[fold], sizes[fold]) for e in t.epochs)
        x = np.array([r["x"] for r in rows.filter(F.col("fold") == fold).collect()])
        y = np.array([r["y"] for r in rows.filter(F.col("fold") == fold).collect()])
        assert t.epochs[-1].held_accuracy == pytest.approx(((net.logits(t.state, x) >= 0) == (y == 1)).mean())
    # labels of a held-out fold don't matter to what is learned without it
    other = rows.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    again, = train(other, [(nets[0], 1)], 4)
    assert np.array_equal(again.state, found[(nets[0], 1)].state)
    scores = network.fold_scores(spark, found).collect()
    assert sorted({r["place"] for r in scores}) == [1, 2] and len(scores) == 6
    assert network.epoch_losses(spark, found).count() == 24


def test_stored_network_predicts_alike(spark, points, tmp_path):
    plain = points.drop("features")
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"),
              NetworkClassifier(labelCol="inside", hidden=[8], rate=0.05, epochs=3, probabilityCol="p")]
    model = Pipeline(stages=stages).fit(plain)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, two = ({r["id"]: (r["p"], r["prediction"]) for r in m.transform(plain).collect()} for m in (model, again))
    assert one == two and all(0 <= p <= 1 and said == (p >= 0.5) for p, said in one.values())
    assert again.transform(plain.limit(0)).collect() == []


def test_rows_without_a_label(spark, points):
    holes = points.withColumn("inside", F.when(F.col("id") < 10, F.col("inside")))
    assert training_rows(holes, "features", "inside").count() == 10
    with pytest.raises(ValueError, match="inside"):
        training_rows(points.withColumn("inside", F.lit(None).cast("double")), "features", "inside")


def test_driver_gets_one_sum_per_network(points, monkeypatch):
    """The driver's share of a pass is the same with many tasks as with few, whether they are added in one step or two."""
    monkeypatch.setattr(network, "TASK_ROWS", 50)
    points.sparkSession.conf.set("spark.sql.files.openCostInBytes", 1 << 30)  # a task per file
    try:
        rows = training_rows(points, "features", "inside")
        assert rows.rdd.getNumPartitions() == 24
        net = Network(2, (64, 64), 0.05, 0.2)
        found, got = [], []
        collect = network.RDD.collect

        def counted(rdd):
            got.append(collect(rdd))
            return got[-1]

        monkeypatch.setattr(network.RDD, "collect", counted)
        for most in (64, 4):
            monkeypatch.setattr(network, "ADDED", most)
            found.append(train(rows, [(net, None), (net, None)], 2))
        assert [sorted(len(sums) for _, sums in r) for r in got] == [[net.size + 5] * 2, [net.size + 5] * 2, [5, 5]] * 2
        for one, two in zip(*found):
            assert np.allclose(one.state, two.state) and one.epochs[0].n_train == two.epochs[0].n_train == 1200
    finally:
        points.sparkSession.conf.unset("spark.sql.files.openCostInBytes")


def test_networks_of_a_group_learn_as_alone(points, monkeypatch):
    """Networks that share a task's rows learn what each of them learns alone."""
    monkeypatch.setattr(network, "TASK_ROWS", 50)
    rows = training_rows(folds(points, ["id"], 2), "features", "inside", "fold")
    cells = [(Network(2, (8, 8), 0.05, 0.2), 0), (Network(2, (8,), 0.01, adam=True), 1), (Network(2, (8, 8), 0.05, 0.2), 1)]
    monkeypatch.setattr(type(points.sparkSession.sparkContext), "defaultParallelism", 1)
    together = train(rows, cells, 2)
    for cell, got in zip(cells, together):
        alone, = train(rows, [cell], 2)
        assert np.allclose(alone.state, got.state) and [e.n_held for e in alone.epochs] == [e.n_held for e in got.epochs]


def test_state_has_moments_only_with_adam():
    assert len(Network(2, (8,), 0.1).start()) == Network(2, (8,), 0.1).size
    assert len(Network(2, (8,), 0.1, adam=True).start()) == Network(2, (8,), 0.1).size + 2 * Network(2, (8,), 0.1).n_weights + 1
