"""Feed-forward classifier of two classes, trained in mini-batches on Spark.

An epoch is one Spark job. Each task starts from the same weights, goes through its rows in mini-batches, and hands on its
weights with the number of its rows; their weighted mean, added up per network by tasks, starts the next epoch. With one
task this is plain mini-batch descent. Several networks, which differ in rate, dropout or held-out fold, train in the same
job.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.models.stored import StoredModel
from tablework.session import pin

#: rows of a task of training
TASK_ROWS = 1 << 14
#: tasks of a network whose sums are added by one task; those of more are added in two steps
ADDED = 64
#: rows that are scored at once, whose units still fit a core's cache
SCORED = 1 << 10

_EPSILON, _MOVING = 1e-5, 0.1
_FIRST, _SECOND = 0.9, 0.999  # decays of Adam's moments


@dataclass(frozen=True)
class Network:
    """Layers of rectified units, each normalised over the mini-batch and partly dropped, and one logit."""

    inputs: int
    hidden: tuple[int, ...]
    rate: float
    dropout: float = 0.0
    batch: int = 128
    adam: bool = False
    seed: int = 43

    def _shapes(self) -> list[tuple[int, ...]]:
        """Per layer weights, offsets, gains and shifts; weights and offset of the logit; per layer moving mean and spread."""
        sizes = [self.inputs, *self.hidden]
        layers = [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,), (b,), (b,))]
        return [*layers, (sizes[-1], 1), (1,), *[(b,) for b in self.hidden for _ in range(2)]]

    def _views(self, flat: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Weights and moving moments as views of one array."""
        out, at = [], 0
        for shape in self._shapes():
            out.append(flat[at:at + math.prod(shape)].reshape(shape))
            at += math.prod(shape)
        weights = 4 * len(self.hidden) + 2
        return out[:weights], out[weights:]

    @property
    def size(self) -> int:
        return sum(math.prod(s) for s in self._shapes())

    @property
    def n_weights(self) -> int:
        return self.size - 2 * sum(self.hidden)

    def start(self) -> np.ndarray:
        """Weights and moving moments, then with Adam's rule its two moments per weight and its number of steps."""
        state = np.zeros(self.size + (2 * self.n_weights + 1 if self.adam else 0))
        rng = np.random.default_rng(self.seed)
        weights, moving = self._views(state[:self.size])
        for k, w in enumerate(weights):
            if w.ndim == 2:
                w[:] = rng.normal(0, math.sqrt(2 / w.shape[0]), w.shape)
            elif k < 4 * len(self.hidden) and k % 4 == 2:
                w[:] = 1
        for spread in moving[1::2]:
            spread[:] = 1
        return state

    def _forward(self, weights, moving, x: np.ndarray, rng=None):
        kept = []
        for k in range(len(self.hidden)):
            w, offset, gain, shift = weights[4 * k:4 * k + 4]
            z = x @ w
            z += offset
            normal = np.maximum(z, 0)
            mean, spread = moving[2 * k:2 * k + 2]
            if rng is None:
                normal -= mean
            else:
                own_mean = normal.mean(0)
                normal -= own_mean
                own_spread = _dots(normal, normal) / len(normal)
                mean += _MOVING * (own_mean - mean)
                spread += _MOVING * (own_spread - spread)
                spread = own_spread
            scale = 1 / np.sqrt(spread + _EPSILON)
            normal *= scale
            mask = 1.0 if rng is None or not self.dropout else (rng.random(z.shape) >= self.dropout) / (1 - self.dropout)
            kept.append((x, z, normal, scale, mask))
            x = normal * gain
            x += shift
            x *= mask
        return (x @ weights[-2] + weights[-1])[:, 0], x, kept

    def logits(self, state: np.ndarray, x: np.ndarray) -> np.ndarray:
        weights, moving = self._views(state[:self.size])
        out = np.empty(len(x))
        for k in range(0, len(x), SCORED):
            out[k:k + SCORED] = self._forward(weights, moving, x[k:k + SCORED])[0]
        return out

    def step(self, state: np.ndarray, x: np.ndarray, y: np.ndarray, rng) -> float:
        """One mini-batch; the state is changed in place. Returns the summed loss before the step."""
        weights, moving = self._views(state[:self.size])
        logits, last, kept = self._forward(weights, moving, x, rng)
        gradient = np.zeros(self.size)
        grads, _ = self._views(gradient)
        delta = ((_sigmoid(logits) - y) / len(y))[:, None]
        grads[-2][:], grads[-1][:] = last.T @ delta, delta.sum(0)
        delta = delta @ weights[-2].T
        for k in range(len(self.hidden) - 1, -1, -1):
            x, z, normal, scale, mask = kept[k]
            delta *= mask
            by_gain, by_shift = _dots(delta, normal), delta.sum(0)
            grads[4 * k + 2][:], grads[4 * k + 3][:] = by_gain, by_shift
            # what the mini-batch's own mean and spread take back
            delta -= by_shift / len(y)
            delta -= normal * (by_gain / len(y))
            delta *= weights[4 * k + 2] * scale
            delta *= z > 0
            grads[4 * k][:], grads[4 * k + 1][:] = x.T @ delta, delta.sum(0)
            if k:
                delta = delta @ weights[4 * k].T
        gradient = gradient[:self.n_weights]
        if self.adam:
            first, second = (state[self.size + k * self.n_weights:][:self.n_weights] for k in (0, 1))
            state[-1] += 1
            first += (1 - _FIRST) * (gradient - first)
            second += (1 - _SECOND) * (gradient ** 2 - second)
            gradient = first / (1 - _FIRST ** state[-1]) / (np.sqrt(second / (1 - _SECOND ** state[-1])) + 1e-8)
        state[:self.n_weights] -= self.rate * gradient
        return float(_losses(logits, y).sum())


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of like entries, added by column."""
    return np.einsum("ij,ij->j", a, b)


def _sigmoid(logits: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * logits))


def _losses(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, logits) - y * logits


@dataclass(frozen=True)
class Epoch:
    """Mean losses of an epoch: of the training rows as they were met, and of the held-out rows after it."""

    train_loss: float
    held_loss: float | None
    held_accuracy: float | None
    n_train: int
    n_held: int


@dataclass(frozen=True)
class Trained:
    network: Network
    state: np.ndarray
    epochs: list[Epoch]


def training_rows(df: DataFrame, features: str, label: str, fold: str | None = None) -> DataFrame:
    """(x, y, fold) of the rows with a label, stored in as many files as training gets tasks, in an order by hash.

    A null among the features is an error of the vector's assembler; a row without a label is left out, since there is
    nothing to learn from it. Without ``fold`` every row is for training.
    """
    rows = df.filter(F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"))
    rows = pin(rows, "features")
    n = rows.count()
    if not n:
        raise ValueError(f"no row has a {label}")
    spread = rows.repartition(math.ceil(n / TASK_ROWS))
    return pin(spread.sortWithinPartitions(F.xxhash64("x", "y", "fold")), "training")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return x.reshape(batch.num_rows, -1), batch.column("y").to_numpy(), batch.column("fold").to_numpy()


def _pass(networks: Sequence[tuple[Network, int]], groups: int, sent, epoch: int, learn: bool) -> Callable:
    """Goes through a task's rows with the networks of its group, every ``groups``-th one: each learns from its training
    rows and scores its held-out ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = sent.value
        totals: dict[int, list] = {}
        seed = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, part = _arrays(batch)
            if seed is None:  # tasks differ, networks of one task don't
                seed = [epoch, zlib.crc32(x.tobytes())]
            for cell in range(batch.column("group")[0].as_py(), len(networks), groups):
                network, fold = networks[cell]
                before = states[cell]
                if cell not in totals:
                    totals[cell] = [before.copy(), np.zeros(5), np.random.default_rng(seed)]
                state, sums, rng = totals[cell]
                held = part == fold
                if held.any():
                    logits = network.logits(before, x[held])
                    sums[2:] += held.sum(), _losses(logits, y[held]).sum(), ((logits >= 0) == (y[held] == 1)).sum()
                if learn and not held.all():
                    order = rng.permutation(np.flatnonzero(~held))
                    for k in range(0, len(order), network.batch):
                        some = order[k:k + network.batch]
                        sums[:2] += len(some), network.step(state, x[some], y[some], rng)
        for cell, (state, sums, _) in totals.items():
            out = np.concatenate([sums, state * sums[0]]) if learn else sums
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([out.tobytes()])], ["cell", "sums"])

    return run


def _summed(passed: DataFrame, cells: int, tasks: int) -> dict[int, np.ndarray]:
    """The sums of each cell over all tasks of a pass; the driver gets one array per cell, however many tasks there are."""
    found = passed.rdd.map(lambda r: (r["cell"], np.frombuffer(r["sums"])))
    if tasks > ADDED:
        width = math.isqrt(tasks)
        parts = found.mapPartitionsWithIndex(lambda i, some: (((cell, i % width), sums) for cell, sums in some))
        found = parts.reduceByKey(np.add, cells * width).map(lambda r: (r[0][0], r[1]))
    return dict(found.reduceByKey(np.add, cells).collect())


def train(rows: DataFrame, cells: Sequence[tuple[Network, int | None]], epochs: int) -> list[Trained]:
    """Train networks side by side on stored rows, each without the rows of its held-out fold, and score it on these.

    The driver keeps one state per network: a number per weight, three with Adam's rule. Held-out rows are scored with the
    weights of the last epoch in the job that learns the next one, and one more pass ends it. The networks of a group share
    a task's rows; there are several groups, which read the rows once each, where rows alone don't keep all cores busy.
    """
    context = rows.sparkSession.sparkContext
    networks = [(network, -2 if fold is None else fold) for network, fold in cells]
    tasks = rows.rdd.getNumPartitions()
    groups = min(len(cells), math.ceil(2 * context.defaultParallelism / max(tasks, 1)))
    every = reduce(DataFrame.unionAll, [rows.select("x", "y", "fold", F.lit(k).alias("group")) for k in range(groups)])
    states = [network.start() for network, _ in networks]
    met: list[list] = [[] for _ in networks]
    for epoch in range(epochs + 1):
        sent = context.broadcast(states)
        passed = every.mapInArrow(_pass(networks, groups, sent, epoch, epoch < epochs), "cell int, sums binary")
        sums = _summed(passed, len(networks), tasks)
        for k in range(len(networks)):
            met[k].append(sums[k][:5] if k in sums else np.zeros(5))
            if epoch < epochs and met[k][-1][0]:
                states[k] = sums[k][5:] / met[k][-1][0]
        sent.destroy()
    return [Trained(network, states[k], _epochs(met[k])) for k, (network, _) in enumerate(networks)]


def cross_validate(
    rows: DataFrame, networks: Sequence[Network], epochs: int, n_folds: int = 4
) -> dict[tuple[Network, int], Trained]:
    """Every network without every fold in [0, n_folds), each pair trained once, all of them in the same passes."""
    cells = [(network, fold) for network in networks for fold in range(n_folds)]
    return dict(zip(cells, train(rows, cells, epochs)))


def fold_scores(spark: SparkSession, found: dict[tuple[Network, int], Trained]) -> DataFrame:
    """One row per network and fold, with the mean accuracy of the network over its folds and its place by that mean."""
    rows = [
        (n.rate, n.dropout, fold, t.epochs[-1].n_train, t.epochs[-1].n_held, t.epochs[-1].held_accuracy)
        for (n, fold), t in found.items()]
    scores = spark.createDataFrame(
        rows, "rate double, dropout double, fold int, n_train long, n_held long, accuracy double")
    means = scores.groupBy("rate", "dropout").agg(
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("spread"))
    place = F.row_number().over(Window.orderBy(F.desc("mean_accuracy"), "rate", "dropout"))  # a row per network
    return scores.join(means.withColumn("place", place), ["rate", "dropout"])


def epoch_losses(spark: SparkSession, found: dict[tuple[Network, int], Trained]) -> DataFrame:
    """One row per network, fold and epoch, with the loss on training rows and on the held-out fold."""
    rows = [
        (n.rate, n.dropout, fold, k + 1, e.train_loss, e.held_loss, e.held_accuracy)
        for (n, fold), t in found.items() for k, e in enumerate(t.epochs)]
    return spark.createDataFrame(
        rows, "rate double, dropout double, fold int, epoch int, train_loss double, held_loss double, held_accuracy double")


def _epochs(met: list[np.ndarray]) -> list[Epoch]:
    out = []
    for now, then in zip(met, met[1:]):  # what an epoch leads to is scored in the next pass
        (n, loss), (held, held_loss, hits) = now[:2], then[2:]
        out.append(Epoch(
            float(loss / n) if n else math.nan, float(held_loss / held) if held else None, float(hits / held) if held else None,
            int(n), int(held)))
    return out


class _NetworkParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Parameters of the classifier and its model."""

    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability of class 1", TypeConverters.toString)
    hidden = Param(Params._dummy(), "hidden", "units of each hidden layer", TypeConverters.toListInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    dropout = Param(Params._dummy(), "dropout", "share of units dropped while learning", TypeConverters.toFloat)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    batch = Param(Params._dummy(), "batch", "rows of a mini-batch", TypeConverters.toInt)
    adam = Param(Params._dummy(), "adam", "steps by Adam's rule instead of the plain gradient", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "of the first weights", TypeConverters.toInt)

    def _network(self, inputs: int) -> Network:
        get = self.getOrDefault
        return Network(inputs, tuple(get("hidden")), get("rate"), get("dropout"), get("batch"), get("adam"), get("seed"))


class NetworkModel(StoredModel, _NetworkParams):
    """A trained network: adds the probability of class 1, and 1.0 from probability 0.5 as prediction."""

    def __init__(self, state: np.ndarray | None = None, inputs: int = 0, epochs: Sequence[Epoch] = ()):
        super().__init__()
        self.state, self.inputs, self.history = state, inputs, list(epochs)

    def _transform(self, df: DataFrame) -> DataFrame:
        network, state = self._network(self.inputs), self.state[:self._network(self.inputs).size].copy()

        @F.pandas_udf("double")
        def probability(x):
            import pandas as pd

            return pd.Series(_sigmoid(network.logits(state, np.stack(x.to_numpy()))) if len(x) else [], dtype="float64")

        name = self.getOrDefault("probabilityCol")
        out = df.withColumn(name, probability(vector_to_array(self.getOrDefault("featuresCol"))))
        return out.withColumn(self.getOrDefault("predictionCol"), (F.col(name) >= 0.5).cast("double"))

    def frames(self) -> dict[str, DataFrame]:
        spark = SparkSession.active()
        return {"state": spark.createDataFrame([(self.inputs, bytearray(self.state.tobytes()))], "inputs int, state binary")}

    @classmethod
    def restored(cls, frame: Callable[[str], DataFrame], model: Callable) -> NetworkModel:
        row = frame("state").first()
        return cls(np.frombuffer(bytes(row["state"])), row["inputs"])


class NetworkClassifier(Estimator, _NetworkParams):
    """Classifier of labels 0 and 1 as a pipeline stage; ``history`` of its model has the losses."""

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",
        probabilityCol: str = "probability", hidden: Sequence[int] = (128, 128), rate: float = 0.01, dropout: float = 0.2,
        epochs: int = 40, batch: int = 128, adam: bool = False, seed: int = 43,
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        given = {"features": featuresCol, "label": labelCol, "prediction": predictionCol, "probability": probabilityCol}
        self._setDefault(
            **{f"{k}Col": v for k, v in given.items()}, hidden=list(hidden), rate=rate, dropout=dropout, epochs=epochs,
            batch=batch, adam=adam, seed=seed)

    def _fit(self, df: DataFrame) -> NetworkModel:
        rows = training_rows(df, self.getOrDefault("featuresCol"), self.getOrDefault("labelCol"))
        inputs = len(rows.select("x").first()["x"])
        found, = train(rows, [(self._network(inputs), None)], self.getOrDefault("epochs"))
        return self._copyValues(NetworkModel(found.state, inputs, found.epochs))
