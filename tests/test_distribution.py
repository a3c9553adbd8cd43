"""Positions, joins and neighbours where one key or one point holds a third of the rows."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablework.operators import joins
from tablework.operators.joins import is_hot, is_small, lookup_join
from tablework.operators.neighbors import knn_predict, nearest
from tablework.operators.position import batches_of_n, global_position, list_per_key, position_in_group, rolling_mean, values_in_order
from tablework.operators.resample import drop_disputed, oversample
from tablework.session import scratch
from tablework.sinks.tables import bucketed, join_bucketed

N = 6000


@pytest.fixture
def skewed(many_partitions):
    """A third of the rows under key 7, some under no key, the rest under fifty keys."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 50)
    return many_partitions.range(N).select(key.cast("int").alias("k"), (F.col("id") * 7919 % 20011).alias("v"))


def test_positions_in_a_hot_group(skewed):
    placed = position_in_group(skewed, ["k"], ["v"])
    row = F.row_number().over(Window.partitionBy("k").orderBy("v")) - 1
    assert placed.withColumn("x", row).filter("x <> position").count() == 0 and placed.count() == N


def test_positions_of_copies(many_partitions):
    df = many_partitions.range(N).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    placed = global_position(df, ["v"])
    stats = placed.agg(F.countDistinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(stats) == (N, 0, N - 1)
    wrong = placed.withColumn("before", F.lag("v").over(Window.orderBy("position"))).filter("before > v")
    assert wrong.count() == 0


def test_rolling_mean_over_blocks(many_partitions):
    df = many_partitions.range(N).select("id", (F.col("id") * 37 % 101).cast("decimal(18,2)").alias("v"))
    w = Window.orderBy("id").rowsBetween(-99, 0)
    want = df.select("id", F.when(F.count("v").over(w) == 100, F.avg(F.col("v").cast("double")).over(w)).alias("want"))
    got = rolling_mean(df, ["id"], "v", 100, "got", block=250, unique=True).select("id", "got")
    both = want.join(got, "id")
    assert both.filter("(want is null) <> (got is null) or abs(want - got) > 1e-9").count() == 0
    assert both.filter("got is null").count() == 99


@pytest.mark.parametrize("n, full", [(19, 0), (20, 20), (41, 40)])
def test_full_batches_only(spark, n, full):
    df = spark.range(n).union(spark.range(n))
    out = batches_of_n(df, ["id"], 20)
    assert out.count() == full
    assert all(r["count"] == 20 for r in out.groupBy("batch_id").count().collect())
    assert batches_of_n(df, ["id"], 20, full_only=False).count() == n


def test_lists_are_whole_also_in_long_form(skewed):
    want = sorted(r["v"] for r in skewed.filter("k = 7").select("v").distinct().collect())
    assert [r["vs"] for r in list_per_key(skewed, "k", "v", "vs").filter("k = 7").collect()] == [want]
    long = values_in_order(skewed, "k", "v").filter("k = 7").orderBy("position").collect()
    assert [r["v"] for r in long] == want and [r["position"] for r in long] == list(range(len(want)))


def test_rolling_mean_of_missing_values(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i)) for i in range(8)], "id long, v double")
    got = [r["got"] for r in rolling_mean(df, ["id"], "v", 3, "got").orderBy("id").collect()]
    assert got == [None, None, 1.0, None, None, None, 5.0, 6.0]


def test_hundreds_of_hot_keys(spark):
    facts = spark.range(30_000).select((F.col("id") % 600).cast("string").alias("k"))
    facts = facts.withColumn("k", F.when(F.col("k") != "5", F.col("k")))
    hot = is_hot(facts, ["k"], 0.0005)
    assert facts.filter(hot).count() == 30_000 and facts.filter(hot).filter("k is null").count() == 50


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_hot_and_null_keys(skewed, how, monkeypatch):
    lookup = skewed.sparkSession.range(0, 40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("x"))
    want = skewed.join(lookup, "k", how)
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    got = lookup_join(skewed, lookup, ["k"], how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_keys_and_sizes(skewed):
    hot = is_hot(skewed, ["k"], 0.05)
    assert {r["k"] for r in skewed.filter(hot).select("k").distinct().collect()} == {7, None}
    assert is_hot(skewed.sparkSession.range(1000), ["id"]) is None
    assert is_small(skewed) and not is_small(skewed, max_rows=N - 1) and not is_small(skewed, max_bytes=100)


def test_bucketed_tables_join_without_shuffle(skewed):
    spark = skewed.sparkSession
    path = scratch(spark, "buckets")
    spark.sql(f"CREATE DATABASE buckets_test LOCATION '{path}'")
    lookup = spark.range(0, 50).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("x"))
    a = bucketed(skewed, "buckets_test.facts", f"{path}/a", "k", 4, share=0.2)
    b = bucketed(lookup, "buckets_test.lookup", f"{path}/b", "k", 4, share=0.5)
    assert a[1].select("k").distinct().count() == 1
    joined = join_bucketed(a, b, "k")
    assert joined.exceptAll(skewed.join(lookup, "k").select(joined.columns)).count() == 0
    assert joined.count() == skewed.join(lookup, "k").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = a[0].join(b[0], "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_tables_with_more_hot_keys_than_any_limit(spark):
    path = scratch(spark, "hot-buckets")
    spark.sql(f"CREATE DATABASE hot_buckets_test LOCATION '{path}'")
    facts = spark.range(6000).select((F.col("id") % 150).alias("k"), "id")
    lookup = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    a = bucketed(facts, "hot_buckets_test.facts", f"{path}/a", "k", 4, share=0.004)
    b = bucketed(lookup, "hot_buckets_test.lookup", f"{path}/b", "k", 4, share=0.5)
    assert a[1].select("k").distinct().count() > 100
    assert join_bucketed(a, b, "k").count() == 6000 and join_bucketed(a, b, "k", "left").count() == 6000


def _brute(points, dims, cat_penalty, k, exclude_self):
    x = points[dims].to_numpy()
    d = np.zeros((len(x), len(x)))
    for j in range(len(dims)):
        d += (x[:, j, None] - x[None, :, j]) ** 2
    if cat_penalty:
        d += cat_penalty * (points["c"].to_numpy()[:, None] != points["c"].to_numpy()[None, :])
    ids = points["id"].to_numpy()
    by_id = np.argsort(ids)
    out = {}
    for i, own in enumerate(ids):
        near = ids[by_id[np.argsort(d[i, by_id], kind="stable")]]
        out[own] = list((near[near != own] if exclude_self else near)[:k])
    return out


@pytest.mark.parametrize("n_dims, penalty, exclude_self", [(2, 0.0, False), (2, 0.3, True), (6, 0.3, True)])
def test_neighbours_equal_brute_force(spark, n_dims, penalty, exclude_self):
    rng, n = np.random.default_rng(3), 900
    x = np.round(rng.normal(size=(n, n_dims)), 1)
    x[: n // 3] = x[0]  # a third of the points are copies of one
    dims = [f"x{i}" for i in range(n_dims)]
    points = pd.DataFrame(x, columns=dims).assign(id=rng.permutation(n), c=rng.integers(0, 3, n))
    points["lab"] = points["id"] % 7
    df = spark.createDataFrame(points)
    near = nearest(
        df, df, id_col="id", features=dims, categorical=["c"] if penalty else [], mismatch=penalty, k=4, carry=["lab"],
        exclude_self=exclude_self, block_rows=40, max_pivots=6,
    )
    rows = near.orderBy("id", "rank").toPandas()
    assert (rows["n_lab"] == rows["neighbor"] % 7).all()
    assert rows.groupby("id")["neighbor"].apply(list).to_dict() == _brute(points, dims, penalty, 4, exclude_self)


def test_fewer_points_than_neighbours(spark):
    points = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 2.0), (3, 5.0, 6.0)], "id long, x double, stars double")
    near = nearest(points, points, id_col="id", features=["x"], k=5, carry=["stars"])
    assert near.count() == 9
    assert {r["prediction"] for r in knn_predict(near, ["id"], "stars").collect()} == {3.0}


def _two_classes(spark, n_small, n_large):
    rows = [(i, float(i % 7), float(i * i % 11), i % 2, 1) for i in range(n_small)]
    rows += [(1000 + i, 50.0 + i % 13, 40.0 + i % 5, i % 3, 0) for i in range(n_large)]
    return spark.createDataFrame(rows, "id long, a double, b double, c int, y int")


def test_oversampling_reaches_one_to_one(spark):
    df = _two_classes(spark, 30, 100)
    out = oversample(df, id_col="id", label="y", numeric=["a", "b"], categorical=["c"])
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 100, 1: 100}
    made = out.filter("synthetic")
    bounds = made.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b"), F.max("c")).first()
    assert bounds[0] >= 0 and bounds[1] <= 6 and bounds[2] >= 0 and bounds[3] <= 10 and bounds[4] <= 1
    again = oversample(df.repartition(5), id_col="id", label="y", numeric=["a", "b"], categorical=["c"])
    assert out.exceptAll(again.select(out.columns)).count() == 0


def test_oversampling_a_tiny_minority(spark):
    lone = oversample(_two_classes(spark, 1, 6), id_col="id", label="y", numeric=["a", "b"], categorical=["c"])
    assert lone.filter("y = 1").select("a", "b", "c").distinct().count() == 1 and lone.filter("y = 1").count() == 6
    few = oversample(_two_classes(spark, 3, 9), id_col="id", label="y", numeric=["a", "b"])
    assert few.filter("y = 1").count() == 9
    with pytest.raises(ValueError, match="two classes"):
        oversample(_two_classes(spark, 0, 5), id_col="id", label="y", numeric=["a", "b"])


def test_disputed_rows_are_dropped(spark):
    rows = [(i, float(i), 0) for i in range(10)] + [(100, 4.5, 1)] + [(200 + i, 100.0 + i, 1) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    kept = {r["id"] for r in drop_disputed(df, id_cols=["id"], label="y", features=["x"]).collect()}
    assert 100 not in kept and {0, 1, 9, 200, 205} <= kept and not {4, 5} & kept


def test_workers_need_no_package(tmp_path):
    """Executors without this package on their path can run the neighbour search."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from tablework.session import local_session
from tablework.operators.neighbors import nearest
spark = local_session(2)
p = spark.range(50).selectExpr('id', 'double(id * 7 % 50) AS x')
print('rows', nearest(p, p, id_col='id', features=['x'], k=2, block_rows=16).count())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 100" in out.stdout, out.stderr[-2000:]
