"""Choices by cross-validation against plain fits, and sparse rows over many categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.models import search
from tablework.operators import features


def test_moments_add_up_and_give_plain_ridge():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(300, 4)) * [1, 50, 0.1, 3] + [0, 1e6, 5, -2]

    def moments(r):
        return search.Moments(len(r), r.mean(0), np.cov(r.T, bias=True))

    both = moments(rows[:77]) + moments(rows[77:])
    assert np.allclose(both.mean, rows.mean(0)) and np.allclose(both.spread, np.cov(rows.T, bias=True))
    x, y = rows[:, :3] - rows[:, :3].mean(0), rows[:, 3] - rows[:, 3].mean()
    for penalty in (0.0, 3.0, 1e4):
        got, intercept = both.ridge(penalty)
        assert got == pytest.approx(np.linalg.solve(x.T @ x + penalty * np.eye(3), x.T @ y), rel=1e-6)
        left = rows[:, 3] - rows[:, :3] @ got - intercept
        assert both.r2(got, intercept) == pytest.approx(1 - (left ** 2).sum() / (y ** 2).sum(), abs=1e-6)


def test_penalty_search_finds_the_penalty(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    rows = [(k, float(a), float(b), float(2 * a - b + e)) for k, ((a, b), e) in enumerate(zip(x, rng.normal(size=400)))]
    df = spark.createDataFrame([*rows, (400, None, 1.0, 1.0), (401, 1.0, 1.0, None)], "id int, a double, b double, y double")
    scores = search.penalty_search(df, ["a", "b"], "y", [0.0, 1e6], ["id"], 3)
    assert scores.count() == 6 and search.best_penalty(scores) == 0.0


def test_constant_labels_have_no_score(spark):
    df = spark.createDataFrame([(k, float(k), 1.0) for k in range(20)], "id int, a double, y double")
    assert {r["r2"] for r in search.penalty_search(df, ["a"], "y", [0.0], ["id"], 2).collect()} == {None}
    assert search.penalty_search(df.limit(0), ["a"], "y", [0.0], ["id"], 2).collect() == []


def test_k_search_with_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 3.0), (3, 5.0, 6.0)], "id int, x double, y double")
    got = {r["k"]: (r["n"], r["r2"]) for r in search.k_search(df, ["x"], "y", [1, 2, 9], "id").collect()}
    one, two = [3.0, 0.0, 3.0], [4.5, 3.0, 1.5]

    def r2(said):
        return pytest.approx(1 - sum((a - b) ** 2 for a, b in zip([0, 3, 6], said)) / 18)

    assert got == {1: (3, r2(one)), 2: (3, r2(two)), 9: (3, r2(two))}


def test_many_categories_never_meet_the_driver(spark):
    df = spark.range(50_000).select((F.col("id") % 700).alias("key"), F.concat(F.lit("c"), "id").alias("cat"))
    df = df.unionAll(spark.createDataFrame([(0, None), (9999, None)], "key long, cat string"))
    rows = {r["key"]: r for r in features.sparse_indicators(df, "key", "cat").collect()}
    names = sorted(f"c{k}" for k in range(50_000))
    assert len(rows) == 701 and rows[9999]["indices"] == []
    assert all(r["size"] == 50_000 for r in rows.values())
    assert [names[k] for k in rows[3]["indices"]] == sorted(f"c{k}" for k in range(50_000) if k % 700 == 3)


def test_numbers_of_an_earlier_table_and_vectors(spark):
    old = spark.createDataFrame([(1, "b"), (2, "a"), (2, "c")], "id int, cat string")
    new = spark.createDataFrame([(7, "c"), (7, "z"), (8, "z"), (7, "c"), (7, "a")], "id int, cat string")
    numbered = features.numbered_categories(old, "cat")
    rows = features.sparse_indicators(new, "id", "cat", numbered)
    assert sorted((r["id"], r["size"], r["indices"]) for r in rows.collect()) == [(7, 3, [0, 2]), (8, 3, [])]
    vectors = rows.withColumn("v", features.indicator_vector("size", "indices"))
    assert {r["id"]: r["v"].toArray().tolist() for r in vectors.collect()} == {7: [1, 0, 1], 8: [0, 0, 0]}
