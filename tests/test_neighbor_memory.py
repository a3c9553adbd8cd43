"""Neighbour search makes few distances at once, and finds the same in small parts."""

import tracemalloc

import numpy as np
import pandas as pd

from tablework.operators import neighbors


def test_bounds_of_a_batch_take_little_memory():
    rng = np.random.default_rng(3)
    groups = neighbors._Groups(["_f0", "_f1"], 2, 0.0, rng.normal(size=(2000, 2)))
    cells = np.arange(2000)
    groups.count(pd.DataFrame({"_cell": cells, "n": 5, "lo": 0.0, "hi": 0.05}))
    asked = pd.DataFrame(rng.normal(size=(4000, 2)), columns=["_f0", "_f1"])
    asked = asked.assign(_q="q", _kth=0.05, _cell=rng.integers(0, 2000, 4000).astype("int32"))
    tracemalloc.start()
    try:
        n = sum(len(part) for part in groups.reach(iter([asked]), 4))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 4000 and peak < 100 << 20


def test_small_parts_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    xy = rng.integers(0, 40, (700, 2)).astype(float)  # many ties and copies
    rows = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(xy)], "id long, a double, b double")

    def found():
        near = neighbors.nearest(
            rows, rows, id_col="id", features=["a", "b"], k=3, exclude_self=True, block_rows=100)
        return {(r["id"], r["rank"], r["neighbor"]) for r in near.select("id", "rank", "neighbor").collect()}

    d2 = ((xy[:, None] - xy[None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(700), d2.shape), d2))[:, :3]
    wanted = {(k, rank + 1, int(n)) for k, some in enumerate(order) for rank, n in enumerate(some)}
    assert found() == wanted
    monkeypatch.setattr(neighbors, "DISTANCES", 150)
    assert found() == wanted
