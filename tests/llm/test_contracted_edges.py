"""Tasks make stars of their own edges, so that long chains need few rounds."""

import random

import numpy as np

from tablework.llm import components as module
from tablework.llm.components import components


def test_stars_connect_the_same_nodes():
    rng = random.Random(5)
    edges = [(rng.randrange(100), rng.randrange(100)) for _ in range(70)] + [(k, k + 1) for k in range(200, 400)]
    u, v = (np.array(x) for x in zip(*((max(e), min(e)) for e in edges if e[0] != e[1])))
    a, b = module._stars(u, v)
    assert len(set(a.tolist())) == len(a) and not set(a.tolist()) & set(b.tolist())
    root = dict(zip(a.tolist(), b.tolist()))
    assert all(root.get(x, x) == root.get(y, y) for x, y in zip(u.tolist(), v.tolist()))
    assert {x: min(k for k in root | dict.fromkeys(b.tolist()) if root.get(k, k) == y) for x, y in root.items()} == root


def test_a_chain_is_written_a_few_times(spark, monkeypatch):
    written = []
    pin = module.pin
    monkeypatch.setattr(module, "pin", lambda df, label: written.append(label) or pin(df, label))
    links = [(k, k + 1) for k in range(3000)]
    random.Random(2).shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == dict.fromkeys(range(3001), 0)
    assert len(written) <= 9


def test_edges_in_many_tasks(many_partitions, monkeypatch):
    monkeypatch.setattr(module, "AT_ONCE", 10)
    links = [(k, k + 7) for k in range(400)] + [(k, k + 1) for k in range(-900, -800)]
    got = components(many_partitions.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == {
        **{k: k % 7 for k in range(407)}, **dict.fromkeys(range(-900, -799), -900)}
    assert len(got) == 407 + 101
