import random

from tablework.llm.components import components


def _brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    links += [(k, k + 1) for k in range(1000, 1200)] + [(2000, k) for k in range(2001, 2300)]
    links += [(5, 5), (None, 7), (8, None), (9, 10), (10, 9), (9, 10)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == _brute(links)
    assert len(got) == len({r.node for r in got})


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
