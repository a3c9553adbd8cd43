"""Edges that one task can make stars of at once are written once, however many files they lie in."""

import random

import pytest

from tablework.llm import components as module


def _found(frame, monkeypatch):
    written = []
    pin = module.pin
    monkeypatch.setattr(module, "pin", lambda df, label: written.append(label) or pin(df, label))
    got = module.components(frame, "a", "b").collect()
    assert len(got) == len({r.node for r in got})
    return {r.node: r.component for r in got}, written


def test_few_edges_in_many_files_are_written_once(many_partitions, monkeypatch):
    links = [(k, k + 1) for k in range(500)] + [(1000, 1000), (None, 3), (700, 600)]
    random.Random(4).shuffle(links)
    got, written = _found(many_partitions.createDataFrame(links, "a long, b long").repartition(40), monkeypatch)
    assert got == {**dict.fromkeys(range(501), 0), 600: 600, 700: 600}
    assert written == ["components"]


@pytest.mark.parametrize("at_once", [20, 499, 500])
def test_more_edges_end_in_the_same_components(many_partitions, monkeypatch, at_once):
    monkeypatch.setattr(module, "AT_ONCE", at_once)
    links = [(k, k + 5) for k in range(400)] + [(k, -k) for k in range(1000, 1100)]
    random.Random(6).shuffle(links)
    got, written = _found(many_partitions.createDataFrame(links, "a long, b long").repartition(7), monkeypatch)
    assert got == {**{k: k % 5 for k in range(405)}, **{s * k: -k for k in range(1000, 1100) for s in (1, -1)}}
    assert (len(written) == 1) == (at_once == 500)
