"""A task in which signatures meet needs a small part of its entries' bytes beside them, and loses no signature."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tablework.llm import linking
from tablework.llm.linking import ABOUT

SETS, SIGNATURES = 60_000, 16


class _Rows:
    """Takes the functions that a frame would hand to the tasks."""

    def mapInArrow(self, run, schema):
        self.sign = run
        return self

    def groupBy(self, column):
        return self

    def applyInArrow(self, run, schema):
        self.meet = run
        return self

    def applyInPandas(self, run, schema):
        self.meet = lambda table: pa.Table.from_pandas(run(table.to_pandas()))
        return self


def _signer(batch):
    """Every set shares its first signature with one other, and has the rest for itself."""
    ids = batch.column(0).to_numpy().view(np.uint64)
    owner = np.repeat(np.arange(len(ids)), SIGNATURES)
    some = linking.mix(ids[owner] * np.uint64(SIGNATURES) + np.tile(np.arange(SIGNATURES, dtype=np.uint64), len(ids)))
    some[::SIGNATURES] = linking.mix(ids >> np.uint64(1) | np.uint64(1 << 63))
    about = np.zeros(len(ids), ABOUT)
    about["n"] = 10
    return ids, owner, some, about


def _met(monkeypatch, near):
    monkeypatch.setattr(linking.TaskContext, "get", lambda: type("Context", (), {"partitionId": lambda self: 0})())
    rows = _Rows()
    signer = _signer if near else lambda batch: _signer(batch)[:3]
    linking.shared_signatures(rows, signer, 0, near)
    # sets that share a signature are in different batches
    order = np.concatenate([np.arange(0, SETS, 2), np.arange(1, SETS, 2)])
    batches = [pa.RecordBatch.from_arrays([pa.array(order[k:k + 5000])], ["id"]) for k in range(0, SETS, 5000)]
    table = pa.Table.from_batches(list(rows.sign(iter(batches))))
    tracemalloc.start()
    try:
        found = rows.meet(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    stars = set(zip(found["least"].to_pylist(), found["id"].to_pylist()))
    assert stars == {(k, k + 1) for k in range(0, SETS, 2)}
    return peak / table.nbytes


def test_signatures_told_apart_meet_in_little_memory(monkeypatch):
    assert _met(monkeypatch, lambda a, b: np.ones(max(len(a), len(b)), bool)) < 3


def test_signatures_meet_in_little_memory(monkeypatch):
    assert _met(monkeypatch, None) < 3
