"""Written steps go when the result that needed them is written."""

import os

import pytest

from tablework.session import pin, pin_result, shared_folder


def _folders(spark):
    root = shared_folder(spark).removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith("tablework-")}


def test_steps_are_deleted_and_results_stay(spark):
    before = _folders(spark)

    def inner():
        one = pin(spark.range(10), "one")
        return one.join(pin(one.filter("id > 4"), "two"), "id")

    def outer():
        return pin_result(spark, inner, "inner").filter("id > 6")

    kept = pin(spark.range(3), "kept")
    out = pin_result(spark, outer, "outer")
    assert sorted(r["id"] for r in out.collect()) == [7, 8, 9] and kept.count() == 3
    assert sorted(f.split("-")[1] for f in _folders(spark) - before) == ["kept", "outer"]


def test_steps_of_a_failed_build_are_not_mistaken_for_later_ones(spark):
    with pytest.raises(ZeroDivisionError):
        pin_result(spark, lambda: 1 // 0, "never")
    assert pin(spark.range(2), "after").count() == 2
