import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.streaming.keyed import LatestImage, OncePerKey


@pytest.mark.parametrize("cuts", [(0, 3), (0, 1, 3), (0, 1, 2, 3), (0, 2, 3)])
def test_same_records_however_batches_are_cut(spark, tmp_path, cuts):
    schema = "id string, ts timestamp_ntz"
    rows = [("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 2)), ("a", dt.datetime(2024, 1, 1))]
    sink = OncePerKey(spark, str(tmp_path / "out"), schema, ["id"], "ts")
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        sink.absorb(spark.createDataFrame(rows[a:b], schema), k)
    assert sorted(r.ts.day for r in sink.read().collect()) == [1, 2]


def test_later_batches_list_no_more_than_earlier_ones(spark, tmp_path):
    """Each batch has records of its own day and of the day before."""
    schema = "id string, ts timestamp_ntz"
    sink = OncePerKey(spark, str(tmp_path / "out"), schema, ["id"], "ts")
    listed = []
    for k in range(12):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
        rows = [(f"{k}", day), ("x", day), (f"{k - 1}", day - dt.timedelta(days=1))]
        sink.absorb(spark.createDataFrame(rows, schema), k)
        met = [p for p in (tmp_path / "out").glob("day=*") if p.name[4:] in {f"{r[1]:%Y-%m-%d}" for r in rows}]
        listed.append(sum(1 for p in met for _ in p.glob("batch_id=*/*.parquet")))
    assert max(listed[3:]) <= 4
    got = [(r.id, r.ts.day) for r in sink.read().collect()]
    assert len(got) == len(set(got)) == 25  # twelve ids, x on twelve days, and -1 of the day before the first


def test_image_stays_short(spark, tmp_path):
    schema = T.StructType().add("k", T.LongType()).add("v", T.LongType())
    image = LatestImage(spark, str(tmp_path / "log"), schema, ["k"], [F.desc("v")], longest=3)
    assert image.read().count() == 0
    most = 0
    for n in range(11):
        for _ in range(2):  # every batch is handled again
            image.absorb(spark.createDataFrame([(n % 4, n), (100, n)], schema), n)
        most = max(most, len([p for p in (tmp_path / "log").iterdir() if p.is_dir()]))
    assert most <= 4
    image.absorb(spark.createDataFrame([(0, -1)], schema), 0)  # long since in the image
    assert sorted(map(tuple, image.read().collect())) == [(0, 8), (1, 9), (2, 10), (3, 7), (100, 10)]


def test_image_that_was_not_completed_is_no_image(spark, tmp_path):
    schema = T.StructType().add("k", T.LongType()).add("v", T.LongType())
    image = LatestImage(spark, str(tmp_path / "log"), schema, ["k"], [F.desc("v")])
    image.absorb(spark.createDataFrame([(1, 1)], schema), 0)
    (tmp_path / "log" / "image_0").mkdir()
    assert [tuple(r) for r in image.read().collect()] == [(1, 1)]
    image.shorten()
    assert [tuple(r) for r in image.read().collect()] == [(1, 1)]
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["image_0"]
