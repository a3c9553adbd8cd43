"""Tables in buckets, owners and their links, and the sink that registers partitions and logs other layouts."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.streaming.linked import BucketedTable, OwnedLists
from tablework.streaming.registered import RegisteringSink

RECIPE = T.StructType().add("id", T.LongType()).add("title", T.StringType()).add("seen", T.IntegerType())
USER = T.StructType().add("name", T.StringType()).add("recipes", T.ArrayType(T.LongType()))


def files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith("parquet"))
            for d in os.listdir(path) if d.startswith("bucket=")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), RECIPE, ["id"], 16)
    assert table.read().count() == 0
    table.merge(spark.range(400).select("id", F.lit("old").alias("title"), F.lit(0).alias("seen")), "b0")
    before = files(tmp_path / "t")
    table.merge(spark.createDataFrame([(7, "new", 1), (7, "newest", 2), (1000, "more", 1)], RECIPE), "b1", [F.desc("seen")])
    after = files(tmp_path / "t")
    changed = {b for b in after if before.get(b) != after[b]}
    assert 1 <= len(changed) <= 2 and len(before) == 16
    rows = {r["id"]: r["title"] for r in table.read().collect()}
    assert len(rows) == table.read().count() == 401 and rows[7] == "newest" and rows[1000] == "more" and rows[8] == "old"


def test_merge_that_broke_off_is_finished_from_what_it_staged(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path / "t"), RECIPE, ["id"], 4)
    table.merge(spark.createDataFrame([(k, "old", 0) for k in range(40)], RECIPE), "b0")
    batch = spark.createDataFrame([(3, "new", 1)], RECIPE)
    staged = table.stage(batch, "b1")
    # the folder is gone, and the new one not yet there: what a process that dies in between leaves
    bucket = staged.first()["bucket"]
    for f in os.listdir(tmp_path / "t" / f"bucket={bucket}"):
        os.unlink(tmp_path / "t" / f"bucket={bucket}" / f)
    table.merge(batch, "b1")
    rows = {r["id"]: r["title"] for r in table.read().collect()}
    assert len(rows) == 40 and rows[3] == "new"
    assert not os.path.exists(tmp_path / "t-staged" / "b1")


def test_null_keys_and_replays(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), RECIPE, ["id"], 4)
    batch = spark.createDataFrame([(None, "none", 0), (1, "one", 0)], RECIPE)
    for name in ("b0", "b0", "b1"):
        table.merge(batch, name)
    assert sorted(r["title"] for r in table.read().collect()) == ["none", "one"]


def test_links_are_those_of_the_last_list(spark, tmp_path):
    owned = OwnedLists(spark, str(tmp_path / "o"), USER, "name", "recipes", "recipe", 4)
    owned.merge(spark.createDataFrame([("a", [1, 2, 2]), ("b", [2]), ("c", None), ("d", [])], USER), "b0")
    links = lambda: sorted(map(tuple, owned.links.read().collect()))
    assert links() == [("a", 1), ("a", 2), ("b", 2)]
    owned.merge(spark.createDataFrame([("a", [3]), ("b", []), ("c", [9])], USER), "b1")
    assert links() == [("a", 3), ("c", 9)]
    owned.merge(spark.createDataFrame([("a", []), ("c", [])], USER), "b2")  # every bucket of the links is empty now
    assert links() == [] and owned.owners.read().count() == 4


@pytest.fixture
def sink(spark, tmp_path):
    schema = T.StructType.fromDDL("id long, value double, day string")
    name = f"registered_{abs(hash(str(tmp_path)))}"
    yield RegisteringSink(spark, name, str(tmp_path / "t"), schema, ["day"], str(tmp_path / "log"))
    spark.sql(f"DROP TABLE {name}")


def test_batches_are_registered_once(spark, sink):
    one = spark.createDataFrame([(1, 1.0, "2024-01-01"), (2, 2.0, "it's"), (3, None, None)], sink.schema)
    assert sink.write(one, "s-0") and sink.write(one, "s-0")  # the batch is handled again
    assert sink.write(spark.createDataFrame([(4, 4.0, "2024-01-01")], sink.schema).select("day", "value", "id"), "s-1")
    rows = sorted((r["id"], r["value"], r["day"]) for r in sink.read().collect())
    assert rows == [(1, 1.0, "2024-01-01"), (2, 2.0, "it's"), (3, None, None), (4, 4.0, "2024-01-01")]
    parts = spark.sql(f"SHOW PARTITIONS {sink.name}").collect()
    assert len(parts) == 4


def test_another_layout_is_logged_and_kept_aside(spark, sink, tmp_path):
    good = spark.createDataFrame([(1, 1.0, "x")], sink.schema)
    sink.write(good, "s-0")
    drifted = spark.createDataFrame([(2, "two", 5)], "id long, value string, extra int")
    for _ in range(2):
        assert not sink.write(drifted, "s-1")
    assert sink.read().count() == 1
    assert sorted(map(tuple, sink.drifted().collect()), key=repr) == sorted([
        ("s-1", "value", "double", "string"), ("s-1", "day", "string", None), ("s-1", "extra", None, "int")], key=repr)
    assert spark.read.json(str(tmp_path / "log" / "rows")).count() == 1
