"""Micro-batches, restarts, replays, keys and zones on small files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.sinks.tables import VersionedTable
from tablework.sources.tables import create_database
from tablework.streaming.ingest import enrich_posts, file_stream, ingest, run_batches
from tablework.streaming.keyed import LatestImage, OncePerKey, cursor
from tablework.streaming.zones import merge_zone, run_zone

POSTS = (
    "subreddit string, title string, selftext string, upvote_ratio double, ups double, downs double, score double, "
    "created_utc string, id string, kind string"
)


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))


def test_posts_are_enriched_and_partitioned(spark, tmp_path):
    rows = [
        ("s", "Python python", "PYTHONIC", 0.9, 3.9, 0.0, 1e12, "2020-01-01T00:00:00Z", "a", "t3"),
        ("s", None, "", 0.9, 1.0, 0.0, 2.5, "2020-01-01T00:00:00Z", "b", "t3"),
    ]
    land(spark, tmp_path / "in", rows, POSTS)
    ingest(file_stream(spark, str(tmp_path / "in"), POSTS), enrich_posts, str(tmp_path / "out"), str(tmp_path / "cp"))
    out = {r["id"]: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert out["a"]["python_mentions"] == 3 and out["a"]["ups"] == 3 and out["a"]["score"] is None
    assert out["b"]["python_mentions"] == 0 and out["b"]["title_length"] is None
    assert out["a"]["ingest_year"] >= 2024 and 0 <= out["a"]["ingest_hour"] < 24


def test_empty_input_writes_nothing(spark, tmp_path):
    land(spark, tmp_path / "in", [], "id int")
    seen = []
    run_batches(file_stream(spark, str(tmp_path / "in"), "id int"), lambda f, b: seen.append(b), str(tmp_path / "cp"))
    assert seen == [] and not (tmp_path / "out").exists()


def test_failed_batch_is_replayed_without_duplicates(spark, tmp_path):
    land(spark, tmp_path / "in", [(i,) for i in range(10)], "id int")
    failures = ["first try"]

    def transform(frame):
        return frame.withColumn("x", F.col("id") * 2)

    def handle(frame, batch_id):
        from tablework.sinks.files import write_batch

        write_batch(transform(frame), str(tmp_path / "out"), batch_id)
        if failures:
            raise RuntimeError(failures.pop())

    stream = lambda: file_stream(spark, str(tmp_path / "in"), "id int")
    with pytest.raises(Exception, match="first try"):
        run_batches(stream(), handle, str(tmp_path / "cp"))
    run_batches(stream(), handle, str(tmp_path / "cp"))
    run_batches(stream(), handle, str(tmp_path / "cp"))
    assert spark.read.json(str(tmp_path / "out")).count() == 10


def test_each_key_once_over_restarts(spark, tmp_path):
    schema = "id string, ts timestamp_ntz"
    first = [(str(i), dt.datetime(2024, 1, 1, i)) for i in range(5)]

    sink = OncePerKey(spark, str(tmp_path / "out"), schema, ["id"], "ts")

    def run():
        sink.run(file_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "cp"))

    land(spark, tmp_path / "in", first + first[:2], schema)
    run()
    late, unknown = ("8", dt.datetime(2020, 1, 1)), ("7", None)
    land(spark, tmp_path / "in", first + [("9", dt.datetime(2024, 1, 2)), late, unknown], schema)
    run()
    land(spark, tmp_path / "in", [late, unknown], schema)
    run()
    assert sorted(r["id"] for r in sink.read().collect()) == ["0", "1", "2", "3", "4", "7", "8", "9"]
    sink.absorb(spark.createDataFrame([late], schema), 7)
    sink.absorb(spark.createDataFrame([("6", late[1])], schema), 8)
    sink.absorb(spark.createDataFrame([("6", late[1])], schema), 8)  # a replay
    out = sink.read().filter("id not in ('6', '7', '8')")
    assert sink.read().count() == 9
    named = out.withColumn("kind", F.lit("t3"))
    assert cursor(named, "kind", "id", "ts").first()["cursor"] == "t3_9"
    assert cursor(named.limit(0), "kind", "id", "ts", previous="t3_9").first()["cursor"] == "t3_9"


def test_latest_image_and_compaction(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.LongType()), T.StructField("v", T.StringType())])
    image = LatestImage(spark, str(tmp_path / "log"), schema, ["k"], [F.desc("t")])
    image.absorb(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], schema), 0)
    image.absorb(spark.createDataFrame([(1, 0, "late")], schema), 1)  # a later batch wins entirely
    image.absorb(spark.createDataFrame([(1, 0, "late")], schema), 1)  # replay
    rows = sorted(map(tuple, image.read().collect()))
    assert rows == [(1, 0, "late"), (2, 1, "c")]
    assert sorted(map(tuple, image.compact(str(tmp_path / "one")).collect())) == rows


def test_zones_with_archive_and_merge(spark, tmp_path):
    schema = "id long, title string, place long"
    table = VersionedTable(spark, create_database(spark, "zones_test", str(tmp_path / "db")) + ".recipe", str(tmp_path / "t"))
    for turn, rows in enumerate([[(1, "old", 0), (2, "two", 1)], [(1, "mid", 0), (1, "new", 1)]]):
        land(spark, tmp_path / "raw", rows, schema)
        run_zone(spark, str(tmp_path / "raw"), schema, str(tmp_path / "stage"), str(tmp_path / "cp1"), lambda f: f,
                 archive=str(tmp_path / "archive"))
        merge_zone(spark, str(tmp_path / "stage" / "*"), schema, table, str(tmp_path / "cp2"), ["id"], [F.desc("place")])
    assert {r["id"]: r["title"] for r in table.read().collect()} == {1: "new", 2: "two"}
    assert {r["id"]: r["title"] for r in table.previous().collect()} == {1: "old", 2: "two"}


def test_stored_model_scores_a_stream(spark, tmp_path):
    from tablework.models import training
    from tablework.models.group_mean import GroupMeanRegressor

    train = spark.range(200).selectExpr("id", "double(id % 20) AS a", "double(id % 20 > 9) AS y", "id % 3 AS g")
    model = training.train_and_store(train, [*training.feature_stages(["a"]), training.logistic("y")], str(tmp_path / "m"))
    means = GroupMeanRegressor(groupCol="g", labelCol="y", predictionCol="mean").fit(train)
    train.withColumn("a", F.when(F.col("id") > 4, F.col("a"))).write.json(str(tmp_path / "in"))
    scored, rejected = training.score(model, file_stream(spark, str(tmp_path / "in"), train.schema), ["a"])
    for name, part in (("scored", means.transform(scored).select("id", "y", "prediction", "mean")), ("rejected", rejected)):
        q = part.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        q.trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "scored"))
    assert out.count() == 195 and out.filter("y = prediction").count() > 180 and out.filter("mean is null").count() == 0
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 5


def test_interval_trigger_keeps_running(spark, tmp_path):
    land(spark, tmp_path / "in", [(1,)], "id int")
    got = []
    query = run_batches(file_stream(spark, str(tmp_path / "in"), "id int"),
                        lambda frame, batch: got.extend(r["id"] for r in frame.collect()), str(tmp_path / "cp"),
                        every="1 second")
    query.processAllAvailable()
    land(spark, tmp_path / "in", [(2,)], "id int")
    query.processAllAvailable()
    query.stop()
    assert got == [1, 2]
