"""Records landed as arrays: whole, and in few files."""

from pathlib import Path

from pyspark.sql import functions as F

from tablework.plans.recipes import _land_arrays
from tablework.sources.files import read_json


def test_arrays_are_few_and_hold_all_records(spark, tmp_path):
    rows = spark.range(45_000).select("id", F.concat(F.lit("t "), F.col("id")).alias("title")).coalesce(1)
    _land_arrays(rows, str(tmp_path / "a"))
    assert len(list(Path(tmp_path / "a").rglob("*.txt"))) == 3
    found = read_json(spark, str(tmp_path / "a" / "*"), "id long, title string", whole_file=True)
    assert found.count() == 45_000 and found.exceptAll(rows).isEmpty()


def test_arrays_of_a_given_length(spark, tmp_path):
    rows = spark.range(1, 8).coalesce(1)
    _land_arrays(rows, str(tmp_path / "b"), per_file=3)
    assert len(list(Path(tmp_path / "b").rglob("*.txt"))) == 3
    found = read_json(spark, str(tmp_path / "b" / "*"), "id long", whole_file=True)
    assert sorted(r["id"] for r in found.collect()) == [*range(1, 8)]
