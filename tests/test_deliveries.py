"""Types from values, lines left out by position, every error with its row, and copies of few rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.codes import extracted_codes
from tablework.operators import resample
from tablework.operators.quality import error_list, numbered, schema_rules
from tablework.plans.registry import QUERIES
from tablework.sources.files import infer_csv, infer_types, read_routed


def test_types_follow_from_all_values(spark):
    rows = [
        ("1", "1", "1.5", "2024-02-29", "true", "2024-01-01 10:00:00", None, "007", "5"),
        (None, " 2 ", "-2", "", "FALSE", "2024-01-01T10:00", " ", "12", "2024-01-01"),
        ("-3", "3000000000", "1e3", None, None, None, None, "x", "5"),
    ]
    names = ["gaps", "big", "number", "day", "flag", "time", "none", "text", "mixed"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    types = {f.name: f.dataType.simpleString() for f in infer_types(df)}
    assert types == {
        "gaps": "int", "big": "bigint", "number": "double", "day": "date", "flag": "boolean", "time": "timestamp",
        "none": "string", "text": "string", "mixed": "string"}
    wrong = spark.createDataFrame([("2024-02-30", "99999999999999999999")], "day string, huge string")
    assert {f.name: f.dataType.simpleString() for f in infer_types(wrong)} == {"day": "string", "huge": "double"}
    assert {f.dataType.simpleString() for f in infer_types(df.limit(0))} == {"string"}


def test_typed_csv_keeps_every_value(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a.b,c\n1,x\n,\n 3 ,007\n")
    rows = infer_csv(spark, str(tmp_path / "d.csv"))
    assert dict(rows.dtypes) == {"a.b": "int", "c": "string"}
    assert sorted(map(tuple, rows.collect()), key=repr) == [(1, "x"), (3, "007"), (None, None)]


def test_lines_equal_to_a_header_are_data(spark, tmp_path):
    for name in ("master_0", "master_1"):
        (tmp_path / f"{name}.csv").write_text("id,n\n1,2\nid,n\n")
    lines = read_routed(spark, str(tmp_path), {"master": "m"}, header=True)
    assert sorted(r["value"] for r in lines.collect()) == ["1,2", "1,2", "id,n", "id,n"]
    assert {r["table_name"] for r in lines.collect()} == {"m"}


def test_rows_without_a_role_and_odd_states_come_through(spark, tmp_path):
    rows = [(1, 0, None, "a"), (1, 1, "user", "b"), (2, 0, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    orders = [(1, 1, "PX", 1.0), (2, 1, "P", 2.0), (3, 1, "F", 3.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(
        f"{tmp_path}/orders.parquet")
    for name in ("json_roundtrip", "json_files"):
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(r["o_orderkey"] for r in QUERIES["manifest_load"](spark, str(tmp_path)).collect()) == [1, 3]


def test_every_error_names_its_row(spark):
    rows = [("1", "10", "A01"), ("x", "10", "B2"), (None, "-", "A01^C03"), ("1", None, None), (None, "11", "A01")]
    delivery = numbered(
        spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "line int, id string, price string, codes string"), ["line"])
    declared = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.IntegerType())])
    valid = spark.createDataFrame([("A01",)], "code string")
    found = error_list(
        delivery, declared, {"price_positive": (F.col("price").try_cast("int") > 0, "price")},
        {"code_valid": (extracted_codes(delivery, "row", "codes"), valid)}, ["id"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        ("id_type", 1, "x"), ("id_present", 2, None), ("id_present", 4, None), ("price_type", 2, "-"),
        ("price_positive", 2, "-"), ("price_positive", 3, None), ("code_valid", 2, "C03"),
        ("id_unique", 0, "1"), ("id_unique", 3, "1")], key=repr)
    assert set(schema_rules(declared)) == {"id_type", "id_present", "price_type"}


@pytest.mark.parametrize("most", [1, 50])
def test_copies_are_numbered_from_one(spark, monkeypatch, most):
    monkeypatch.setattr(resample, "COPIES", 7)
    rows = spark.createDataFrame([(1, 1), (2, 20), (3, 14), (4, 50)], "id int, _copies long").filter(F.col("_copies") <= 50 if most == 50 else F.lit(True))
    got = {}
    for r in resample.numbered_copies(rows, most, ["id"]).collect():
        got.setdefault(r["id"], []).append(r["copy"])
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in ((1, 1), (2, 20), (3, 14), (4, 50))}


def test_copies_of_one_row_are_made_in_many_tasks(many_partitions):
    spark = many_partitions
    rows = spark.range(200_000).select(
        F.col("id"), (F.col("id") == 0).cast("int").alias("rare"), (F.col("id") % 7).cast("double").alias("x"))
    grown = resample.oversample(rows, id_col="id", label="rare", numeric=["x"]).filter("synthetic")
    tasks = grown.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 199_998
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 60_000
