"""Code ranking and quality rules on a hand-made delivery."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.codes import extracted_codes, has_shape, packed_codes
from tablework.operators.counts import (
    entities_with_codes, null_safe_extremes, schema_report, text_widths, top_codes, valid_code_counts,
)
from tablework.operators.quality import claim_rules, failing_rows, findings, invalid_codes, report, schema_check, with_days

SCHEMA = (
    "patient_id string, claim_id string, diagnosis_codes string, procedure_code int, date_service string, "
    "date_received string"
)
ROWS = [
    ("p1", "1", "E11.9^I10", 100, "2020-01-01", "2020-01-05"),
    ("p2", None, "S72.001A", 100, "2020-01-01", "2020-01-05"),
    ("p3", "3", "", 200, "2021/31/12", "2020-01-05"),
    ("p4", "4", "e11", None, "2021-02-31", "2021-03-01"),
    ("p5", "5", "I10", 999, "2050-01-01", "2020-01-05"),
    ("p6", "x", None, 100, "2020-05-05", "2020-05-05"),
]


@pytest.fixture
def claims(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def valid(spark):
    return spark.createDataFrame([(100,), (200,), (200,)], "code int")


def test_extracted_codes_lose_dots_and_suffix(claims):
    out = sorted((r["patient_id"], r["entry"], r["code"]) for r in extracted_codes(claims, "patient_id", "diagnosis_codes").collect())
    assert out == [("p1", 0, "E119"), ("p1", 1, "I10"), ("p2", 0, "S72001"), ("p5", 0, "I10")]


def test_packed_codes_skip_empty_members(spark):
    df = spark.createDataFrame([(1, "a^^b"), (2, ""), (3, None)], "id int, c string")
    assert sorted((r["id"], r["entry"], r["code"]) for r in packed_codes(df, "id", "c").collect()) == [(1, 0, "a"), (1, 2, "b")]


def test_codes_listed_twice_count_twice(claims, valid):
    counts = valid_code_counts(claims, "procedure_code", valid, "code")
    assert {r["code"]: r["n"] for r in counts.collect()} == {"100": 3, "200": 2}


def test_ties_at_the_end_of_the_top_list(spark):
    counts = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "code string, n long")
    assert [r["code"] for r in top_codes(counts, 2).collect()] == ["c", "a"]


def test_entities_of_top_codes(claims, valid):
    top = top_codes(valid_code_counts(claims, "procedure_code", valid, "code"), 1)
    assert entities_with_codes(claims, "patient_id", "procedure_code", top).first()["n_entities"] == 3


def test_null_code_is_invalid(claims, valid):
    out = invalid_codes(claims, "procedure_code", valid, "code")
    assert sorted(r["patient_id"] for r in out.collect()) == ["p4", "p5"]


def test_all_rules_in_one_report(claims, valid):
    dated = with_days(claims, "date_service", "date_received")
    rules = claim_rules(F.lit("2022-01-01").cast("date"))
    rows = failing_rows(dated, "patient_id", rules)
    unknown = findings(invalid_codes(claims, "procedure_code", valid, "code"), "procedure_code_valid", "patient_id", "procedure_code")
    out = sorted((r["rule"], r["row_id"]) for r in report(rows, unknown).collect())
    assert out == sorted([
        ("claim_id_present", "p2"),
        ("diagnosis_shape", "p3"), ("diagnosis_shape", "p4"), ("diagnosis_shape", "p6"),
        ("date_service_format", "p3"),
        ("date_service_calendar", "p4"),
        ("date_service_before_now", "p5"),
        ("date_service_after_date_received", "p5"),
        ("procedure_code_valid", "p4"), ("procedure_code_valid", "p5"),
    ])


def test_shape_is_false_for_null(spark):
    df = spark.createDataFrame([("A12",), (None,)], "c string").select(has_shape("c", r"[A-Z]\d{2}").alias("ok"))
    assert [r["ok"] for r in df.collect()] == [True, False]


def test_declared_schema(claims):
    declared = T.StructType([
        T.StructField("claim_id", T.IntegerType(), False),
        T.StructField("diagnosis_codes", T.StringType(), True),
        T.StructField("date_service", T.DateType(), False),
    ])
    out = {r["column_name"]: (r["n_bad_type"], r["n_bad_null"]) for r in schema_check(claims, declared).collect()}
    assert out == {"claim_id": (1, 1), "diagnosis_codes": (0, 0), "date_service": (2, 0)}


def test_profiles(claims):
    widths = {r["column_name"]: r["max_length"] for r in text_widths(claims, ["diagnosis_codes", "procedure_code"]).collect()}
    assert widths == {"diagnosis_codes": 9, "procedure_code": 3}
    shape = {r["column_name"]: (r["column_type"], r["n_rows"], r["n_present"]) for r in schema_report(claims).collect()}
    assert shape["procedure_code"] == ("int", 6, 5) and len(shape) == 6
    extremes = null_safe_extremes(claims.withColumn("one", F.lit(1)), ["procedure_code", "one"]).collect()
    assert [tuple(r) for r in extremes] == [("procedure_code", None, None), ("one", 1.0, 1.0)]
