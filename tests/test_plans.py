"""What the plans must not contain, and what must reach the scans."""

import re

import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
# queries that end in reading back what they wrote, or that fit models: their last plan is only a scan
STORED = {n for n in QUERIES if n.startswith("stream_") or n.endswith("_roundtrip")} | {
    "cross_validate", "residual_stack", "blend", "mlp_classify", "batch_score", "lake_select", "manifest_load",
    "ingest_partitions", "upsert", "catalog_tables", "route_by_file",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_pairs_and_no_row_functions(spark, name):
    """No cross join, no nested-loop join, no row-at-a-time Python, even where nothing may be broadcast by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def read_schemas(text):
    return re.findall(r"(\w+)\.parquet\], PartitionFilters.*?ReadSchema: struct<(.*?)>", text)


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("monthly_activity", "lineitem", "l_orderkey:bigint,l_shipdate:timestamp_ntz"),
        ("monthly_activity", "orders", "o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"),
        ("top_valid_codes", "lineitem", "l_partkey:bigint"),
        ("dq_unique", "lineitem", "l_orderkey:bigint,l_linenumber:int"),
        ("class_balance", "labels", "quality:int"),
        ("string_profile", "customer", "c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string"),
    ],
)
def test_only_needed_columns_are_read(spark, name, table, columns):
    assert (table, columns) in read_schemas(plan(QUERIES[name](spark, FOLDER)))


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["top_valid_codes"](spark, FOLDER))
    assert "LessThanOrEqual(p_size,25)" in text


@pytest.mark.parametrize("name", ["latest_per_key", "merge_keep_last", "stream_upsert"])
def test_newest_rows_are_cut_on_both_sides_of_the_shuffle(spark, name):
    assert plan(QUERIES[name](spark, FOLDER)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name", ["text_features", "apply_mapping", "nested_sets", "relationalize", "attribute_encode", "json_field"]
)
def test_row_work_needs_no_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, FOLDER))
