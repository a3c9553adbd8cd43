"""Newest rows, merges, months and deliveries on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from tablework.functions.dates import rejected, to_date_or_null, to_timestamp_or_null
from tablework.operators.latest import duplicated_keys, latest_per_key, merge_keep_last, open_first, upsert
from tablework.operators.months import missing_deliveries, monthly_activity
from tablework.plans.postings import join_postings
from tablework.session import scratch
from tablework.sinks.tables import VersionedTable

POSTING = "job_id long, post_date timestamp, salary int, remove_date timestamp"


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


def test_one_posting_over_five_months(spark):
    rows = [(1, ts("2020-01-15"), 100_000, ts("2020-05-02"))]
    out = {r["month"]: r for r in monthly_activity(spark.createDataFrame(rows, POSTING), "2019-12-01", "2020-06-01").collect()}
    assert len(out) == 7
    assert out["2020-01"]["count_new"] == 1 and out["2020-05"]["count_removed"] == 1
    active = [m for m, r in out.items() if r["count_active"]]
    assert sorted(active) == ["2020-01", "2020-02", "2020-03", "2020-04", "2020-05"]
    assert out["2020-03"]["salary_active"] == 100_000 and out["2020-03"]["salary_new"] == 0
    assert out["2019-12"]["count_active"] == 0 and out["2020-06"]["salary_sum_removed"] == 0


def test_open_reversed_and_unpaid_postings(spark):
    rows = [
        (1, ts("2020-02-01"), 10, None),  # open: active to the as-of month
        (2, ts("2020-04-01"), 20, ts("2020-03-01")),  # removed before it was posted: new and removed, never active
        (3, ts("2020-02-09"), None, ts("2020-02-20")),  # no salary: counted, left out of the average
    ]
    df = monthly_activity(spark.createDataFrame(rows, POSTING), "2020-02-01", "2020-04-01", as_of="2020-03-31")
    out = {r["month"]: r for r in df.collect()}
    assert [out[m]["count_active"] for m in ("2020-02", "2020-03", "2020-04")] == [2, 1, 0]
    assert out["2020-04"]["count_new"] == 1 and out["2020-03"]["count_removed"] == 1
    assert out["2020-02"]["salary_new"] == 10 and out["2020-02"]["count_new"] == 2


def test_open_posting_wins_over_dated_one(spark):
    rows = [(1, ts("2020-01-01"), 1, ts("2020-05-01")), (1, ts("2020-01-01"), 2, None), (2, ts("2020-01-01"), 3, ts("2020-02-01"))]
    out = latest_per_key(spark.createDataFrame(rows, POSTING), ["job_id"], open_first("remove_date", "salary"))
    assert sorted((r["job_id"], r["salary"]) for r in out.collect()) == [(1, 2), (2, 3)]


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, ts("2020-01-01"), 1, None)], POSTING)
    plan = latest_per_key(df, ["job_id"], open_first("remove_date"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_postings_from_text_tables(spark):
    master = spark.createDataFrame(
        [(1, "a", "2020-01-01 00:00:00", 5, "x"), (2, "b", "not a date", 6, "y"), (3, "c", "2020-02-01 10:00:00", 7, "z"),
         (3, "c", "2020-02-01 10:00:00", 7, "z")],
        "job_id long, company string, post_date string, salary int, city string",
    )
    title = spark.createDataFrame([(1, "t1"), (3, "t3"), (3, "t3")], "job_id long, title string")
    log = spark.createDataFrame(
        [(1, "2020-03-01 00:00:00"), (1, "soon"), (2, "soon"), (3, "2020-04-01 00:00:00"), (3, None)],
        "job_id long, remove_date string",
    )
    out = {r["job_id"]: r for r in join_postings(master, title, log).collect()}
    assert len(out) == 3
    assert out[1]["remove_date"] == ts("2020-03-01") and out[2]["title"] is None
    assert out[2]["post_date"] is None and out[3]["remove_date"] is None and out[3]["title"] == "t3"
    assert [(out[k]["is_open"], out[k]["rejected_dates"]) for k in (1, 2, 3)] == [(False, 1), (False, 2), (True, 0)]
    parsed = master.withColumn("p", to_timestamp_or_null("post_date"))
    assert parsed.agg(rejected("post_date", "p").alias("n")).first()["n"] == 1


def test_dates_from_text(spark):
    texts = ["2021-02-28", "2021-02-31", "2021-2-3", "2021", None, "2021-01-01T00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_date_or_null("t").alias("d"))
    assert [r["d"] for r in df.collect()] == [dt.date(2021, 2, 28), None, None, None, None, None]
    other = spark.createDataFrame([("2021/31/12",)], "t string").select(to_date_or_null("t", "yyyy/dd/MM").alias("d"))
    assert other.first()["d"] == dt.date(2021, 12, 31)


def test_upsert_replaces_whole_rows(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, upsert(cur, new, ["k"]).collect()), key=str) == [(1, "a"), (2, None), (3, "c")]
    assert duplicated_keys(upsert(cur, new, ["k"]), ["k"]).count() == 0


def test_merge_keeps_the_last_arrival(spark):
    table = spark.createDataFrame([(1, "old"), (2, "old")], "id int, title string")
    one = spark.createDataFrame([(1, "first", 5, 1), (1, "second", 6, 2)], "id int, title string, servings int, place int")
    out = merge_keep_last([table, one], ["id"], [F.desc("place")]).drop("place")
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "second", 6), (2, "old", None)]


def test_missing_deliveries(spark):
    present = spark.createDataFrame([("20200406",), ("20200420",), ("20200420",)], "delivery string")
    out = missing_deliveries(present, "2020-04-06", "2020-05-04")
    assert sorted(r["delivery"] for r in out.collect()) == ["20200413", "20200427"]


def test_table_versions(spark):
    path = scratch(spark, "versions")
    spark.sql(f"CREATE DATABASE versions_test LOCATION '{path}'")
    table = VersionedTable(spark, "versions_test.t", path)
    assert not table.exists()
    table.replace(spark.range(3), "v1")
    table.replace(table.read().filter("id > 0"), "v2")
    assert table.read().count() == 2 and table.previous().count() == 3
