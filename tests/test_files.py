"""Readers and writers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.text import full_name, mentions, with_text_features
from tablework.operators.mapping import apply_mapping, require_schema, to_records
from tablework.sinks.files import land_raw, write_batch
from tablework.sinks.tables import append_to, create_as
from tablework.sources.files import (
    encoding_audit, infer_csv, read_csv, read_json, read_manifest, read_routed, read_split_table, read_titled_csv,
)
from tablework.sources.pages import PAGE_SCHEMA, posts, posts_from_text
from tablework.sources.tables import create_database, list_tables


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_types_and_encoding(spark, tmp_path):
    path = put(tmp_path / "c.csv", "id,city\n1,Zürich\n,Genève\nx,\n", "latin-1")
    rows = read_csv(spark, path, "id int, city string", encoding="ISO-8859-1").collect()
    assert [tuple(r) for r in rows] == [(1, "Zürich"), (None, "Genève"), (None, None)]
    assert dict(infer_csv(spark, put(tmp_path / "d.csv", "a,b\n1,x\n,y\n")).dtypes) == {"a": "int", "b": "string"}


def test_sheet_with_title_line(spark, tmp_path):
    schema = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("default payment next month", T.IntegerType())])
    folder = tmp_path / "sheet"
    put(folder / "a.csv", ",X1\nID,default payment next month\n1,0\n2,1\n")
    put(folder / "b.csv", ",X1\nID,default payment next month\n3,1\n")
    out = read_titled_csv(spark, str(folder), schema)
    assert sorted(map(tuple, out.collect())) == [(1, 0), (2, 1), (3, 1)]


def test_sheet_body_may_repeat_its_head(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    put(tmp_path / "sheet" / "a.csv", "5,1\na,b\n5,1\n7,8\n")
    put(tmp_path / "sheet" / "b.csv", "another title\na,b\n5,1\n")
    out = read_titled_csv(spark, str(tmp_path / "sheet"), schema)
    assert sorted(map(tuple, out.collect())) == [(5, 1), (5, 1), (7, 8)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        put(tmp_path / "long" / "a.csv", "title\na,b\n" + "".join(f"{k},{k}\n" for k in range(3000)))
        assert read_titled_csv(spark, str(tmp_path / "long"), schema).agg({"a": "sum"}).first()[0] == 2999 * 1500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_lines_files_and_arrays(spark, tmp_path):
    with gzip.open(tmp_path / "l.json.gz", "wt") as f:
        f.write('{"id": 1}\n{"id": 2}\n')
    assert read_json(spark, str(tmp_path / "l.json.gz"), "id int").count() == 2
    put(tmp_path / "stage" / "recipe-1.json", '[{"id": 1},\n {"id": 2}]')
    put(tmp_path / "stage" / "recipe-2.json", '[{"id": 3}]')
    put(tmp_path / "stage" / "user-1.json", '{\n "id": 9}')
    recipes = read_json(spark, str(tmp_path / "stage"), "id int", whole_file=True, glob="recipe-*")
    users = read_json(spark, str(tmp_path / "stage"), "id int", whole_file=True, glob="user-*")
    assert sorted(r["id"] for r in recipes.collect()) == [1, 2, 3] and [r["id"] for r in users.collect()] == [9]


def test_manifest(spark, tmp_path):
    a, b = put(tmp_path / "a.csv", "id\n1\n"), put(tmp_path / "b.csv", "id\n2\n")
    c = put(tmp_path / "c.csv", "id\n3\n")
    put(tmp_path / "d.csv", "id\n4\n")
    urls = [(a, "true"), (b, "false"), (c, "false"), (tmp_path / "gone.csv", "false")]
    entries = ", ".join('{"url": "%s", "mandatory": %s}' % u for u in urls)
    manifest = put(tmp_path / "m" / "ok.manifest", '{"entries": [%s]}' % entries)
    assert sorted(r["id"] for r in read_manifest(spark, manifest, "id int").collect()) == [1, 2, 3]
    broken = put(tmp_path / "m" / "bad.manifest", '{"entries": [{"url": "%s", "mandatory": true}]}' % (tmp_path / "no.csv"))
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        read_manifest(spark, broken, "id int").count()


def test_manifest_takes_names_as_they_are(spark, tmp_path):
    names = ["with,comma.csv", "[set].csv", "{a,b}.csv", "star*.csv", "what?.csv", "plain.csv"]
    for k, name in enumerate(names):
        put(tmp_path / "odd" / name, f"id\n{k}\n")
    put(tmp_path / "odd" / "starred.csv", "id\n100\n")
    entries = [{"url": str(tmp_path / "odd" / n), "mandatory": k % 2 == 0} for k, n in enumerate([*names, "gone,too.csv"][:6])]
    entries.append({"url": str(tmp_path / "nowhere" / "x.csv"), "mandatory": False})
    manifest = put(tmp_path / "odd.manifest", json.dumps({"entries": entries}))
    assert sorted(r["id"] for r in read_manifest(spark, manifest, "id int").collect()) == list(range(6))
    empty = put(tmp_path / "none.manifest", '{"entries": []}')
    assert read_manifest(spark, empty, "id int").count() == 0


def test_partitioned_batches_have_few_files(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 8).selectExpr("id", "id % 20 as part")
    write_batch(rows, str(tmp_path / "p"), 0, ["part"], fmt="parquet")
    assert len(list((tmp_path / "p").rglob("part-*.parquet"))) == 20
    assert spark.read.parquet(str(tmp_path / "p")).count() == 5000


def test_empty_files_have_a_verdict(spark, tmp_path):
    put(tmp_path / "v" / "none.txt", "")
    put(tmp_path / "v" / "one.txt", "é")
    out = {r["file_path"].rpartition("/")[2]: r["encoding"] for r in encoding_audit(spark, str(tmp_path / "v")).collect()}
    assert out == {"none.txt": "ascii", "one.txt": "utf-8"}


def test_routing_by_file_name(spark, tmp_path):
    for name in ("master_0_20200406.csv", "titles_0_20200406.csv", "titles_1_20200406.csv", "other.csv", "notes.txt"):
        put(tmp_path / "d" / name, "x\n")
    out = read_routed(spark, str(tmp_path / "d"), {"master": "m", "title": "t"})
    assert sorted((r["table_name"] or "", r["file_name"]) for r in out.collect()) == [
        ("", "other.csv"), ("m", "master_0_20200406.csv"), ("t", "titles_0_20200406.csv"), ("t", "titles_1_20200406.csv"),
    ]
    put(tmp_path / "d" / "titles_0_20200406.csv", "job_id,title\n1,a\n")
    put(tmp_path / "d" / "titles_1_20200406.csv", "job_id,title\n2,b\n")
    assert read_split_table(spark, str(tmp_path / "d"), "titles", "job_id long, title string").count() == 2


def test_encodings(spark, tmp_path):
    put(tmp_path / "e" / "a.txt", "plain\n" * 5000)
    put(tmp_path / "e" / "u.txt", "plain\n" * 5000 + "é\n")  # past any fixed prefix
    put(tmp_path / "e" / "l.txt", "plain\n" * 5000 + "é\n", "latin-1")
    out = {r["file_path"][-5:]: r["encoding"] for r in encoding_audit(spark, str(tmp_path / "e")).collect()}
    assert out == {"a.txt": "ascii", "u.txt": "utf-8", "l.txt": "latin-1"}


def test_batches_replace_their_own_folder(spark, tmp_path):
    for rows in (3, 2):
        write_batch(spark.range(rows), str(tmp_path / "s"), 0)
    write_batch(spark.range(4), str(tmp_path / "s"), 1)
    assert spark.read.json(str(tmp_path / "s")).count() == 6


def test_raw_copy_is_unaltered(spark, tmp_path):
    text = '{"b": 1,  "a": "é \\u00e9"}'
    land_raw(spark.createDataFrame([(0, text)], "batch_id int, value string"), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).first()["value"] == text


def test_schema_drift_is_refused(spark, tmp_path):
    database = create_database(spark, "drift_test", str(tmp_path / "db"))
    name = create_as(spark.range(2), f"{database}.t", str(tmp_path / "t"))
    append_to(spark.range(3), name)
    assert spark.table(name).count() == 5 and [r[0] for r in list_tables(spark, database).collect()] == ["t"]
    with pytest.raises(ValueError, match="schema drift"):
        append_to(spark.range(1).select(F.col("id").cast("string").alias("id")), name)
    with pytest.raises(ValueError, match="schema drift"):
        require_schema(spark.range(1).withColumn("x", F.lit(1)), spark.table(name).schema)


def test_text_measures(spark):
    df = spark.createDataFrame([("Python python", "PYTHONIC"), (None, ""), ("", None)], "title string, selftext string")
    out = with_text_features(df, "title", "selftext", "python", "n").collect()
    assert [(r["title_length"], r["selftext_length"], r["n"]) for r in out] == [(13, 8, 3), (None, 0, 0), (0, None, 0)]
    overlap = spark.createDataFrame([("aaa",)], "c string").select(mentions("c", "aa").alias("n")).first()
    assert overlap["n"] == 1


def test_mapping_truncates_and_rejects(spark):
    df = spark.createDataFrame([(3.9, "a"), (-3.9, "7"), (1e12, None)], "score double, name string")
    out = apply_mapping(df, [("score", "double", "score", "integer"), ("name", "string", "n", "integer")])
    assert [tuple(r) for r in out.collect()] == [(3, None), (-3, 7), (None, None)]


def test_records_and_names(spark):
    df = spark.createDataFrame([("t3", "ab"), ("t3", None)], "kind string, id string")
    assert [r["n"] for r in df.select(full_name("kind", "id").alias("n")).collect()] == ["t3_ab", None]
    rows = to_records(df).collect()
    assert rows[0]["Data"] == '{"kind":"t3","id":"ab"}' and rows[0]["PartitionKey"] != rows[1]["PartitionKey"]


def test_pages(spark):
    page = '{"data": {"children": [{"kind": "t3", "data": {"id": "%s", "title": "x", "created_utc": 1577836800}}]}}'
    df = spark.createDataFrame([(page % "a",), ("<html>",), ('{"data": {"children": []}}',)], "page string")
    good, bad = posts_from_text(df, "page")
    row = good.first()
    assert good.count() == 1 and bad.count() == 1
    assert (row["id"], row["kind"], row["created_utc"]) == ("a", "t3", "2020-01-01T00:00:00Z")
    nameless = spark.read.schema(PAGE_SCHEMA).json(
        spark.sparkContext.parallelize(['{"data": {"children": [{"kind": "t3", "data": {"title": "x"}}]}}'])
    )
    with pytest.raises(Exception, match="post without id"):
        posts(nameless).collect()
