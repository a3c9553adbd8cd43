"""Postings: split deliveries to one table, newest image per key, monthly activity.

Orders stand in for postings: the order is the job, the customer the company, its nation the city, the priority the
title, and the last ship date of its lines the removal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.dates import rejected, to_timestamp_or_null
from tablework.operators.counts import schema_report as report_schema
from tablework.operators.counts import text_widths
from tablework.operators.joins import lookup_join
from tablework.operators.latest import latest_per_key as newest
from tablework.operators.latest import merge_keep_last as merge
from tablework.operators.latest import open_first
from tablework.operators.latest import upsert as replace_by_key
from tablework.operators.months import missing_deliveries as missing
from tablework.operators.months import monthly_activity as activity
from tablework.plans.registry import Tables, query
from tablework.session import scratch
from tablework.sinks.files import append_json, to_parquet
from tablework.sinks.tables import VersionedTable, append_to, bucketed, create_as, join_bucketed
from tablework.sources.files import encoding_audit as audit
from tablework.sources.files import infer_csv, read_csv, read_json, read_manifest, read_routed, read_split_table, read_titled_csv
from tablework.sources.tables import create_database, define_table, list_tables, read_table

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT = "yyyy-MM-dd"


def join_postings(master: DataFrame, title: DataFrame, timelog: DataFrame, *arrival: str) -> DataFrame:
    """Typed postings from the three text tables of a delivery, one row per job.

    Each table is cut to the row that wins for its job before the joins: an open removal over a dated one, then the
    latest; for the others the last by the ``arrival`` columns. So copies of a job neither multiply nor meet in
    one task. Dates that do not parse become null and are counted in ``rejected_dates``; a job whose removals are all
    unreadable has no removal date, but ``is_open`` is false, as only a missing text means open.
    """
    latest = [F.desc(c) for c in arrival]
    ended = timelog.select("job_id", F.col("remove_date").alias("text"), to_timestamp_or_null("remove_date").alias("d"))
    # an open row has no text, so a date stands only where every row of the job has one
    closed = F.count("text") == F.count(F.lit(1))
    one_log = ended.groupBy("job_id").agg(
        F.when(closed, F.max("d")).alias("remove_date"), (~closed).alias("no_end"), rejected("text", "d").alias("bad_ends")
    )
    one_title = newest(title, ["job_id"], [*latest, F.desc("title")]).select("job_id", "title")
    one_master = newest(master, ["job_id"], [*latest, F.desc("post_date")])
    return (
        one_master.join(one_title, "job_id", "left")
        .join(one_log, "job_id", "left")
        .withColumn("posted", to_timestamp_or_null("post_date"))
        .select(
            "job_id", "company", F.col("posted").alias("post_date"), "salary", "city", "title", "remove_date",
            F.coalesce("no_end", F.lit(True)).alias("is_open"),
            (F.coalesce("bad_ends", F.lit(0)) + (F.col("post_date").isNotNull() & F.col("posted").isNull()).cast("long"))
            .alias("rejected_dates"),
        )
    )


def _delivery(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = t.orders.select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("c_custkey"),
        F.date_format("o_orderdate", TIMESTAMP_TEXT).alias("post_date"), F.col("o_totalprice").alias("salary"),
    )
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.col("c_name").alias("company"), F.col("n_name").alias("city")
    )
    master = lookup_join(orders, places, ["c_custkey"], "left").drop("c_custkey")
    title = t.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("title"))
    timelog = t.lineitem.select(
        F.col("l_orderkey").alias("job_id"), F.date_format("l_shipdate", TIMESTAMP_TEXT).alias("remove_date")
    )
    return master, title, timelog


def dated_postings(t: Tables) -> DataFrame:
    """Start, end and amount of each posting, which is all that monthly activity needs."""
    ends = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("remove_date"))
    return t.orders.join(ends, "o_orderkey", "left").select(
        F.col("o_orderdate").alias("post_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("salary"),
        "remove_date",
    )


def _activity_sql() -> str:
    def part(kind: str, source: str) -> str:
        return (
            f"{kind} AS (SELECT strftime(m, '%Y-%m') AS month, count(*) AS n, sum(salary) AS s FROM {source} "
            "WHERE m IS NOT NULL GROUP BY 1)"
        )

    return f"""
    WITH p AS (
      SELECT o_orderdate AS a, e.b, CAST(o_totalprice AS DECIMAL(18,2)) AS salary
      FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS b FROM lineitem GROUP BY 1) e
        ON o_orderkey = l_orderkey),
    {part('new', "(SELECT date_trunc('month', a) AS m, salary FROM p)")},
    {part('removed', "(SELECT date_trunc('month', b) AS m, salary FROM p)")},
    {part('active', "(SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, "
                    "date_trunc('month', coalesce(b, TIMESTAMP '2001-12-01'))::TIMESTAMP, INTERVAL 1 MONTH)) AS m, "
                    "salary FROM p)")},
    spine AS (SELECT strftime(m, '%Y-%m') AS month FROM (SELECT unnest(generate_series(
      TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m))
    SELECT month,
      coalesce(new.n, 0) AS count_new, coalesce(active.n, 0) AS count_active, coalesce(removed.n, 0) AS count_removed,
      coalesce(CAST(new.s AS DOUBLE) / new.n, 0) AS salary_new,
      coalesce(CAST(active.s AS DOUBLE) / active.n, 0) AS salary_active,
      coalesce(CAST(removed.s AS DOUBLE) / removed.n, 0) AS salary_removed,
      coalesce(CAST(new.s AS DOUBLE), 0) AS salary_sum_new,
      coalesce(CAST(active.s AS DOUBLE), 0) AS salary_sum_active,
      coalesce(CAST(removed.s AS DOUBLE), 0) AS salary_sum_removed
    FROM spine LEFT JOIN new USING (month) LEFT JOIN active USING (month) LEFT JOIN removed USING (month)
    ORDER BY month"""


@query(_activity_sql())
def monthly_activity(t: Tables) -> DataFrame:
    return activity(dated_postings(t), "1995-01-01", "2001-12-01").orderBy("month")


@query("""
    SELECT o_orderkey AS job_id, c_name AS company, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS post_date,
           o_totalprice AS salary, n_name AS city, o_orderpriority AS title,
           strftime(e.b, '%Y-%m-%d %H:%M:%S') AS remove_date, l_orderkey IS NULL AS is_open,
           coalesce(bad, 0)::BIGINT AS rejected_dates
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) FILTER (l_orderkey % 7 <> 0 OR l_linenumber > 2) AS b,
                      count(*) FILTER (l_orderkey % 7 = 0 AND l_linenumber <= 2) AS bad FROM lineitem GROUP BY 1) e
      ON o_orderkey = l_orderkey""")
def posting_join(t: Tables) -> DataFrame:
    """Some removal dates can't be read: they are counted, and don't open a posting again."""
    master, title, _ = _delivery(t)
    bad = (F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") <= 2)
    text = F.when(bad, F.lit("soon")).otherwise(F.date_format("l_shipdate", TIMESTAMP_TEXT))
    timelog = t.lineitem.select(F.col("l_orderkey").alias("job_id"), text.alias("remove_date"))
    joined = join_postings(master, title, timelog)
    return joined.withColumns({c: F.date_format(c, TIMESTAMP_TEXT) for c in ("post_date", "remove_date")})


@query("""
    SELECT o_orderstatus, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def bucketed_join(t: Tables) -> DataFrame:
    path = scratch(t.spark, "bucketed")
    database = create_database(t.spark, path.rpartition("/")[2].replace("-", "_"), path)
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice", "l_discount")
    heads = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))  # as many as the cluster uses for any shuffle
    # a small share makes many keys hot on one side and not on the other
    facts = bucketed(lines, f"{database}.lines", f"{path}/lines", "orderkey", buckets, share=0.001)
    lookup = bucketed(heads, f"{database}.heads", f"{path}/heads", "orderkey", buckets)
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return join_bucketed(facts, lookup, "orderkey").groupBy("o_orderstatus").agg(
        F.count("*").alias("n_lines"), F.sum(price).cast("double").alias("revenue")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber DESC,
        l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    order = open_first("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return newest(lines, ["l_orderkey"], order).withColumn("l_shipdate", F.date_format("l_shipdate", DATE_TEXT))


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
      AND o_orderstatus <> 'F'
    UNION ALL
    SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 1.1 FROM orders WHERE o_orderstatus = 'F'""")
def upsert(t: Tables) -> DataFrame:
    """All finished orders arrive again with a new price; the current image lacks the urgent ones."""
    path = scratch(t.spark, "upsert")
    database = create_database(t.spark, path.rpartition("/")[2].replace("-", "_"), path)
    table = VersionedTable(t.spark, f"{database}.posting", path)
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    table.replace(t.orders.filter("o_orderpriority <> '1-URGENT'").select(columns), "first")
    new = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * F.lit(1.1)).alias("o_totalprice")
    )
    return table.replace(replace_by_key(table.read(), new, ["o_orderkey"]), "second")


@query("""
    SELECT conv_id, turn, role, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(role = 'user', FALSE) DESC, turn DESC) AS r
      FROM conversations) WHERE r = 1""")
def merge_keep_last(t: Tables) -> DataFrame:
    """The turns of users arrive after those of all other roles; the last arrival per conversation stays."""
    of_user = F.coalesce(F.col("role") == "user", F.lit(False))
    old, new = t.conversations.filter(~of_user), t.conversations.filter(of_user)
    return merge([old, new], ["conv_id"], [F.desc("turn")]).select("conv_id", "turn", "role", "text")


@query("""
    SELECT strftime(w, '%Y%m%d') AS delivery FROM (
      SELECT unnest(generate_series(TIMESTAMP '1994-01-03', TIMESTAMP '2002-12-23', INTERVAL 7 DAY)) AS w)
    WHERE strftime(w, '%Y%m%d') NOT IN (SELECT strftime(date_trunc('week', o_orderdate), '%Y%m%d') FROM orders)""")
def missing_deliveries(t: Tables) -> DataFrame:
    monday = F.trunc(F.col("o_orderdate").cast("date"), "week")
    present = t.orders.select(F.date_format(monday, "yyyyMMdd").alias("delivery"))
    return missing(present, "1994-01-03", "2002-12-30")


def _csv(df: DataFrame, path: str, **options) -> str:
    df.write.options(header=True, **options).csv(path)
    return path


@query("""
    SELECT 'stage_master' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'stage_title', count(*) FROM customer UNION ALL SELECT 'stage_timelog', count(*) FROM lineitem""")
def route_by_file(t: Tables) -> DataFrame:
    folder = scratch(t.spark, "route")
    _csv(t.orders.select("o_orderkey", "o_totalprice"), f"{folder}/master_0_20200406.csv")
    _csv(t.customer.select("c_custkey", "c_name"), f"{folder}/titles_0_20200406.csv")
    _csv(t.lineitem.select("l_orderkey", "l_shipdate"), f"{folder}/timelog_0_20200406.csv")
    routes = {"master": "stage_master", "title": "stage_title", "timelog": "stage_timelog"}
    lines = read_routed(t.spark, folder, routes, header=True)
    return lines.groupBy("table_name").agg(F.count("*").alias("n_rows"))


@query("""
    SELECT 'master' AS table_name, o_orderkey AS id, o_totalprice AS number, o_orderstatus AS word FROM orders
    UNION ALL SELECT 'titles', c_custkey, NULL, c_name FROM customer
    UNION ALL SELECT 'timelog', l_orderkey, l_quantity::DOUBLE, strftime(l_shipdate, '%Y-%m-%d') FROM lineitem""")
def split_load(t: Tables) -> DataFrame:
    """A delivery of three tables in several files each, told apart by file name and loaded with their own types."""
    folder = scratch(t.spark, "split")
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")
    for name, rows in (
        ("master_0_20200406", t.orders.filter("o_orderkey % 2 = 0")), ("master_1_20200406", t.orders.filter("o_orderkey % 2 <> 0")),
        ("titles_0_20200406", t.customer), ("timelog_0_20200406", t.lineitem.select("l_orderkey", "l_quantity", day)),
    ):
        columns = {"m": ["o_orderkey", "o_totalprice", "o_orderstatus"], "t": ["c_custkey", "c_name"]}
        wanted = rows if "timelog" in name else rows.select(*columns[name[0]])
        _csv(wanted, f"{folder}/{name}.csv")
    tables = {
        "master": read_split_table(t.spark, f"{folder}/master_*", "", "id long, number double, word string"),
        "titles": read_split_table(t.spark, f"{folder}/titles_*", "", "id long, word string").withColumn(
            "number", F.lit(None).cast("double")),
        "timelog": read_split_table(t.spark, f"{folder}/timelog_*", "", "id long, number double, day date").withColumn(
            "word", F.date_format("day", "yyyy-MM-dd")),
    }
    found = [rows.select(F.lit(name).alias("table_name"), "id", "number", "word") for name, rows in tables.items()]
    return found[0].unionAll(found[1]).unionAll(found[2])


@query("""
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END::INTEGER AS user_id, value,
           CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day,
           CASE WHEN event_id % 100 = 1 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS code,
           CAST(event_id + 10000000000 AS BIGINT) AS big, 'int,int,double,date,string,bigint,boolean' AS types
    FROM events""")
def csv_types(t: Tables) -> DataFrame:
    """A delivery whose types are found from its values: whole numbers with gaps, numbers, days with gaps, numbers among
    which some text stands, numbers too large for an int, and truth values."""
    path = scratch(t.spark, "untyped")
    _csv(t.events.select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"), "value",
        F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("event_id") % 100 == 1, "n/a").otherwise(F.col("user_id").cast("string")).alias("code"),
        (F.col("event_id") + 10_000_000_000).alias("big"), (F.col("event_id") % 2 == 0).alias("even")), path)
    typed = infer_csv(t.spark, path)
    kinds = ",".join(kind for _, kind in typed.dtypes)
    day = F.date_format("day", "yyyy-MM-dd").alias("day")
    return typed.select(F.col("event_id").cast("long").alias("event_id"), "user_id", "value", day, "code", "big", F.lit(kinds).alias("types"))


@query("SELECT p_partkey, p_brand, p_size::INTEGER AS p_size, p_retailprice FROM part")
def sheet_load(t: Tables) -> DataFrame:
    """Parts exported as sheets: a title line, the column names, then rows."""
    path = scratch(t.spark, "sheet")
    columns = ["p_partkey", "p_brand", "p_size", "p_retailprice"]
    sheets = F.floor(F.monotonically_increasing_id() / 1000)
    rows = t.part.select(F.to_csv(F.struct(*columns)).alias("row"), sheets.alias("sheet"))
    lines = F.concat(F.array(F.lit("Parts of a sheet"), F.lit(",".join(columns))), F.collect_list("row"))
    rows.groupBy("sheet").agg(F.array_join(lines, "\n").alias("value")).repartition("sheet").write.partitionBy("sheet").text(path)
    schema = T.StructType().add("p_partkey", T.LongType()).add("p_brand", T.StringType()).add(
        "p_size", T.IntegerType()).add("p_retailprice", T.DoubleType())
    return read_titled_csv(t.spark, f"{path}/*", schema)


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_files(t: Tables) -> DataFrame:
    """Some conversations arrive with one record per file, the others in files that hold an array of records."""
    path = scratch(t.spark, "records")
    single = F.coalesce(F.col("conv_id") % 100 == 0, F.lit(False))
    rows = t.conversations.select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value"), single.alias("single"))
    alone = rows.filter("single").select("value", F.monotonically_increasing_id().alias("file"))
    alone.repartition("file").write.partitionBy("file").text(f"{path}/one")
    many = rows.filter("NOT single").select("value", F.floor(F.monotonically_increasing_id() / 500).alias("file"))
    arrays = many.groupBy("file").agg(F.array_join(F.collect_list("value"), ",\n").alias("value"))
    arrays.select(F.concat(F.lit("["), "value", F.lit("]")).alias("value"), "file").repartition("file").write.partitionBy(
        "file").text(f"{path}/many")
    return read_json(t.spark, [f"{path}/one/*", f"{path}/many/*"], t.conversations.schema, whole_file=True)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def manifest_load(t: Tables) -> DataFrame:
    """The folder holds all orders; the manifest lists the files of two of the three states."""
    folder = scratch(t.spark, "manifest")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    t.orders.select(*columns, "o_orderstatus").write.partitionBy("o_orderstatus").option("header", True).csv(
        f"{folder}/orders"
    )
    files = t.spark.read.text(f"{folder}/orders").select(F.col("_metadata.file_path").alias("url")).distinct()
    entries = files.filter(~F.contains("url", F.lit("/o_orderstatus=P/"))).select(
        F.struct("url", F.lit(True).alias("mandatory")).alias("e")
    )
    entries.agg(F.collect_list("e").alias("entries")).write.json(f"{folder}/orders.manifest")
    return read_manifest(t.spark, f"{folder}/orders.manifest", "o_orderkey long, o_custkey long, o_totalprice double")


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           o_orderpriority FROM orders""")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Orders to latin-1 CSV, back with a declared schema, and on to parquet."""
    folder = scratch(t.spark, "csv")
    orders = t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", DATE_TEXT))
    _csv(orders, f"{folder}/orders.csv", encoding="ISO-8859-1")
    back = read_csv(t.spark, f"{folder}/orders.csv", orders.schema, encoding="ISO-8859-1")
    return to_parquet(back, f"{folder}/orders.parquet")


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(t: Tables) -> DataFrame:
    """Conversations to gzipped JSON lines in two appends, and back as one table."""
    folder = scratch(t.spark, "json")
    users = F.coalesce(F.col("role") == "user", F.lit(False))  # a row without a role is in the second part
    t.conversations.filter(users).write.mode("append").option("compression", "gzip").json(folder)
    append_json(t.conversations.filter(~users), folder)
    return read_json(t.spark, folder, t.conversations.schema)


@query("""
    SELECT 'customers' AS delivery, CASE WHEN max(strlen(c_name) - length(c_name)) > 0 THEN 'utf-8' ELSE 'ascii' END
      AS encoding FROM customer
    UNION ALL SELECT 'documents', CASE WHEN max(strlen(text) - length(text)) > 0 THEN 'utf-8' ELSE 'ascii' END
      FROM documents
    UNION ALL SELECT 'legacy', CASE WHEN max(strlen(text) - length(text)) > 0 THEN 'latin-1' ELSE 'ascii' END
      FROM documents""")
def encoding_audit(t: Tables) -> DataFrame:
    """Verdict over all files of three deliveries: plain names, texts in UTF-8 and texts in latin-1."""
    folder = scratch(t.spark, "encoding")
    _csv(t.customer.select("c_name"), f"{folder}/customers")
    _csv(t.documents.select("text"), f"{folder}/documents")
    _csv(t.documents.select("text"), f"{folder}/legacy", encoding="ISO-8859-1")
    verdicts = audit(t.spark, [f"{folder}/customers", f"{folder}/documents", f"{folder}/legacy"])
    delivery = F.element_at(F.split("file_path", "/"), -2)
    rank = F.array_position(F.array(F.lit("ascii"), F.lit("utf-8"), F.lit("latin-1")), F.col("encoding"))
    return verdicts.groupBy(delivery.alias("delivery")).agg(F.max_by("encoding", rank).alias("encoding"))


@query("""
    SELECT 0 AS position, 'o_orderkey' AS column_name, 'bigint' AS column_type, count(*) AS n_rows,
           count(o_orderkey) AS n_present FROM orders
    UNION ALL SELECT 1, 'o_custkey', 'bigint', count(*), count(o_custkey) FROM orders
    UNION ALL SELECT 2, 'o_orderstatus', 'string', count(*), count(o_orderstatus) FROM orders
    UNION ALL SELECT 3, 'o_totalprice', 'double', count(*), count(o_totalprice) FROM orders
    UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', count(*), count(o_orderdate) FROM orders
    UNION ALL SELECT 5, 'o_orderpriority', 'string', count(*), count(o_orderpriority) FROM orders""")
def schema_report(t: Tables) -> DataFrame:
    return report_schema(t.orders)


@query("""
    SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation
    UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region""")
def catalog_tables(t: Tables) -> DataFrame:
    """Save three tables in a database of their own, then list what the catalog holds, with row counts."""
    path = scratch(t.spark, "catalog")
    database = create_database(t.spark, path.rpartition("/")[2].replace("-", "_"), path)
    create_as(t.region, f"{database}.region", f"{path}/region")
    create_as(t.nation, f"{database}.nation", f"{path}/nation")
    create_as(t.orders.select("o_orderkey", "o_totalprice"), f"{database}.orders", f"{path}/orders")
    names = [r["table_name"] for r in list_tables(t.spark, database).collect()]
    counts = [
        t.spark.table(f"{database}.{n}").agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in names
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("SELECT event_id, event_type, value FROM events")
def lake_select(t: Tables) -> DataFrame:
    """Events land as partitioned JSON, are declared as a table, get an append, and are read back by column."""
    path = scratch(t.spark, "lake")
    database = create_database(t.spark, path.rpartition("/")[2].replace("-", "_"), path)
    events = t.events.select("event_id", "user_id", "value", "event_type")
    early = F.coalesce(F.col("value") < 20, F.lit(False))
    append_json(events.filter(early), f"{path}/output", ["event_type"])
    columns = "event_id bigint, user_id bigint, value double, event_type string"
    name = define_table(t.spark, f"{database}.output", columns, f"{path}/output", partitioned_by=["event_type"])
    append_to(events.filter(~early), name)
    return read_table(t.spark, name, ["event_id", "event_type", "value"])


@query("""
    SELECT 'c_name' AS column_name, CAST(max(length(c_name)) AS INTEGER) AS max_length FROM customer
    UNION ALL SELECT 'c_mktsegment', CAST(max(length(c_mktsegment)) AS INTEGER) FROM customer
    UNION ALL SELECT 'c_custkey', CAST(max(length(CAST(c_custkey AS VARCHAR))) AS INTEGER) FROM customer
    UNION ALL SELECT 'c_nationkey', CAST(max(length(CAST(c_nationkey AS VARCHAR))) AS INTEGER) FROM customer""")
def string_profile(t: Tables) -> DataFrame:
    return text_widths(t.customer, ["c_name", "c_mktsegment", "c_custkey", "c_nationkey"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)
