"""Posts: landed pages, text measures, micro-batches to a partitioned lake, streams with a key.

Events stand in for posts and documents for their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.dates import INGEST_COLUMNS, with_ingest_columns
from tablework.functions.text import with_text_features
from tablework.operators.mapping import apply_mapping as to_layout
from tablework.operators.mapping import to_records as as_records
from tablework.operators.position import global_position
from tablework.plans.registry import Tables, query
from tablework.session import scratch
from tablework.sinks.files import append_json
from tablework.sources.pages import posts_from_text
from tablework.streaming.ingest import enrich_posts, file_stream, ingest, run_batches
from tablework.streaming.keyed import LatestImage, OncePerKey, cursor
from tablework.streaming.registered import RegisteringSink
from tablework.streaming.zones import run_zone

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
POST_SCHEMA = (
    "subreddit string, title string, selftext string, upvote_ratio double, ups double, downs double, score double, "
    "created_utc string, id string, kind string, ts timestamp_ntz"
)


@query("""
    SELECT doc_id, CAST(length(source) AS INTEGER) AS title_length, CAST(length(text) AS INTEGER) AS selftext_length,
      CAST(((length(lower(source)) - length(replace(lower(source), 'the', '')))
        + (length(lower(text)) - length(replace(lower(text), 'the', '')))) / 3 AS INTEGER) AS mentions
    FROM documents""")
def text_features(t: Tables) -> DataFrame:
    measured = with_text_features(t.documents, "source", "text", "the", "mentions")
    return measured.select("doc_id", "title_length", "selftext_length", "mentions")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, CAST(trunc(value) AS INTEGER) AS score,
           value AS upvote_ratio, TRY_CAST(event_type AS INTEGER) AS ups FROM events""")
def apply_mapping(t: Tables) -> DataFrame:
    return to_layout(t.events, [
        ("event_id", "long", "id", "string"),
        ("event_type", "string", "kind", "string"),
        ("value", "double", "score", "integer"),
        ("value", "double", "upvote_ratio", "double"),
        ("event_type", "string", "ups", "integer"),
    ])


def _posts(t: Tables) -> DataFrame:
    """Events in the shape of posts."""
    return t.events.select(
        F.col("event_type").alias("subreddit"),
        F.concat(F.lit("Python "), "event_type").alias("title"),
        F.col("props").alias("selftext"),
        F.lit(0.5).alias("upvote_ratio"),
        F.col("value").alias("ups"),
        F.lit(0.0).alias("downs"),
        F.col("value").alias("score"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_utc"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("kind"),
        "ts",
    )


@query("""
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, value AS score,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_utc FROM events""")
def page_explode(t: Tables) -> DataFrame:
    """Events are packed to JSON pages of 100 and unpacked again."""
    post = F.struct(
        F.col("event_type").alias("kind"),
        F.struct(
            F.col("event_id").cast("string").alias("id"), F.col("value").alias("score"),
            F.unix_timestamp(F.col("ts").cast("timestamp")).alias("created_utc"),
        ).alias("data"),
    )
    placed = global_position(t.events, ["ts", "event_id"], "place")
    pages = (
        placed.groupBy(F.floor(F.col("place") / 100).alias("page"))
        .agg(F.collect_list(post).alias("children"))
        .select(F.to_json(F.struct(F.struct("children").alias("data"))).alias("page_text"))
    )
    good, _ = posts_from_text(pages, "page_text")
    return good.select("id", "kind", "score", "created_utc")


@query("""
    SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS "Data",
           36 AS key_length FROM events""")
def to_records(t: Tables) -> DataFrame:
    """Stream records; of the random key only its length is compared."""
    records = as_records(t.events.select("event_id", "user_id", "event_type"))
    return records.select("Data", F.length("PartitionKey").alias("key_length"))


INGEST_SQL = """CAST(year(ts) AS INTEGER) AS ingest_year, CAST(month(ts) AS INTEGER) AS ingest_month,
      CAST(day(ts) AS INTEGER) AS ingest_day, CAST(hour(ts) AS INTEGER) AS ingest_hour"""


@query(f"SELECT {INGEST_SQL}, count(*) AS n FROM events GROUP BY ALL")
def ingest_partitions(t: Tables) -> DataFrame:
    """Events written to year, month, day and hour folders by event time, counted from the folders."""
    path = scratch(t.spark, "partitions")
    stamped = with_ingest_columns(t.events.select("event_id", "ts"), F.col("ts"))
    append_json(stamped.drop("ts"), path, INGEST_COLUMNS)
    back = t.spark.read.schema("event_id long, " + ", ".join(f"{c} int" for c in INGEST_COLUMNS)).json(path)
    return back.groupBy(*INGEST_COLUMNS).agg(F.count("*").alias("n"))


def _files_per_trigger(t: Tables) -> int:
    """A share of the files that a shuffle of this session writes, so that batches grow with the cluster."""
    return max(1, int(t.spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def _land(df: DataFrame, path: str) -> str:
    df.write.mode("append").json(path)
    return path


def _read_sink(t: Tables, path: str, schema: str, fmt: str = "json") -> DataFrame:
    names = [column.split()[0] for column in schema.split(", ")]
    return t.spark.read.schema(schema).format(fmt).load(path).select(*names)


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, CAST(trunc(value) AS INTEGER) AS score,
      CAST(7 + length(event_type) AS INTEGER) AS title_length, CAST(length(props) AS INTEGER) AS selftext_length,
      1 AS python_mentions, {INGEST_SQL} FROM events""")
def stream_file_ingest(t: Tables) -> DataFrame:
    """Posts arrive as files, are enriched per micro-batch and written by hour; event time stands for the clock."""
    base = scratch(t.spark, "ingest")
    _land(_posts(t).repartitionByRange("ts"), f"{base}/in")
    stream = file_stream(t.spark, f"{base}/in", POST_SCHEMA, files_per_trigger=_files_per_trigger(t))

    def enrich(frame: DataFrame) -> DataFrame:
        return enrich_posts(frame).withColumn("ts", F.to_timestamp_ntz("created_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))

    ingest(stream, enrich, f"{base}/out", f"{base}/state", at=F.col("ts"))
    columns = "id string, kind string, score int, title_length int, selftext_length int, python_mentions int"
    return _read_sink(t, f"{base}/out", columns + "".join(f", {c} int" for c in INGEST_COLUMNS))


@query("SELECT event_id, event_type, value FROM events")
def stream_restart(t: Tables) -> DataFrame:
    """Half the events, a stop, the other half, a start from the checkpoint: each event is written once."""
    base = scratch(t.spark, "restart")
    events = t.events.select("event_id", "event_type", "value")
    schema = events.schema
    early = F.coalesce(F.col("value") < 10, F.lit(False))
    for part in (early, ~early):
        _land(events.filter(part), f"{base}/in")
        run_zone(t.spark, f"{base}/in", schema, f"{base}/out", f"{base}/state", lambda frame: frame)
    return _read_sink(t, f"{base}/out", "event_id long, event_type string, value double")


@query("SELECT event_id, upper(event_type) AS kind, value * 2 AS score FROM events WHERE event_type <> 'error'")
def stream_two_stage(t: Tables) -> DataFrame:
    """Raw zone to stage zone to final zone; the second stream reads what the first one wrote."""
    base = scratch(t.spark, "zones")
    events = t.events.select("event_id", "event_type", "value")
    _land(events, f"{base}/raw")
    run_zone(t.spark, f"{base}/raw", events.schema, f"{base}/stage", f"{base}/state-1",
             lambda frame: frame.filter("event_type <> 'error'"))
    run_zone(t.spark, f"{base}/stage/*", events.schema, f"{base}/final", f"{base}/state-2",
             lambda frame: frame.select("event_id", F.upper("event_type").alias("kind"),
                                        (F.col("value") * 2).alias("score")))
    return _read_sink(t, f"{base}/final", "event_id long, kind string, score double")


@query("""
    SELECT event_id, strftime(CASE WHEN event_id % 100 = 0 THEN ts - INTERVAL 400 DAY ELSE ts END, '%Y-%m-%d %H:%M:%S') AS seen
    FROM events""")
def stream_dedup(t: Tables) -> DataFrame:
    """All events are sent twice, the second time after a restart, with some first sent then, from long before; each
    leaves once."""
    base = scratch(t.spark, "dedup")
    late = F.col("event_id") % 100 == 0
    ts = F.when(late, F.col("ts") - F.expr("INTERVAL 400 DAY")).otherwise(F.col("ts"))
    events = t.events.select("event_id", ts.alias("ts"))
    sink = OncePerKey(t.spark, f"{base}/out", events.schema, ["event_id"], "ts")
    for part in (events.filter(~late), events):
        _land(part, f"{base}/in")
        stream = file_stream(t.spark, f"{base}/in", events.schema, files_per_trigger=_files_per_trigger(t))
        sink.run(stream, f"{base}/state")
    return sink.read().select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"))


@query("SELECT event_type || '_' || event_id AS cursor FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def stream_cursor(t: Tables) -> DataFrame:
    return cursor(t.events, "event_type", "event_id", "ts")


@query("""
    SELECT user_id, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r = 1""")
def stream_upsert(t: Tables) -> DataFrame:
    """Events arrive in three spans of time; the latest image per user is kept."""
    base = scratch(t.spark, "upsert-stream")
    events = t.events.select("event_id", "ts", "user_id", "value")
    image = LatestImage(t.spark, f"{base}/out", events.schema, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    second, third = (
        F.coalesce(F.col("ts") >= F.lit(day).cast("timestamp_ntz"), F.lit(False)) for day in ("2024-01-10", "2024-01-20"))
    for span in (~second, second & ~third, third):  # every event, also without a time, is in one of them
        _land(events.filter(span), f"{base}/in")
        image.run(file_stream(t.spark, f"{base}/in", events.schema), f"{base}/state")
    return image.read().select("user_id", "event_id", "value")


@query("SELECT event_id, user_id, props FROM events")
def stream_archive(t: Tables) -> DataFrame:
    """Consumed files move to an archive; what they held is in the sink once."""
    base = scratch(t.spark, "archive")
    events = t.events.select("event_id", "user_id", "props")
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    for part in (clicks, ~clicks):
        _land(t.events.filter(part).select(*events.columns), f"{base}/in")
        run_zone(t.spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/state", lambda frame: frame,
                 archive=f"{base}/archive")
    return _read_sink(t, f"{base}/out", "event_id long, user_id long, props string")


@query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day, 2::BIGINT AS n_drifted,
           (SELECT count(*) FROM events WHERE event_id % 10 = 3) AS n_aside
    FROM events WHERE event_id % 10 <> 3""")
def stream_registered(t: Tables) -> DataFrame:
    """Two streams into one table of the catalog, read by its name. The second has a column more and one of another type:
    its batch is in the log, with its rows beside it, and not in the table."""
    base = scratch(t.spark, "registered")
    events = t.events.select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sink = RegisteringSink(
        t.spark, f"events_{base.rpartition('-')[2]}", f"{base}/table", events.schema, ["day"], f"{base}/log")
    other = events.withColumn("value", F.col("value").cast("string")).withColumn("extra", F.lit(1))
    odd = F.col("event_id") % 10 == 3
    for name, rows in (("first", events.filter(~odd)), ("second", other.filter(odd))):
        _land(rows, f"{base}/in-{name}")
        stream = file_stream(t.spark, f"{base}/in-{name}", rows.schema)
        run_batches(stream, lambda frame, n, name=name: sink.write(frame, f"{name}-{n}"), f"{base}/state-{name}")
    aside = t.spark.read.schema("event_id long").json(f"{base}/log/rows")
    counts = sink.drifted().agg(F.count("*").alias("n")).first()["n"], aside.count()
    return sink.read().select(
        "event_id", "event_type", "value", "day", F.lit(counts[0]).cast("long").alias("n_drifted"),
        F.lit(counts[1]).cast("long").alias("n_aside"))
