"""Recipes and nested documents: sets, flat columns, child tables, batches, lists per user.

Conversation turns stand in for recipes (lines are steps, words are names), customers for submissions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.joins import lookup_join
from tablework.operators.nested import encode_attributes, indicator_map, recipe_table, search_parameters
from tablework.operators.nested import flatten_struct as flatten
from tablework.operators.nested import relationalize as child_tables
from tablework.operators.position import batches_of_n as cut_batches
from tablework.operators.position import list_per_key
from tablework.plans.registry import Tables, query
from tablework.session import scratch
from tablework.sinks.files import land_raw
from tablework.sources.files import read_json
from tablework.streaming.ingest import file_stream, run_batches
from tablework.streaming.linked import BucketedTable, OwnedLists
from tablework.streaming.zones import run_zone


def _names(pattern: str):
    return lambda line: F.transform(
        F.regexp_extract_all(line, F.lit(f"({pattern})"), F.lit(1)), lambda w: F.struct(w.alias("name"))
    )


@query("""
    SELECT conv_id * 1000 + turn AS id, role AS title,
      nullif(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))), ','), '') AS equipment,
      nullif(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[a-z]+'))), ','), '') AS ingredients
    FROM conversations""")
def nested_sets(t: Tables) -> DataFrame:
    step = lambda line: F.struct(
        _names("[A-Z][a-z]+")(line).alias("equipment"), _names("[a-z]+")(line).alias("ingredients")
    )
    recipes = t.conversations.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("role").alias("title"),
        F.lit(1).alias("servings"), F.lit("").alias("summary"), F.array(F.lit("none")).alias("diets"),
        F.array(F.struct(F.transform(F.split("text", "\n"), step).alias("steps"))).alias("analyzedInstructions"),
    )
    return recipe_table(recipes).select(
        "id", "title", F.array_join("equipment", ",").alias("equipment"),
        F.array_join("ingredients", ",").alias("ingredients"),
    )


@query("""
    SELECT c_name AS name, 'includeIngredients' AS parameter, lower(c_mktsegment) || ',salt' AS value FROM customer
    UNION ALL SELECT c_name, 'excludeIngredients', 'nation' || c_nationkey FROM customer WHERE c_nationkey < 20
    UNION ALL SELECT c_name, 'intolerances', c_mktsegment FROM customer WHERE c_acctbal > 0""")
def nested_project(t: Tables) -> DataFrame:
    """Search parameters of submissions in which a parameter may be absent."""
    pantry = F.struct(
        F.array(F.lower("c_mktsegment"), F.lit("salt")).alias("includeIngredients"),
        F.when(F.col("c_nationkey") < 20, F.array(F.concat(F.lit("nation"), "c_nationkey"))).alias("excludeIngredients"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("intolerances"),
    )
    return search_parameters(t.customer.select(pantry.alias("pantry"), F.struct(F.col("c_name").alias("name")).alias("user")))


@query("""
    SELECT o_orderkey, o_totalprice, c_custkey AS customer_c_custkey, c_name AS customer_c_name,
           n_nationkey AS customer_nation_n_nationkey, n_name AS customer_nation_n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def flatten_struct(t: Tables) -> DataFrame:
    """Orders with a customer document inside, which holds a nation document."""
    nation = F.struct("n_nationkey", "n_name").alias("nation")
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.struct("c_custkey", "c_name", nation).alias("customer")
    )
    documents = lookup_join(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"), customers, ["o_custkey"], "inner")
    return flatten(documents.drop("o_custkey"), "_")


@query("""
    SELECT c_custkey AS member_id, c_name AS name, c_acctbal AS activity_action_amount, c_acctbal > 0 AS activity_action_enabled,
           c_mktsegment AS activity_type, n_name AS content_company_name, CASE WHEN n_regionkey > 1 THEN n_regionkey::BIGINT END AS content_company_region,
           n_nationkey::BIGINT AS id_tags_nation_id, c_mktsegment || ',' || n_name AS tags, 2::INTEGER AS n_tags
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def nested_scan(t: Tables) -> DataFrame:
    """A collection of nested documents as JSON lines, with fields that some of them lack, scanned with its declared
    layout and laid flat; lists become indicators."""
    path = scratch(t.spark, "collection")
    rows = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    company = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")).alias("region"))
    action = F.struct(F.col("c_acctbal").alias("amount"), (F.col("c_acctbal") > 0).alias("enabled"))
    rows.select(
        F.col("c_custkey").alias("member_id"), F.col("c_name").alias("name"),
        F.struct(action.alias("action"), F.col("c_mktsegment").alias("type")).alias("activity"),
        F.struct(company.alias("company")).alias("content"), F.struct(F.col("n_nationkey").alias("nation_id")).alias("id_tags"),
        F.array("c_mktsegment", "n_name").alias("tags")).write.json(path)
    layout = (
        "member_id long, name string, activity struct<action: struct<amount: double, enabled: boolean>, type: string>, "
        "content struct<company: struct<name: string, region: long>>, id_tags struct<nation_id: long>, tags array<string>")
    documents = read_json(t.spark, path, layout)
    flat = flatten(documents.withColumn("marks", F.map_entries(indicator_map("tags"))), "_")
    names = F.array_join(F.transform("marks", lambda m: m["key"]), ",")
    return flat.select(
        *[c for c in flat.columns if c not in ("tags", "marks")], names.alias("tags"),
        F.aggregate("marks", F.lit(0), lambda a, m: a + m["value"].cast("int")).alias("n_tags"))


@query("""
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS index, lines[i] AS val_line, CAST(length(lines[i]) AS INTEGER) AS val_n_chars
    FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""")
def relationalize(t: Tables) -> DataFrame:
    """Each document holds its lines as an array of structs; the child table has one row per line."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("n_chars")))
    _, child = child_tables(t.documents.select("doc_id", lines.alias("lines")), "doc_id", "lines", "_")
    return child


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(t: Tables) -> DataFrame:
    """A field of JSON text; text that is not JSON gives null."""
    return t.events.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


@query("""
    SELECT p_partkey, 'Type_' || p_type AS feature, 1.0::DOUBLE AS value FROM part
    UNION ALL SELECT p_partkey, 'Big', CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END FROM part
    UNION ALL SELECT p_partkey, 'Size', CAST(p_size AS DOUBLE) FROM part
    UNION ALL SELECT p_partkey, 'Made_cheap', CASE WHEN p_retailprice < 1000 THEN 1.0 ELSE 0.0 END FROM part
    UNION ALL SELECT p_partkey, 'Made_by_' || p_brand, 1.0 FROM part""")
def attribute_encode(t: Tables) -> DataFrame:
    """Attributes of parts as JSON with text, a flag, a number and a nested map, encoded as features."""
    made = F.struct((F.col("p_retailprice") < 1000).alias("cheap"), F.col("p_brand").alias("by"))
    attributes = F.to_json(F.struct(
        F.col("p_type").alias("Type"), (F.col("p_size") > 25).alias("Big"), F.col("p_size").alias("Size"),
        made.alias("Made"),
    ))
    return encode_attributes(t.part.select("p_partkey", attributes.alias("attributes")), "p_partkey", "attributes")


@query("""
    WITH d AS (SELECT DISTINCT user_id, event_type FROM events),
    n AS (SELECT *, row_number() OVER (ORDER BY user_id, event_type) - 1 AS p, count(*) OVER () AS total FROM d)
    SELECT CAST(floor(p / 20) AS BIGINT) AS batch_id, user_id, event_type FROM n WHERE p < total - total % 20""")
def batches_of_n(t: Tables) -> DataFrame:
    """Distinct submissions leave in full batches of 20, land as text, and are read from there."""
    path = scratch(t.spark, "raw")
    batches = cut_batches(t.events.select("user_id", "event_type"), ["user_id", "event_type"], 20)
    land_raw(batches.select("batch_id", F.to_json(F.struct("user_id", "event_type")).alias("value")), path)
    landed = t.spark.read.schema("batch_id long, value string").parquet(path)
    return landed.select("batch_id", F.from_json("value", "user_id long, event_type string").alias("r")).select(
        "batch_id", "r.*"
    )


@query("""
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS orders
    FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) GROUP BY o_custkey""")
def user_recipe_ids(t: Tables) -> DataFrame:
    """All order keys of each customer, in one list."""
    lists = list_per_key(t.orders, "o_custkey", "o_orderkey", "orders")
    return lists.select("o_custkey", F.array_join("orders", ",").alias("orders"))


USER = "name string, address string, recipes array<long>, delivery int"
RECIPE = "id long, title string, servings int, delivery int"


def _land_arrays(df: DataFrame, path: str, per_file: int = 20_000) -> None:
    """Rows as files that hold one array of at most ``per_file`` records each: a few megabytes, so that files and folders
    stay few."""
    rows = df.select(F.to_json(F.struct("*")).alias("r"), F.monotonically_increasing_id().alias("n"))
    files = rows.groupBy(F.floor(F.col("n") / per_file).alias("file")).agg(F.collect_list("r").alias("r"))
    files.select(F.concat(F.lit("["), F.array_join("r", ",\n"), F.lit("]")).alias("value"), "file").repartition("file").write.partitionBy(
        "file").text(path)


@query("""
    WITH o AS (SELECT c_name AS name, c_mktsegment AS address, o_orderkey AS id, c_custkey FROM customer JOIN orders ON o_custkey = c_custkey)
    SELECT name, address || CASE WHEN c_custkey % 50 = 7 THEN '!' ELSE '' END AS address, id,
           CASE WHEN id % 10 = 3 THEN 'new' ELSE o_orderstatus END AS title, 1 AS n_rows
    FROM o JOIN orders ON id = o_orderkey WHERE c_custkey % 50 <> 7 OR id % 2 = 0""")
def recipe_tables(t: Tables) -> DataFrame:
    """Users with lists of recipes, and recipes, arrive as files of records; two deliveries go from the raw zone to the
    stage zone to tables of users, recipes and links. Users that arrive again lose the recipes they no longer list, and
    recipes that arrive again are as they arrived last."""
    base = scratch(t.spark, "recipes")
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    again = F.col("c_custkey") % 50 == 7
    users, recipes = [], []
    for delivery, rows, address in (
        (1, orders, F.col("c_mktsegment")),
        (2, orders.filter(again & (F.col("o_orderkey") % 2 == 0)), F.concat("c_mktsegment", F.lit("!"))),
    ):
        users.append(rows.groupBy(F.col("c_name").alias("name"), address.alias("address")).agg(
            F.collect_list("o_orderkey").alias("recipes")).withColumn("delivery", F.lit(delivery)))
    recipe = [F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"), F.lit(4).alias("servings")]
    recipes.append(t.orders.select(*recipe, F.lit(1).alias("delivery")))
    recipes.append(t.orders.filter("o_orderkey % 10 = 3").select(*recipe, F.lit(2).alias("delivery")).withColumn("title", F.lit("new")))
    # customers whose every order goes would not arrive: they arrive with an empty list
    gone = orders.groupBy("c_custkey", "c_name", "c_mktsegment").agg(F.max((F.col("o_orderkey") % 2 == 0).cast("int")).alias("any"))
    users[1] = users[1].unionByName(gone.filter(again & (F.col("any") == 0)).select(
        F.col("c_name").alias("name"), F.concat("c_mktsegment", F.lit("!")).alias("address"),
        F.array().cast("array<bigint>").alias("recipes"), F.lit(2).alias("delivery")))

    schemas = {"user": T.StructType.fromDDL(USER), "recipe": T.StructType.fromDDL(RECIPE)}
    owned = OwnedLists(t.spark, f"{base}/tables", schemas["user"], "name", "recipes", "id")
    known = BucketedTable(t.spark, f"{base}/tables/recipe", schemas["recipe"], ["id"])
    for delivery in (0, 1):
        _land_arrays(users[delivery], f"{base}/raw/user-{delivery}")
        _land_arrays(recipes[delivery], f"{base}/raw/recipe-{delivery}")
        for kind, table in (("user", owned), ("recipe", known)):
            run_zone(t.spark, f"{base}/raw/{kind}-*/*", schemas[kind], f"{base}/stage/{kind}", f"{base}/state/raw-{kind}",
                     lambda frame: frame, whole_file=True)
            staged = file_stream(t.spark, f"{base}/stage/{kind}/*", schemas[kind])
            run_batches(staged, lambda frame, n, table=table: table.merge(frame, f"batch-{n}", [F.desc("delivery")]),
                        f"{base}/state/{kind}")
    links = owned.links.read().join(known.read().select("id", "title"), "id")
    found = links.join(owned.owners.read().select("name", "address"), "name")
    return found.groupBy("name", "address", "id", "title").agg(F.count("*").cast("int").alias("n_rows"))
