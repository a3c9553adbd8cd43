"""Flattening, child tables, sets and attribute encoding."""

import pytest

from tablework.operators.nested import (
    encode_attributes, flatten_struct, indicator_map, recipe_table, relationalize, search_parameters,
)
from tablework.sources.pages import posts_from_text

DOCUMENT = (
    "member_id string, name string, accountAge long, age long, subscribedTo long, "
    "activity struct<hotClickZone: boolean, action: struct<action_id: long, enabled: boolean, type: string>>, "
    "content struct<title: string, status: string, likes: long, views: long, comments: long, company: struct<"
    "name: string, yearFounded: string, currentSubscribers: long, lastYearSubscribers: long, lastYearsRevenue: double>>, "
    "id_tags struct<activity_id: long, content_id: long>"
)
NAMED = "array<struct<name: string>>"
RECIPE = (
    "id long, title string, servings int, summary string, diets array<string>, analyzedInstructions "
    f"array<struct<steps: array<struct<equipment: {NAMED}, ingredients: {NAMED}>>>>"
)


def test_flatten_keeps_all_leaves(spark):
    rows = [("m", "n", 1, 2, 3, (True, (9, False, "t")), ("c", "s", 1, 2, None, ("co", "1999", 1, 2, 3.5)), None)]
    flat = flatten_struct(spark.createDataFrame(rows, DOCUMENT))
    assert len(flat.columns) == 21 and "content.company.lastYearsRevenue" in flat.columns
    row = flat.first()
    assert row["activity.action.action_id"] == 9 and row["id_tags.content_id"] is None and row["content.comments"] is None
    assert dict(flat.dtypes)["activity.hotClickZone"] == "boolean"


def test_flattened_names_may_not_clash(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b: int>")
    assert flatten_struct(df).columns == ["a_b", "a.b"]
    with pytest.raises(ValueError, match="a_b"):
        flatten_struct(df, "_")


def test_child_table_keeps_key_and_index(spark):
    df = spark.createDataFrame([(1, [("x",), ("y",)]), (2, [])], "id int, items array<struct<v: string>>")
    parent, child = relationalize(df, "id", "items")
    assert parent.columns == ["id"] and parent.count() == 2
    assert sorted(map(tuple, child.collect())) == [(1, 0, "x"), (1, 1, "y")]


def test_recipes(spark):
    steps = [([("pan",), ("pan",)], [("salt",)]), (None, [("egg",), ("salt",)])]
    rows = [
        (1, "a", 2, "s", ["vegan"], [(steps,), ([([("oven",)], [])],)]),
        (2, "b", 2, "s", [], []),
        (3, "c", 2, "s", [], None),
        (4, "d", 2, "s", [], [([([], [("egg",)])],)]),
    ]
    out = {r["id"]: (r["equipment"], r["ingredients"]) for r in recipe_table(spark.createDataFrame(rows, RECIPE)).collect()}
    assert out == {1: (["oven", "pan"], ["egg", "salt"]), 2: (None, None), 3: (None, None), 4: (None, ["egg"])}


def test_absent_parameters_are_skipped(spark):
    schema = (
        "pantry struct<includeIngredients: array<string>, excludeIngredients: array<string>, intolerances: string>, "
        "user struct<name: string>"
    )
    df = spark.createDataFrame([((["a", "b"], None, "nuts"), ("u",)), ((None, None, None), ("v",))], schema)
    out = sorted(map(tuple, search_parameters(df).collect()))
    assert out == [("u", "includeIngredients", "a,b"), ("u", "intolerances", "nuts")]


def test_attributes_one_level_deep(spark):
    text = '{"Attire": "casual", "Accepts Credit Cards": true, "Ambiance": {"casual": false, "classy": false}, "Price": 2}'
    df = spark.createDataFrame([(1, text), (2, None), (3, "no json"), (4, "{}")], "id int, a string")
    out = {(r["id"], r["feature"]): r["value"] for r in encode_attributes(df, "id", "a").collect()}
    assert out == {
        (1, "Attire_casual"): 1.0, (1, "Accepts Credit Cards"): 1.0, (1, "Ambiance_casual"): 0.0,
        (1, "Ambiance_classy"): 0.0, (1, "Price"): 2.0,
    }


def test_deeper_attributes_keep_their_text(spark):
    df = spark.createDataFrame([(1, '{"A":["x"],"B":{"C":{"D":true}},"E":"t"}')], "id int, a string")
    out = {r["feature"]: r["value"] for r in encode_attributes(df, "id", "a").collect()}
    assert out == {'A_["x"]': 1.0, 'B_C_{"D":true}': 1.0, "E_t": 1.0}


def test_pages_of_another_layout_are_bad(spark):
    page = '{"data": {"children": [{"kind": "t3", "data": {"id": "a", "title": "x"}}]}}'
    df = spark.createDataFrame([(page,), ('{"error": 429}',), ("[1]",), ("no json",), (None,)], "v string")
    good, bad = posts_from_text(df, "v")
    assert [r["id"] for r in good.collect()] == ["a"] and bad.count() == 4


def test_indicator_map(spark):
    df = spark.createDataFrame([(["b", "c", "b"],), ([],)], "c array<string>")
    out = [r["m"] for r in df.select(indicator_map("c").alias("m")).collect()]
    assert out == [{"b": 1, "c": 1}, {}]
