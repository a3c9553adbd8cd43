"""Nested documents to flat columns, child tables, sets and indicator maps.

Everything here works inside one row: no shuffle, and no group that could grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaves(schema: T.StructType, parents: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all fields that are not structs, in schema order."""
    out: list[tuple[str, ...]] = []
    for field in schema:
        path = (*parents, field.name)
        out += leaves(field.dataType, path) if isinstance(field.dataType, T.StructType) else [path]
    return out


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per leaf, named by its path; two leaves with the same joined name are an error."""
    paths = leaves(df.schema)
    names = [separator.join(p) for p in paths]
    if len(set(names)) < len(names):
        raise ValueError(f"flattened names clash: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.select(
        *[F.col(".".join(f"`{part}`" for part in path)).alias(name) for path, name in zip(paths, names)]
    )


def relationalize(df: DataFrame, key: str, array: str, separator: str = ".") -> tuple[DataFrame, DataFrame]:
    """The table without its array column, and a child table of (key, index, flattened element)."""
    child = df.select(F.col(key), F.posexplode(array).alias("index", "val"))
    return df.drop(array), flatten_struct(child, separator)


def distinct_names(instructions: str, member: str) -> Column:
    """Sorted distinct names of one member list over all steps of all instructions; null when there are none."""
    steps = F.flatten(
        F.transform(F.coalesce(F.col(instructions), F.array()), lambda i: F.coalesce(i["steps"], F.array()))
    )
    names = F.flatten(
        F.transform(steps, lambda s: F.transform(F.coalesce(s[member], F.array()), lambda x: x["name"]))
    )
    kept = F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull())))
    return F.when(F.size(kept) > 0, kept)


def recipe_table(df: DataFrame) -> DataFrame:
    """Search results to one flat row per recipe, with its equipment and ingredient sets."""
    return df.select(
        "id", "title", "servings", "summary", "diets",
        distinct_names("analyzedInstructions", "equipment").alias("equipment"),
        distinct_names("analyzedInstructions", "ingredients").alias("ingredients"),
    )


def search_parameters(df: DataFrame) -> DataFrame:
    """Submissions to one row per user and present search parameter, lists joined with commas."""
    wanted = {"includeIngredients": True, "excludeIngredients": True, "intolerances": False}
    pairs = F.array(
        *[
            F.struct(
                F.lit(n).alias("parameter"),
                (F.array_join(f"pantry.{n}", ",") if is_list else F.col(f"pantry.{n}")).alias("value"),
            )
            for n, is_list in wanted.items()
        ]
    )
    return df.select(F.col("user.name").alias("name"), F.inline(pairs)).filter("value is not null")


def indicator_map(array: str) -> Column:
    """List of names to a map with value 1 per distinct name."""
    names = F.array_distinct(F.col(array))
    return F.map_from_arrays(names, F.transform(names, lambda _: F.lit(1)))


def encode_attributes(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """Attribute JSON to rows (key, feature, value), one level deep.

    Text ``v`` under ``k`` becomes feature ``k_v`` with 1, a boolean becomes 0 or 1, a number keeps its value and a
    nested map is prefixed with its key. Lists, and maps below that level, count as their JSON text. Text that is not
    JSON and null attributes give no rows.
    """
    tvf = df.sparkSession.tvf
    top = tvf.variant_explode(F.col("_attributes").outer()).select(
        F.col("key").alias("_key"), F.col("value").alias("_top"), F.schema_of_variant("value").alias("_top_kind")
    )
    nested = F.col("_top_kind").startswith("OBJECT")
    # one row of nulls for a value that is not a map, so that both levels come from one pass
    inner = tvf.variant_explode_outer(F.when(nested, F.col("_top")).outer()).select(
        F.col("key").alias("_sub_key"), F.col("value").alias("_sub")
    )
    flat = (
        df.select(key, F.try_parse_json(attributes).alias("_attributes"))
        .lateralJoin(top)
        .lateralJoin(inner)
        .filter(~nested | F.col("_sub_key").isNotNull())
        .select(
            key,
            F.concat_ws("_", "_key", "_sub_key").alias("_name"),
            F.when(nested, F.col("_sub")).otherwise(F.col("_top")).alias("_value"),
        )
        .withColumn("_kind", F.schema_of_variant("_value"))
    )

    def read(kind: str) -> Column:
        return F.try_variant_get("_value", "$", kind)

    is_deep = F.col("_kind").startswith("ARRAY") | F.col("_kind").startswith("OBJECT")
    is_text, is_flag = (F.col("_kind") == "STRING") | is_deep, F.col("_kind") == "BOOLEAN"
    text = F.when(is_deep, F.to_json("_value")).otherwise(read("string"))
    return flat.select(
        key,
        F.when(is_text, F.concat_ws("_", F.col("_name"), text)).otherwise(F.col("_name")).alias("feature"),
        F.when(is_text, F.lit(1.0))
        .when(is_flag, read("boolean").cast("int").cast("double"))
        .otherwise(read("double"))
        .alias("value"),
    ).filter("value is not null")
