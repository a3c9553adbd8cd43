"""Data-quality rules over a delivery.

A rule that looks at one row is a named condition; all such rules are tested in a single pass. Rules about other
rows or tables (valid lists, uniqueness) are joins and aggregates of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.codes import DIAGNOSIS_CODE, has_shape
from tablework.functions.dates import DATE_SHAPE, to_date_or_null
from tablework.operators.joins import lookup_join
from tablework.operators.position import global_position
from tablework.session import pin


def failing_rows(df: DataFrame, row_id: str, rules: Mapping[str, tuple[Column, Column | str]]) -> DataFrame:
    """(rule, row_id, value) for each row and rule whose condition is not true."""
    found = F.array(
        *[
            F.when(
                ~F.coalesce(ok, F.lit(False)),
                F.struct(
                    F.lit(name).alias("rule"),
                    (F.col(value) if isinstance(value, str) else value).cast("string").alias("value"),
                ),
            )
            for name, (ok, value) in rules.items()
        ]
    )
    return df.select(F.col(row_id).alias("row_id"), F.explode(F.array_compact(found)).alias("f")).select(
        "f.rule", "row_id", "f.value"
    )


def with_days(df: DataFrame, *columns: str, shape: str = DATE_SHAPE, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add for each date text column whether it has the shape, and the day it stands for (null if there is none).

    The date rules below read these columns, so that each text is matched and parsed once.
    """
    shaped = df.withColumns({f"{c}_shaped": has_shape(c, shape) for c in columns})

    def day(c: str) -> Column:
        # a text of the default shape can go to the plain cast
        return F.col(c).try_cast("date") if shape == DATE_SHAPE else to_date_or_null(c, fmt)

    return shaped.withColumns({f"{c}_day": F.when(F.col(f"{c}_shaped"), day(c)) for c in columns})


def date_rules(column: str, as_of: Column) -> dict[str, tuple[Column, str]]:
    """Shape, calendar and not-in-the-future rules of one date text column.

    A text of the wrong shape fails the first rule only; the others look at well-formed texts.
    """
    shaped, day = F.col(f"{column}_shaped"), F.col(f"{column}_day")
    return {
        f"{column}_format": (shaped, column),
        f"{column}_calendar": (~shaped | day.isNotNull(), column),
        f"{column}_before_now": (day.isNull() | (day < as_of), column),
    }


def order_rule(first: str, second: str) -> dict[str, tuple[Column, Column]]:
    """``first`` must not come after ``second``, where both are real dates of the right shape."""
    a, b = F.col(f"{first}_day"), F.col(f"{second}_day")
    return {f"{first}_after_{second}": (a.isNull() | b.isNull() | (a <= b), F.concat_ws(" > ", first, second))}


def claim_rules(as_of: Column, code_shape: str = DIAGNOSIS_CODE) -> dict[str, tuple[Column, Column | str]]:
    """The row rules of a claims delivery, whose two date columns went through ``with_days``."""
    return {
        "claim_id_present": (F.col("claim_id").isNotNull(), F.lit(None)),
        "diagnosis_shape": (has_shape("diagnosis_codes", code_shape), "diagnosis_codes"),
        **date_rules("date_service", as_of),
        **date_rules("date_received", as_of),
        **order_rule("date_service", "date_received"),
    }


def invalid_codes(df: DataFrame, code: str, valid: DataFrame, valid_code: str) -> DataFrame:
    """Rows whose code is not in the valid list; a null code is not in it."""
    listed = valid.select(F.col(valid_code).cast("string").alias("_code")).distinct()
    coded = df.withColumn("_code", F.col(code).cast("string"))
    return lookup_join(coded, listed, ["_code"], "left_anti").drop("_code")


def _typed(field: T.StructField) -> Column:
    """The value that a text stands for in the field's type, null where it stands for none."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        return to_date_or_null(c)
    if isinstance(field.dataType, T.IntegralType):
        # text without the shape of a number is refused cheaply; the cast then looks at the range
        return F.when(has_shape(c, r"^\s*[+-]?\d+\s*$"), c.try_cast(field.dataType))
    return c.try_cast(field.dataType)


def schema_rules(declared: T.StructType) -> dict[str, tuple[Column, Column | str]]:
    """Row rules of a text delivery: each value can be cast to the declared type, and is there where it must be."""
    rules: dict[str, tuple[Column, Column | str]] = {}
    for field in declared:
        if not isinstance(field.dataType, T.StringType):
            rules[f"{field.name}_type"] = (F.col(field.name).isNull() | _typed(field).isNotNull(), field.name)
        if not field.nullable:
            rules[f"{field.name}_present"] = (F.col(field.name).isNotNull(), F.lit(None))
    return rules


def error_list(
    delivery: DataFrame, declared: T.StructType, rules: Mapping[str, tuple[Column, Column | str]],
    codes: Mapping[str, tuple[DataFrame, DataFrame]], unique: Sequence[str] = (),
) -> DataFrame:
    """Every error of a ``numbered`` delivery as (rule, row, value).

    ``rules`` are tested with the declared types in one pass. ``codes`` has the code rules by name: the codes of the rows
    as (row, code), and the valid ones as (code). Rows that share a value of the columns ``unique`` are an error each, so
    that all of them can be found.
    """
    found = [failing_rows(delivery, "row", {**schema_rules(declared), **rules})]
    for name, (present, valid) in codes.items():
        found.append(findings(invalid_codes(present, "code", valid, "code"), name, "row", "code"))
    if unique:
        keyed = delivery.select("row", F.concat_ws(":", *unique).alias("_key")).filter(
            F.coalesce(*[F.col(c).cast("string") for c in unique]).isNotNull())
        repeated = keyed.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key")
        found.append(findings(lookup_join(keyed, repeated, ["_key"], "left_semi"), "_".join(unique) + "_unique", "row", "_key"))
    return report(*found).select("rule", F.col("row_id").cast("long").alias("row"), "value")


def numbered(delivery: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their number from 0 under ``order``, stored, so that a finding can name its row."""
    return pin(global_position(delivery, list(order), "row"), "delivery")


def schema_check(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Per declared column of a text delivery: values that cannot be cast, and nulls where none are allowed."""
    pairs = []
    for field in declared:
        c, kind = F.col(field.name), field.dataType.simpleString()
        parsed = _typed(field)
        bad_null = F.lit(0).cast("long") if field.nullable else F.count_if(c.isNull())
        pairs.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(kind).alias("declared_type"),
                F.count_if(c.isNotNull() & parsed.isNull()).alias("n_bad_type"),
                bad_null.alias("n_bad_null"),
            )
        )
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def report(*parts: DataFrame) -> DataFrame:
    """All findings of a delivery, as (rule, row_id, value)."""
    out = parts[0].select("rule", F.col("row_id").cast("string").alias("row_id"), "value")
    for part in parts[1:]:
        out = out.unionByName(part.select("rule", F.col("row_id").cast("string").alias("row_id"), "value"))
    return out


def findings(df: DataFrame, rule: str, row_id: str | Sequence[str], value: str) -> DataFrame:
    """Rows found by a join or aggregate, in report form."""
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    return df.select(
        F.lit(rule).alias("rule"), F.concat_ws(":", *ids).alias("row_id"), F.col(value).cast("string").alias("value")
    )
