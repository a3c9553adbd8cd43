"""Codes inside text and delimited lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: shape of a diagnosis code, one capital letter, two digits, an optional dot and digits.
DIAGNOSIS_CODE = r"[A-Z]{1}\d{2}\.?\d*"


def extracted_codes(df: DataFrame, row_id: str, text: str, pattern: str = DIAGNOSIS_CODE) -> DataFrame:
    """One row per match: the row's id, the match ordinal ``entry`` and the ``code`` without dots."""
    matches = F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1))
    return df.select(row_id, F.posexplode(matches).alias("entry", "match")).select(
        row_id, "entry", F.replace("match", F.lit("."), F.lit("")).alias("code")
    )


def packed_codes(df: DataFrame, row_id: str, packed: str, separator: str = "^") -> DataFrame:
    """One row per member of a delimited list, empty members left out; ``entry`` is the place in the list."""
    members = F.split(F.col(packed), f"[{chr(92)}{separator}]")
    return df.select(row_id, F.posexplode(members).alias("entry", "code")).filter("code <> ''")


def has_shape(c: str | Column, pattern: str) -> Column:
    """Whether the text contains the pattern; null does not."""
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(column.rlike(pattern), F.lit(False))
