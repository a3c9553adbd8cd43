"""Text measures and routing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mentions(c: str | Column, word: str) -> Column:
    """Non-overlapping occurrences of ``word`` in any case, inside longer words too; null text has none."""
    text = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    kept = F.length(F.replace(text, F.lit(word.lower()), F.lit("")))
    return ((F.length(text) - kept) / len(word)).cast("int")


def with_text_features(df: DataFrame, title: str, body: str, word: str, name: str) -> DataFrame:
    """Add ``title_length``, ``selftext_length`` and the number of mentions of ``word`` in both texts."""
    return df.withColumns(
        {
            "title_length": F.length(title),
            "selftext_length": F.length(body),
            name: mentions(title, word) + mentions(body, word),
        }
    )


def route(name: Column, routes: Mapping[str, str], otherwise: str | None = None) -> Column:
    """First target whose fragment occurs in ``name``, case-sensitive."""
    out = None
    for fragment, target in routes.items():
        hit = F.contains(name, F.lit(fragment))
        out = F.when(hit, F.lit(target)) if out is None else out.when(hit, F.lit(target))
    return out.otherwise(F.lit(otherwise))


def full_name(kind: str, key: str) -> Column:
    """``kind_key``; null when either part is null."""
    return F.concat(F.col(kind), F.lit("_"), F.col(key))
