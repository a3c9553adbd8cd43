"""Landed API pages: one JSON document per page with a list of posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.dates import iso_utc

# Layout of a page and of the posts on it.
PAGE_SCHEMA = (
    "data struct<children: array<struct<kind: string, data: struct<subreddit: string, title: string, "
    "selftext: string, upvote_ratio: double, ups: double, downs: double, score: double, created_utc: double, "
    "id: string>>>>"
)


def posts(pages: DataFrame) -> DataFrame:
    """One row per post of each page, with the creation time as ISO text; a post without an id is an error."""
    child = pages.select(F.explode("data.children").alias("c")).select("c.data.*", "c.kind")
    checked = F.when(F.col("id").isNull(), F.raise_error(F.lit("post without id"))).otherwise(F.col("id"))
    return child.select(
        "subreddit", "title", "selftext", "upvote_ratio", "ups", "downs", "score",
        iso_utc("created_utc").alias("created_utc"), checked.alias("id"), "kind",
    )


def posts_from_text(pages: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Posts of pages held as JSON text, and the pages that are not JSON or have no list of posts."""
    parsed = pages.select("*", F.from_json(column, PAGE_SCHEMA).alias("_page"), F.try_parse_json(column).alias("_json"))
    known = F.col("_json").isNotNull() & F.col("_page.data.children").isNotNull()
    parsed = parsed.withColumn("_bad", ~known).drop("_json")
    good = posts(parsed.filter(~F.col("_bad")).select(F.col("_page.data").alias("data")))
    return good, parsed.filter("_bad").drop("_page", "_bad")
