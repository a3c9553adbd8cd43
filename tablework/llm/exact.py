"""Exact de-duplication of texts, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.session import pin


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is the empty text."""
    # single spaces are left alone: they need no replacement
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")


def exact_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", content_hash: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """Groups of equal texts: one row per input row with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are grouped by a 128-bit hash of the normalised text, and within a hash by the bytes themselves, so that two
    texts with one hash are two groups. A group held by a third of all rows reaches the shuffle as one row per task.
    Rows then meet their group by the two hashes, without their texts; were two texts ever equal in both, the query
    fails instead of joining them.

    A null text is the empty text. Rows that repeat id and text are one document: they carry the same ``kept``.
    Rows with a null id are kept only where their group has no other id. An empty table gives an empty result.
    Extra columns are ignored, whatever their names.
    """
    clean = docs.select(F.col(id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    hashed = clean.select("doc_id", content_hash(F.col("norm")).alias("h"), "norm")
    classes = hashed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = pin(classes.select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"), "classes")
    told = classes.groupBy("h", "text_sha256").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("texts")
    )
    told = pin(told.select(
        "h", "text_sha256", "keep_id",
        F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
            F.raise_error(F.lit("two texts agree in both hashes")).cast("bigint")
        ).alias("group_size"),
    ), "groups")
    rows = hashed.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    return rows.join(told, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each text, one row of the id that stays.

    Rows are known by id and text, so that a repeated id, or a null one, may stay with one text and go with another. Of
    rows that repeat both, one stays.
    """
    keep = exact_groups(docs, id, text).filter("kept").select(
        F.col("doc_id").alias("keep"), F.col("text_sha256").alias("keep_text")).distinct()
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(id).alias("doc_id"), F.sha2(normalised(F.col(text)), 256).alias("text_sha256"))
    same = F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("text_sha256") == F.col("keep_text"))
    rows = rows.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text_sha256"])
    return rows.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
