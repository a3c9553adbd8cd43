"""Joins that keep hot keys apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01  # a key with more than this share of the rows is hot; at most 1 / HOT_SHARE keys can be
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 16 << 20


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null; ``right`` is broadcast, so its size must be bounded."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(F.broadcast(renamed), same, how).drop(*[f"_r_{k}" for k in keys])


def is_hot(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> Column | None:
    """Condition that a row's key holds more than ``share`` of all rows, or None when no key does.

    One pass with a small sketch per task, which finds every key well above its error of a small part of a
    percent; the keys themselves are not shuffled, and at most ``1 / share`` of them reach the driver. A key close
    to the limit may fall on either side, which changes how rows travel but not what comes out.
    """
    item = F.col(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*keys))
    most = max(1, int(1 / share))
    found = df.select(item.alias("item")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(item, {most}, {max(8192, 8 * most)})").alias("top")
    ).first()
    hot = [t["item"] for t in found["top"] if t["count"] > found["n"] * share]
    if not hot:
        return None
    listed = F.coalesce(item.isin([h for h in hot if h is not None]), F.lit(False))
    return listed | item.isNull() if None in hot else listed


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame has at most so many rows and bytes as text.

    ``take`` reads partitions one after the other and stops, so that a large frame costs about one partition; only
    row widths reach the driver.
    """
    widths = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("w")).take(max_rows + 1)
    return len(widths) <= max_rows and sum(r["w"] for r in widths) <= max_bytes


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", share: float = HOT_SHARE,
    tasks: int | None = None,
) -> DataFrame:
    """Join facts to a lookup with one row per key, where a few keys may hold most of the facts.

    A lookup of checked small size is broadcast. Otherwise facts under a hot key meet the few lookup rows of those
    keys by broadcast and stay where they are, and the rest is a shuffled join. Null keys match nothing, however
    many there are. ``how`` is one of inner, left, left_semi and left_anti. ``tasks`` are those of the shuffled join, by
    default as many as the session's shuffles have.
    """
    on = list(keys)
    if is_small(lookup):
        return facts.join(F.broadcast(lookup), on, how)
    if facts.isStreaming:  # keys of a stream cannot be counted ahead; adaptive execution splits skewed batches
        return facts.join(lookup, on, how)
    hot = is_hot(facts, keys, share)
    rest = facts if hot is None else facts.filter(~hot)
    rest = rest.repartition(tasks, *on).join(lookup.repartition(tasks, *on), on, how) if tasks else rest.join(lookup, on, how)
    if hot is None:
        return rest
    return facts.filter(hot).join(F.broadcast(lookup.filter(hot)), on, how).unionByName(rest)
