"""Seeded pseudo-random numbers that depend on row values only.

They do not change with partitioning or when a lost task runs again, and any SQL engine with md5 gives the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(*parts: Column | str | int) -> Column:
    """Integer in [0, 2^32) from the parts joined with ``:``."""
    columns = [F.col(p) if isinstance(p, str) else p if isinstance(p, Column) else F.lit(p) for p in parts]
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_unit(*parts: Column | str | int) -> Column:
    """Double in [0, 1)."""
    return hash_number(*parts) / F.lit(float(1 << 32))
