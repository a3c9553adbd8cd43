"""Dates and timestamps from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shape of a date, year 19xx or 20xx, month 01-12, day 01-31.
DATE_SHAPE = r"^(19|20)\d{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


# The two common formats, which a plain cast reads many times faster than a pattern parser. The cast accepts more
# than the format does, so the text must have its exact shape first.
_CAST_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
}


def to_timestamp_or_null(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp, or null for text that does not fit; count the rejects with ``rejected``."""
    text = F.col(c) if isinstance(c, str) else c
    if fmt in _CAST_SHAPES:
        return F.when(text.rlike(_CAST_SHAPES[fmt]), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(fmt))


def to_date_or_null(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or null for text that does not fit."""
    text = F.col(c) if isinstance(c, str) else c
    if fmt in _CAST_SHAPES:
        return F.when(text.rlike(_CAST_SHAPES[fmt]), text.try_cast("date"))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def rejected(text: str | Column, parsed: str | Column) -> Column:
    """Number of rows whose text is present but did not parse."""
    text, parsed = (F.col(c) if isinstance(c, str) else c for c in (text, parsed))
    return F.count_if(text.isNotNull() & parsed.isNull())


def iso_utc(epoch_seconds: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` of epoch seconds; the session runs in UTC."""
    seconds = F.col(epoch_seconds) if isinstance(epoch_seconds, str) else epoch_seconds
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_ingest_columns(df, at: Column | None = None):
    """Add ``ingest_year``, ``ingest_month``, ``ingest_day`` and ``ingest_hour`` of the processing time."""
    at = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            "ingest_year": F.year(at),
            "ingest_month": F.month(at),
            "ingest_day": F.dayofmonth(at),
            "ingest_hour": F.hour(at),
        }
    )


INGEST_COLUMNS = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]
