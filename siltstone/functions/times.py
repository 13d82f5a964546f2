"""Conversions from epoch milliseconds. Whole seconds are kept, milliseconds are dropped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_from_epoch_ms(millis: Column | str) -> Column:
    """Timestamp in whole seconds; ``div`` truncates toward zero, also before 1970."""
    millis = F.col(millis) if isinstance(millis, str) else millis
    return F.timestamp_seconds(F.call_function("div", millis.try_cast("long"), F.lit(1000)))


def date_from_epoch_ms(millis: Column | str) -> Column:
    """Calendar date in the session time zone."""
    return F.to_date(timestamp_from_epoch_ms(millis))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` as BIGINT."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return end.cast("timestamp").cast("long") - start.cast("timestamp").cast("long")
