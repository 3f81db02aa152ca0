"""F2-F8: timestamp parsing, calendar features and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_iso_ts(s: Column | str) -> Column:
    """ISO-8601 text (``T`` or space separator, with or without
    fractional seconds) -> TIMESTAMP.

    The cast parser accepts both separators and both layouts, so no
    ``regexp_replace('T', ' ')`` pass is needed, and it raises no per-row
    exceptions; ``try_`` keeps ANSI mode from failing the job on a bad row,
    which gets NULL instead.
    """
    return _c(s).try_cast("timestamp")


def parse_two_layouts(s: Column | str) -> Column:
    """F2: ISO text by explicit pattern, with microseconds or else without; NULL
    if neither fits."""
    layouts = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(*[F.try_to_timestamp(_c(s), F.lit(p)) for p in layouts])


def time_features(ts: Column | str) -> dict[str, Column]:
    """Hour, weekday (1=Sunday..7=Saturday), weekend flag, date."""
    t = _c(ts)
    dow = F.dayofweek(t)
    return {
        "event_hour": F.hour(t),
        "event_day_of_week": dow,
        "is_weekend": F.when(dow.isin(1, 7), F.lit(True)).otherwise(F.lit(False)),
        "event_date": F.to_date(t),
    }


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds (F7 semantics: sub-second parts are cut)."""
    return F.unix_timestamp(_c(ts).cast("timestamp"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """(unix_timestamp(end) - unix_timestamp(start)) / 60 as double."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")
