"""Time expressions. Inputs may be zoned or unzoned; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since the epoch, with the fraction kept."""
    return micros(ts) / F.lit(1000.0)


def from_epoch_ms(ms: Column | str) -> Column:
    """Timestamp of an epoch in milliseconds, cut to whole seconds."""
    seconds = F.floor(_col(ms) / F.lit(1000))
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end``, with the fraction kept."""
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def bucket(ts: Column | str, width_seconds: int) -> Column:
    """Start of the fixed-width bucket, counted from the epoch, that holds ``ts``."""
    width = F.lit(width_seconds * 1_000_000)
    start = micros(ts) - F.pmod(micros(ts), width)
    return F.timestamp_micros(start).cast("timestamp_ntz")


def utc(ts: Column | str) -> Column:
    """An unzoned UTC timestamp, the type all results carry."""
    return _col(ts).cast("timestamp_ntz")
