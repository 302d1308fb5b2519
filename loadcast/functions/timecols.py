"""Timestamp expressions. Event time is UTC; sessions run in UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that mean "no timestamp given".
NO_TIMESTAMP_WORDS = ("", "none", "null", "no")

QUARTER_HOUR = 15 * 60
HOUR = 3600
DAY = 24 * HOUR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch_ms(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c))


def to_epoch_ms(c: Column | str) -> Column:
    return F.unix_millis(_col(c))


def epoch_s(ts: Column | str) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(_col(ts))


def floor_to(ts: Column | str, seconds: int = QUARTER_HOUR) -> Column:
    """Start of the left-closed bin of the given length that holds ``ts``."""
    s = epoch_s(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds)))


def floor_15m(ts: Column | str) -> Column:
    return floor_to(ts, QUARTER_HOUR)


def to_local(ts: Column | str, tz: str) -> Column:
    """UTC instant -> wall-clock time of ``tz``."""
    return F.from_utc_timestamp(_col(ts), tz)


def local_to_utc(ts_local: Column | str, tz: str) -> Column:
    return F.to_utc_timestamp(_col(ts_local), tz)


def local_date(ts: Column | str, tz: str) -> Column:
    return F.to_date(to_local(ts, tz))


def shift(ts: Column | str, seconds: Column | int) -> Column:
    """``ts`` plus an absolute number of seconds, keeping fractions of a second."""
    s = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(_col(ts)) + s.cast("bigint") * F.lit(1_000_000))


def parse_ts(text: Column | str) -> Column:
    """Timestamp text -> UTC timestamp; the no-timestamp words and unreadable text give NULL."""
    trimmed = F.trim(_col(text))
    return F.when(F.lower(trimmed).isin(*NO_TIMESTAMP_WORDS), F.lit(None).cast("timestamp")).otherwise(
        F.try_to_timestamp(trimmed)
    )


def market_stamp(day: Column | str, position: Column | str, step_s: int, tz: str) -> Column:
    """UTC stamp of the ``position``-th price of a local market day.

    Steps are absolute, counted from local midnight, so days of 23 and 25 hours get as many
    distinct stamps as they have steps.
    """
    midnight = F.to_utc_timestamp(_col(day).cast("timestamp"), tz)
    return F.timestamp_seconds(epoch_s(midnight) + _col(position).cast("bigint") * F.lit(step_s))
