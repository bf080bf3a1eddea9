"""ISO text and instants. All of it assumes the session time zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from signalmill.schemas import ISO_PATTERN


def parse_instant(text: Column) -> Column:
    """Instant of an ISO date-time; null for anything else.

    ``Z`` and numeric offsets are converted, a text without zone is read as UTC. The pattern
    comes first because the cast alone takes ``14:30`` for today and a bare date for midnight.
    """
    return F.when(text.rlike(ISO_PATTERN), F.upper(text).try_cast("timestamp"))


def iso_seconds(instant: Column) -> Column:
    """``2026-06-05T14:30:00Z``, with microseconds only where there are any."""
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("Z")).otherwise(F.format_string(".%06dZ", micros))
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def lag_seconds(as_of: Column, instant: Column) -> Column:
    """Seconds from ``instant`` to ``as_of``, never below zero, null without an instant."""
    seconds = (F.unix_micros(as_of) - F.unix_micros(instant)) / F.lit(1e6)
    return F.when(instant.isNotNull(), F.greatest(F.lit(0.0), seconds))


def as_instant(value) -> Column:
    """A Column, an ISO text or a datetime as an instant; None is now. Without zone it is UTC."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.current_timestamp()
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")
