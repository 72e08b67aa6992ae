"""Local time by the rules of time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(instant: Column, zone: str) -> Column:
    """The wall clock of a zone at an instant (a timestamp in a session of UTC)."""
    return F.from_utc_timestamp(instant, zone)


def ambiguous(instant: Column, zone: str) -> Column:
    """Whether the zone's wall clock shows the same an hour before or after: its clocks went back."""
    own = local_time(instant, zone)
    return (own == local_time(F.timestamp_add("HOUR", F.lit(1), instant), zone)) | (own == local_time(F.timestamp_add("HOUR", F.lit(-1), instant), zone))


def offset_changes(first: Column, last: Column, zone: str) -> Column:
    """Whether the zone's distance from UTC differs between two instants."""
    offset = lambda c: F.unix_timestamp(local_time(c, zone)) - F.unix_timestamp(c)
    return offset(first) != offset(last)
