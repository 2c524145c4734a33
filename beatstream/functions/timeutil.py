"""Time conversions that do not depend on the session time zone.

The data model's event times are ``timestamp_ntz`` (wall-clock, no zone).  Casting
them to ``timestamp`` reads the wall clock in the session zone, so window
boundaries and epoch arithmetic would move with ``spark.sql.session.timeZone``.
These helpers treat the wall clock as UTC instead, exactly (microseconds kept).
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz_micros(c: Column) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz``, its wall clock read as UTC."""
    frac = (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    # unix_timestamp truncates toward zero: step back one second before the epoch
    before = (c < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")) & (frac > 0)
    secs = F.unix_timestamp(c).cast("long") - F.when(before, F.lit(1)).otherwise(F.lit(0))
    return secs * F.lit(1_000_000) + frac


def ntz_to_instant(c: Column) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` whose UTC wall clock equals the input
    (what event-time watermarks need), independent of the session zone."""
    return F.timestamp_micros(ntz_micros(c))


def micros_to_ntz(us: Column) -> Column:
    """``timestamp_ntz`` that lies ``us`` microseconds after the epoch's wall clock."""
    seconds = (us.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def instant_to_ntz(c: Column) -> Column:
    """Inverse of ``ntz_to_instant``: the UTC wall clock of a ``timestamp``.

    Counted from the epoch, so no zone with skipped or repeated hours comes into it."""
    return micros_to_ntz(F.unix_micros(c))


UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """Whole seconds of a duration like ``30 minutes``."""
    number, unit = text.split()
    return int(number) * UNIT_SECONDS[unit.lower().rstrip("s")]


def pane_width(length: str, slide: str) -> str:
    """The longest span that lies whole in the same windows of ``length`` every ``slide``."""
    return f"{gcd(duration_seconds(length), duration_seconds(slide))} seconds"
