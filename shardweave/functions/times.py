"""Time arithmetic that works on TIMESTAMP and TIMESTAMP_NTZ alike and does not
depend on the session time zone."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus_millis(ts: Column, millis: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(millis / 1000))


def millis_between(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end`` (rounded down)."""
    gap = end - start
    seconds = (
        F.extract(F.lit("DAY"), gap) * 86_400
        + F.extract(F.lit("HOUR"), gap) * 3_600
        + F.extract(F.lit("MINUTE"), gap) * 60
    ).cast("long")
    return (
        seconds * 1_000 + F.floor(F.extract(F.lit("SECOND"), gap) * 1_000)
    ).cast("long")


def wall_clock(ts: datetime) -> Column:
    """A TIMESTAMP_NTZ literal with the fields of ``ts``, whatever its zone."""
    return F.lit(ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
