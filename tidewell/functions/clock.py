"""Wall-clock times (TIMESTAMP_NTZ) as UTC instants and back, whatever the session zone.

Watermarks need TIMESTAMP, and a cast to it reads a wall clock in the session zone, where an hour
may be missing or come twice. Read as UTC every wall-clock time is an instant of its own, and
differences between them are what the clock shows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import column


def to_wall_time(c: Column | str) -> Column:
    """``2019-10-12 09:00:02`` to TIMESTAMP_NTZ as written, NULL when unparsable; a zone is dropped."""
    return column(c).try_cast("timestamp_ntz")


def wall_to_instant(c: Column | str) -> Column:
    """TIMESTAMP_NTZ to the TIMESTAMP at which UTC clocks show it."""
    c = column(c)
    date = [F.year(c), F.month(c), F.day(c)]
    time = [F.hour(c), F.minute(c), F.extract(F.lit("SECOND"), c)]
    return F.make_timestamp(*date, *time, F.lit("UTC"))


def instant_to_wall(c: Column | str) -> Column:
    """TIMESTAMP to what UTC clocks show, as TIMESTAMP_NTZ: the inverse of ``wall_to_instant``."""
    micros = F.unix_micros(column(c)).cast("decimal(20,0)")
    zero = F.lit(0)
    seconds = (micros / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
