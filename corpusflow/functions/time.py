"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros_ntz(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, read as a wall
    clock (no time zone).  Casting NTZ to TIMESTAMP (or ``timestamp_diff``)
    goes through the session zone, which shifts values and is not monotone
    across a daylight-saving gap; the date and time fields are not."""
    return (F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(86_400_000_000)
            + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(ts).cast("bigint") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint"))
