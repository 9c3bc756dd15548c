"""Date and timestamp expressions that do not depend on the session zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(value: Column) -> Column:
    """Calendar day of a date, zoneless timestamp or text; NULL for bad text."""
    return value.try_cast("date")


def second_of(value: Column) -> Column:
    """Zoneless timestamp with the sub-second part cut off.

    ``date_trunc`` goes through a zoned timestamp and moves wall-clock times
    that fall into a daylight-saving gap of the session zone. Whole seconds
    since 1970 need no zone and are as fast; they round up before 1970, where
    the fraction is subtracted instead.
    """
    stamp = value.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    since_epoch = F.unix_timestamp(stamp) * F.lit(timedelta(seconds=1))
    fraction = F.extract(F.lit("SECOND"), stamp) % 1
    return F.when(stamp >= epoch, epoch + since_epoch).otherwise(
        stamp - F.make_dt_interval(secs=fraction)
    )


def stamp_literal(value: datetime) -> Column:
    """Zoneless literal; ``lit(datetime)`` would shift it by the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
