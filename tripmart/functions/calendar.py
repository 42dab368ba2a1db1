"""Calendar expressions on TIMESTAMP_NTZ, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.functions.keys import surrogate_key


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying TIMESTAMP_NTZ.

    ``date_trunc`` goes through the session zone and returns a zoned
    timestamp, which shifts wall-clock times in DST gaps. Date plus hours is
    pure arithmetic on the wall clock.
    """
    ts = _col(ts)
    return F.timestamp_add("HOUR", F.hour(ts), ts.cast("date").cast("timestamp_ntz"))


def period_of(ts, grain: str) -> Column:
    """Storage partition value (DATE) of a timestamp: its day or its month."""
    d = _col(ts).cast("date")
    if grain == "day":
        return d
    if grain == "month":
        return F.trunc(d, "month")
    raise ValueError(f"unknown partition grain {grain!r}")


def calendar_columns(date_hour) -> list[Column]:
    """The hour-grain calendar attributes, in dimension column order.

    Day of week is 0 = Sunday .. 6 = Saturday; day names are three letters.
    Peak hours are 7-9 and 17-19, night is 22-23 and 0-5 (inclusive), the
    weekend is Saturday and Sunday.
    """
    h = _col(date_hour)
    hour = F.hour(h)
    dow = F.dayofweek(h) - 1
    return [
        surrogate_key(h).alias("datetime_key"),
        h.alias("full_timestamp"),
        h.cast("date").alias("date_key"),
        F.year(h).alias("year"),
        F.quarter(h).alias("quarter"),
        F.month(h).alias("month"),
        F.dayofmonth(h).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.dayname(h).alias("day_name"),
        hour.alias("hour_24"),
        (hour.between(7, 9) | hour.between(17, 19)).alias("is_peak_hour"),
        dow.isin(0, 6).alias("is_weekend"),
        (hour.between(22, 23) | hour.between(0, 5)).alias("is_night"),
    ]
