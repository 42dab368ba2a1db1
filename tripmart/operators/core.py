"""Star schema: trip fact and the datetime, location and trip-flag dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.calendar import calendar_columns, hour_floor
from tripmart.functions.keys import surrogate_key
from tripmart.operators.joins import bounded_broadcast, row_bound, with_row_bound
from tripmart.schemas import DIM_DATETIME, DIM_LOCATION, FACT_TRIPS, FLAGS

# Rows per task when generating the hour spine.
SPINE_ROWS_PER_PARTITION = 200_000


def build_fact(stg: DataFrame) -> DataFrame:
    """Fact rows: staging minus the five flags and the load stamp, plus the
    flag-combination key. A projection: no shuffle."""
    cols = {f.name: F.col(f.name) for f in FACT_TRIPS.fields}
    cols["trip_flags_id"] = surrogate_key(*FLAGS)
    return stg.select(*[cols[f.name].alias(f.name) for f in FACT_TRIPS.fields])


def hour_range(stg: DataFrame, column: str = "pickup_datetime") -> tuple[str | None, int]:
    """First hour (as text) and number of hours covered by ``column``.

    One global MIN/MAX aggregate (partial per task, one row to the driver).
    """
    b = stg.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = hour_floor("lo"), hour_floor("hi")
    row = b.select(lo.cast("string"), F.timestamp_diff("HOUR", lo, hi)).first()
    if row[0] is None:
        return None, 0
    return row[0], int(row[1]) + 1


def hour_spine(spark: SparkSession, first_hour: str | None, hours: int) -> DataFrame:
    """One row per hour, ``date_hour`` TIMESTAMP_NTZ, from ``first_hour`` on.

    Generated with ``spark.range`` over as many tasks as its size needs,
    so no single task or the driver materialises the calendar.
    """
    if first_hour is None or hours <= 0:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias("date_hour"))
    parts = max(1, -(-hours // SPINE_ROWS_PER_PARTITION))
    start = F.lit(first_hour).cast("timestamp_ntz")
    return spark.range(0, hours, 1, parts).select(
        F.timestamp_add("HOUR", F.col("id"), start).alias("date_hour"))


def build_dim_datetime(stg: DataFrame, holidays: DataFrame,
                       span: tuple[str | None, int] | None = None) -> DataFrame:
    """Hour calendar from the first to the last staged pickup hour.

    Each hour carries date parts, peak/night/weekend flags and, through a
    left join on the date, the holiday flag and name. ``span`` (first hour,
    hours) overrides the range computed from ``stg``.
    """
    spark = stg.sparkSession
    first_hour, hours = span or hour_range(stg)
    spine = hour_spine(spark, first_hour, hours)
    hol = bounded_broadcast(holidays.select("holiday_date", "holiday_name"), basis=holidays)
    j = spine.join(hol, spine.date_hour.cast("date") == hol.holiday_date, "left")
    cols = calendar_columns("date_hour") + [
        F.col("holiday_date").isNotNull().alias("is_holiday"),
        F.col("holiday_name"),
    ]
    out = j.select(*cols)
    out = out.select(*[F.col(f.name).cast(f.dataType) for f in DIM_DATETIME.fields])
    # Left join: each hour survives once, and a holiday row can add at most
    # its date's 24 hours -- a proven bound without counting.
    return with_row_bound(out, hours + 24 * row_bound(holidays))


def build_dim_location(zone_lookup: DataFrame) -> DataFrame:
    return zone_lookup.select(*[F.col(f.name).cast(f.dataType) for f in DIM_LOCATION.fields])


FLAG_COMBINATIONS = 2 ** len(FLAGS)


def build_dim_trip_flags(spark: SparkSession) -> DataFrame:
    """All 32 TRUE/FALSE combinations of the five flags, keyed like the fact.

    Bit i of 0..31 is flag i: the full combination set without a cross join.
    """
    n = len(FLAGS)
    bits = [((F.col("id").bitwiseAND(1 << (n - 1 - i))) != 0).alias(c) for i, c in enumerate(FLAGS)]
    combos = spark.range(0, FLAG_COMBINATIONS, 1, 1).select(*bits)
    return with_row_bound(combos.select(surrogate_key(*FLAGS).alias("trip_flags_id"), *FLAGS),
                          FLAG_COMBINATIONS)
