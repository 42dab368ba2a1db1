"""Data-quality checks and month-completeness, each one distributed pass.

Checks return small result tables (one row per checked column, key,
relationship or month) rather than raising, so a pipeline can store or
assert on them.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.calendar import hour_floor
from tripmart.operators.joins import bounded_broadcast
from tripmart.schemas import RAW_NOT_NULL

log = logging.getLogger(__name__)

# The raw table's declared freshness.
WARN_AFTER_DAYS, ERROR_AFTER_DAYS = 30, 90


def _status(failed: Column) -> Column:
    return F.when(failed, F.lit("fail")).otherwise(F.lit("pass"))


def not_null_check(df: DataFrame, columns: list[str] = RAW_NOT_NULL) -> DataFrame:
    """(column_name, null_rows, status) per column, from a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.unpivot([], columns, "column_name", "null_rows")
    return rows.withColumn("status", _status(F.col("null_rows") > 0))


def not_null_by_load(loads: DataFrame, columns: list[str] = RAW_NOT_NULL) -> DataFrame:
    """(load_id, ingestion_ts, row_count, column_name, null_rows, status) a load and column.

    From the metrics each load observed while it was written: no raw data is
    read. A load without metrics has NULL counts and the status ``unknown``.
    """
    counts = [F.col(f"null_{c}").alias(c) for c in columns]
    rows = loads.select("load_id", "ingestion_ts", "row_count", *counts).unpivot(
        ["load_id", "ingestion_ts", "row_count"], columns, "column_name", "null_rows")
    return rows.withColumn("status", F.when(F.col("null_rows").isNull(), "unknown").otherwise(
        _status(F.col("null_rows") > 0)))


def not_null_total(loads: DataFrame, raw: DataFrame, present: list[str] | None = None,
                   columns: list[str] = RAW_NOT_NULL) -> DataFrame:
    """:func:`not_null_check` of the whole raw table, from its loads' metrics.

    Only loads without metrics are scanned, by their own partitions: those
    written before metrics were kept, and those in ``present`` (ids of the
    loads that have a folder) which the list of loads lacks. Loads are few:
    their ids reach the driver.
    """
    rows = not_null_by_load(loads, columns).where("null_rows IS NOT NULL").select("column_name", "null_rows")
    known = {r[0]: r[1] for r in loads.select("load_id", "row_count").collect()}
    old = sorted(i for i in {*known, *(present or [])} if known.get(i) is None)
    if old:
        scanned = not_null_check(raw.where(F.col("load_id").isin(old)), columns)
        rows = rows.unionByName(scanned.select("column_name", "null_rows"))
    total = rows.groupBy("column_name").agg(F.sum("null_rows").alias("null_rows"))
    return total.withColumn("status", _status(F.col("null_rows") > 0))


def freshness_check(df: DataFrame, as_of=None, loaded_at: str = "ingestion_ts",
                    warn_days: int = WARN_AFTER_DAYS, error_days: int = ERROR_AFTER_DAYS) -> DataFrame:
    """Age of the newest load against ``as_of`` (default: now).

    One row: max_loaded_at, age_seconds, status -- ``error`` beyond
    ``error_days``, ``warn`` beyond ``warn_days``, else ``pass``. An empty
    table has no newest load and is an ``error``.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    m = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_micros(now) - F.unix_micros(F.col("max_loaded_at"))) / F.lit(1_000_000)
    age = F.floor(age)
    status = (F.when(age.isNull() | (age > error_days * 86400), F.lit("error"))
               .when(age > warn_days * 86400, F.lit("warn"))
               .otherwise(F.lit("pass")))
    return m.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))


def unique_check(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their row counts.

    Partial aggregation collapses each key per task before the shuffle, so
    a key holding a third of all rows still moves one row per task.
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
              .filter(F.col("row_count") > 1))


def relationship_check(fact: DataFrame, dim_datetime: DataFrame, dim_location: DataFrame,
                       dim_trip_flags: DataFrame) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, per relationship.

    One scan of the fact: each dimension's distinct keys are broadcast
    (bounded) with a marker and left-joined; the aggregate counts misses.
    """
    def marker(dim: DataFrame, key: str, alias: str) -> DataFrame:
        keys = dim.select(F.col(key).alias(alias)).distinct().withColumn(f"{alias}_ok", F.lit(True))
        return bounded_broadcast(keys, basis=dim)

    f = fact.select("pulocation_id", "dolocation_id", "trip_flags_id",
                    hour_floor("pickup_datetime").alias("_hour"))
    f = (f.join(marker(dim_location, "location_id", "_pu"), F.col("pulocation_id") == F.col("_pu"), "left")
          .join(marker(dim_location, "location_id", "_do"), F.col("dolocation_id") == F.col("_do"), "left")
          .join(marker(dim_trip_flags, "trip_flags_id", "_fl"), F.col("trip_flags_id") == F.col("_fl"), "left")
          .join(marker(dim_datetime, "full_timestamp", "_hr"), F.col("_hour") == F.col("_hr"), "left"))
    names = {
        "fact_trips.pulocation_id -> dim_location.location_id": "_pu_ok",
        "fact_trips.dolocation_id -> dim_location.location_id": "_do_ok",
        "fact_trips.trip_flags_id -> dim_trip_flags.trip_flags_id": "_fl_ok",
        "fact_trips.pickup_hour -> dim_datetime.full_timestamp": "_hr_ok",
    }
    counts = f.agg(*[F.count_if(F.col(ok).isNull()).alias(ok) for ok in names.values()])
    rows = counts.unpivot([], [F.col(ok).alias(name) for name, ok in names.items()],
                          "relationship", "orphan_rows")
    return rows.withColumn("status", _status(F.col("orphan_rows") > 0))


# --- months ---------------------------------------------------------------

def parse_range(text: str) -> tuple[int, int]:
    """``'a-b'`` -> (a, b); ValueError if malformed."""
    a, b = text.split("-")
    return int(a), int(b)


def month_range(years: str, months: str = "1-12") -> list[tuple[int, int]]:
    """Every (year, month) of a year range and a month range; ValueError for
    months outside 1 to 12 or a range that ends before it begins."""
    y0, y1 = parse_range(years)
    m0, m1 = parse_range(months)
    if not 1 <= m0 <= m1 <= 12 or y1 < y0:
        raise ValueError(f"not a range of months: {years} {months}")
    return [(y, m) for y in range(y0, y1 + 1) for m in range(m0, m1 + 1)]


def month_list(dates: str) -> list[tuple[int, int]]:
    """Comma-separated ``yyyy-mm`` entries; malformed ones are skipped with a warning."""
    out = []
    for item in (d.strip() for d in dates.split(",")):
        if not item:
            continue
        try:
            y, m = (int(x) for x in item.split("-"))
            if not 1 <= m <= 12:
                raise ValueError(item)
            out.append((y, m))
        except ValueError:
            log.warning("skipping invalid month %r", item)
    return out


def _month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def months_frame(spark: SparkSession, months: list[tuple[int, int]]) -> DataFrame:
    rows = sorted({f"{y:04d}-{m:02d}" for y, m in months})
    return spark.createDataFrame([(r,) for r in rows], "month string")


def missing_months(spark: SparkSession, trips: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Target months with no trip at all, sorted.

    Present months are a distinct over the pickup month (partial aggregate,
    at most one row per month per task), from the partition column where
    the table has it, so that no data column is read; the target list is
    parameter-sized.
    """
    at = F.col("pickup_period" if "pickup_period" in trips.columns else "pickup_datetime")
    present = trips.select(_month_text(at).alias("month")).distinct()
    target = months_frame(spark, months)
    return target.join(present, "month", "left_anti").orderBy("month")


def select_months(trips: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Trips whose pickup falls in one of ``months``, as a pushed-down range filter."""
    if not months:
        return trips.filter(F.lit(False))
    pk = F.col("pickup_datetime")
    cond = None
    for y, m in sorted(set(months)):
        lo = F.lit(f"{y:04d}-{m:02d}-01 00:00:00").cast("timestamp_ntz")
        ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
        hi = F.lit(f"{ny:04d}-{nm:02d}-01 00:00:00").cast("timestamp_ntz")
        c = (pk >= lo) & (pk < hi)
        if "pickup_period" in trips.columns:  # prunes partitions of day or month grain
            c = c & (F.col("pickup_period") >= lo.cast("date")) & (F.col("pickup_period") < hi.cast("date"))
        cond = c if cond is None else cond | c
    return trips.filter(cond)
