"""Seed tables: public holiday calendar and the zone lookup CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import DIM_LOCATION, HOLIDAYS

# The US federal holidays the calendar dimension marks
# (11 per year, 2024-2026), as (date, name). Names must match exactly.
US_HOLIDAYS = [
    ("2024-01-01", "New Year's Day"),
    ("2024-01-15", "Martin Luther King Jr. Day"),
    ("2024-02-19", "Washington's Birthday (Presidents' Day)"),
    ("2024-05-27", "Memorial Day"),
    ("2024-06-19", "Juneteenth"),
    ("2024-07-04", "Independence Day"),
    ("2024-09-02", "Labor Day"),
    ("2024-10-14", "Columbus Day / Indigenous Peoples' Day"),
    ("2024-11-11", "Veterans Day"),
    ("2024-11-28", "Thanksgiving Day"),
    ("2024-12-25", "Christmas Day"),
    ("2025-01-01", "New Year's Day"),
    ("2025-01-20", "Martin Luther King Jr. Day"),
    ("2025-02-17", "Washington's Birthday (Presidents' Day)"),
    ("2025-05-26", "Memorial Day"),
    ("2025-06-19", "Juneteenth"),
    ("2025-07-04", "Independence Day"),
    ("2025-09-01", "Labor Day"),
    ("2025-10-13", "Columbus Day / Indigenous Peoples' Day"),
    ("2025-11-11", "Veterans Day"),
    ("2025-11-27", "Thanksgiving Day"),
    ("2025-12-25", "Christmas Day"),
    ("2026-01-01", "New Year's Day"),
    ("2026-01-19", "Martin Luther King Jr. Day"),
    ("2026-02-16", "Washington's Birthday (Presidents' Day)"),
    ("2026-05-25", "Memorial Day"),
    ("2026-06-19", "Juneteenth"),
    ("2026-07-04", "Independence Day"),
    ("2026-09-07", "Labor Day"),
    ("2026-10-12", "Columbus Day / Indigenous Peoples' Day"),
    ("2026-11-11", "Veterans Day"),
    ("2026-11-26", "Thanksgiving Day"),
    ("2026-12-25", "Christmas Day"),
]

ZONE_HEADER = ["location_id", "borough", "zone", "service_zone"]


def holidays(spark: SparkSession) -> DataFrame:
    """The built-in holiday calendar as (holiday_date DATE, holiday_name)."""
    from tripmart.operators.joins import with_row_bound
    rows = [(dt.date.fromisoformat(d), n) for d, n in US_HOLIDAYS]
    return with_row_bound(spark.createDataFrame(rows, HOLIDAYS), len(rows))


def read_holidays_csv(spark: SparkSession, path: str) -> DataFrame:
    """A holiday CSV with header ``holiday_date,holiday_name[,...]``."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col("holiday_date").cast("date").alias("holiday_date"),
                      F.col("holiday_name"))


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """The taxi-zone lookup CSV, header standardised.

    The publisher's header (LocationID, Borough, Zone, service_zone) is
    replaced by ``location_id,borough,zone,service_zone`` unless it already
    mentions ``location_id``; columns are matched by position. Text such as
    ``N/A`` stays text (only empty fields read as NULL).
    """
    raw = spark.read.option("header", True).csv(path)
    if "location_id" not in ",".join(raw.columns).lower():
        raw = raw.toDF(*ZONE_HEADER, *raw.columns[len(ZONE_HEADER):])
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_LOCATION.fields])
