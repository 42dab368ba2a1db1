"""Staging: filter, rename and key the raw trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.keys import surrogate_key
from tripmart.schemas import FLAGS, MEASURES, STG_TRIPS, TIMESTAMPS

# Fixed value: the operator licence kept in staging (HV0003).
LICENCE = "HV0003"

FIRST_RUN = object()
"""Marker for :func:`stage_trips`: no target yet, stage everything."""


def high_water_mark(stg: DataFrame):
    """``max(ingestion_ts)`` of the staging table as epoch microseconds.

    NULL (``None``) when the table is empty. Returned as an integer so the
    value round-trips through the driver without any zone conversion.
    """
    return stg.agg(F.unix_micros(F.max("ingestion_ts"))).first()[0]


def newest_load(stg: DataFrame) -> DataFrame:
    """The high-water mark as a table of one row, for a subquery (see :func:`stage_trips`)."""
    return stg.agg(F.max("ingestion_ts"))


def stage_trips(raw: DataFrame, after=FIRST_RUN, licence: str = LICENCE) -> DataFrame:
    """Staging rows from raw rows.

    Keeps one operator's trips with both pickup and dropoff present, keys
    each trip by ``surrogate_key(pickup, dropoff)`` and renames the location
    columns. On later runs pass ``after`` = :func:`high_water_mark` of the
    target: only rows loaded strictly later pass, and a NULL mark (empty
    target) passes nothing. A table of one value, as :func:`newest_load` gives,
    becomes a scalar subquery: it is computed inside the same job and its
    value filters the scan. The filters are plain column predicates, so they
    reach the Parquet scan as pushed filters.
    """
    df = raw
    if after is not FIRST_RUN:
        mark = after.scalar() if isinstance(after, DataFrame) else F.timestamp_micros(F.lit(after).cast("bigint"))
        df = df.filter(F.col("ingestion_ts") > mark)
    df = df.filter((F.col("hvfhs_license_num") == licence)
                   & F.col("pickup_datetime").isNotNull()
                   & F.col("dropoff_datetime").isNotNull())
    cols = {
        "trip_id": surrogate_key("pickup_datetime", "dropoff_datetime"),
        **{c: F.col(c) for c in TIMESTAMPS},
        "pulocation_id": F.col("PULocationID"),
        "dolocation_id": F.col("DOLocationID"),
        **{c: F.col(c) for c in MEASURES},
        **{c: F.col(c) for c in FLAGS},
        "ingestion_ts": F.col("ingestion_ts"),
    }
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in STG_TRIPS.fields])
