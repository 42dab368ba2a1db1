"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the benchmark tables (or
data Spark derives from them) in full, and returns a DataFrame whose column
names equal the oracle's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.operators import core, quality, reconcile
from tripmart.operators.staging import high_water_mark, newest_load, stage_trips
from tripmart.plans import oracle as O
from tripmart.plans import catalog, slices
from tripmart.plans.models import FullBuild
from tripmart.plans.pipeline import run_models
from tripmart.plans.warehouse import Warehouse
from tripmart.session import configure, scratch_dir
from tripmart.sources import fixtures, seeds
from tripmart.schemas import RAW_NOT_NULL
from tripmart.sources.ingest import read_loads, read_raw
from tripmart.sources.landing import write_landing
from tripmart.sources.month_files import missing_month_files
from tripmart.streaming.file_stream import ingest_landing

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# --- inputs, staging, star schema -------------------------------------------

@register("raw_trips", O.select_all("raw_trips"))
def q_raw_trips(spark, sf_dir):
    return FullBuild(spark, sf_dir).raw


@register("stg_trips", O.select_all("stg_trips"))
def q_stg_trips(spark, sf_dir):
    return FullBuild(spark, sf_dir).stg


@register("fact_trips", O.select_all("fact_trips"))
def q_fact_trips(spark, sf_dir):
    return FullBuild(spark, sf_dir).fact


@register("dim_datetime", O.select_all("dim_datetime"))
def q_dim_datetime(spark, sf_dir):
    return FullBuild(spark, sf_dir).dim_datetime


@register("dim_location", O.select_all("dim_location"))
def q_dim_location(spark, sf_dir):
    return FullBuild(spark, sf_dir).dim_location


@register("hour_spine", O.with_ctes(O.base_ctes(), "SELECT full_timestamp AS date_hour FROM dim_datetime"))
def q_hour_spine(spark, sf_dir):
    m = FullBuild(spark, sf_dir)
    return core.hour_spine(spark, *core.hour_range(m.stg))


@register("zone_lookup_csv", O.select_all("dim_location"))
def q_zone_lookup_csv(spark, sf_dir):
    """The zone lookup written as the publisher's CSV (its own header), read
    back through the seed reader that standardises the header."""
    configure(spark)
    path = scratch_dir(spark, "seeds", "zone_lookup")
    zones = fixtures.zone_lookup(spark, sf_dir).toDF("LocationID", "Borough", "Zone", "service_zone")
    # A lookup seed is one small file (one row per zone).
    zones.coalesce(1).write.option("header", True).csv(path)
    return core.build_dim_location(seeds.read_zone_lookup_csv(spark, path))


# --- marts ----------------------------------------------------------------

@register("bi_daily_metrics", O.with_ctes(O.base_ctes(), O.daily_sql("fact_trips", "dim_datetime", "dim_trip_flags")))
def q_daily(spark, sf_dir):
    return FullBuild(spark, sf_dir).daily


@register("bi_driver_metrics", O.with_ctes(O.base_ctes(), O.driver_sql("fact_trips", "dim_datetime", "dim_trip_flags")))
def q_driver(spark, sf_dir):
    return FullBuild(spark, sf_dir).driver


@register("bi_flag_metrics", O.with_ctes(O.base_ctes(), O.flag_sql("fact_trips", "dim_datetime", "dim_trip_flags")))
def q_flag(spark, sf_dir):
    return FullBuild(spark, sf_dir).flag


@register("bi_geo_time_metrics", O.with_ctes(O.base_ctes(), O.geo_sql("fact_trips", "dim_datetime", "dim_location")))
def q_geo(spark, sf_dir):
    return FullBuild(spark, sf_dir).geo


# --- incremental: two monthly runs ------------------------------------------

_RUNS: dict[tuple, Warehouse] = {}


def two_load_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse after run 1 (load 1 only) and run 2 (raw holds both loads).

    Built once per session and input folder, in a fresh folder under the
    shared root; the seven two-load queries read from it.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    wh = _RUNS.get(key)
    if wh is not None and wh.exists("bi_geo_time_metrics"):
        return wh
    wh = Warehouse(spark, scratch_dir(spark, "two-load"), grain="month")
    raw = fixtures.raw_trips(spark, sf_dir)
    zones, hol = fixtures.zone_lookup(spark, sf_dir), seeds.holidays(spark)
    run_models(wh, fixtures.raw_trips_load(spark, sf_dir, 1), zones, hol)
    run_models(wh, raw, zones, hol)
    _RUNS[key] = wh
    return wh


@register("stg_fact_drift", O.with_ctes(O.two_load_ctes(), """
SELECT coalesce(s.trip_id, f.trip_id) AS trip_id, coalesce(s.n, 0) AS staged_rows, coalesce(f.n, 0) AS fact_rows
FROM (SELECT trip_id, COUNT(*) AS n FROM stg_2 GROUP BY 1) s
FULL OUTER JOIN (SELECT trip_id, COUNT(*) AS n FROM fact_2 GROUP BY 1) f ON s.trip_id = f.trip_id
WHERE s.n IS DISTINCT FROM f.n"""))
def q_stg_fact_drift(spark, sf_dir):
    """Keys that staging and the fact hold differently often after two loads."""
    wh = two_load_warehouse(spark, sf_dir)
    return reconcile.stg_fact_drift(wh.logical("stg_trips"), wh.logical("fact_trips"))


@register("frozen_date_gap", O.with_ctes(O.two_load_ctes(), """
SELECT * FROM (
  SELECT coalesce(f.date_key, m.date_key) AS date_key, coalesce(f.n, 0) AS fact_trips,
    coalesce(f.unknown, 0) AS unknown_flag_trips, coalesce(m.total_trips, 0) AS mart_trips,
    coalesce(f.n, 0) - coalesce(f.unknown, 0) - coalesce(m.total_trips, 0) AS gap
  FROM (SELECT CAST(pickup_datetime AS DATE) AS date_key, COUNT(*) AS n,
          COUNT(*) FILTER (WHERE trip_flags_id NOT IN (SELECT trip_flags_id FROM dim_trip_flags)) AS unknown
        FROM fact_2 GROUP BY 1) f FULL OUTER JOIN daily_2 m ON f.date_key = m.date_key)
WHERE gap <> 0"""))
def q_frozen_date_gap(spark, sf_dir):
    """Dates whose daily mart was frozen before all their trips came."""
    wh = two_load_warehouse(spark, sf_dir)
    return reconcile.frozen_date_gap(wh.logical("fact_trips"), wh.logical("dim_trip_flags"),
                                     wh.logical("bi_daily_metrics"))


@register("layer_databases", O.with_ctes(O.two_load_ctes(), """
SELECT d.day_name, CAST(SUM(m.total_trips) AS BIGINT) AS total_trips, COUNT(*) AS dates
FROM daily_2 m JOIN (SELECT DISTINCT date_key, day_name FROM dd_2) d ON m.date_key = d.date_key GROUP BY 1"""))
def q_layer_databases(spark, sf_dir):
    """SQL over the layers as databases: trips by day of the week."""
    catalog.register_databases(two_load_warehouse(spark, sf_dir))
    return spark.sql("""
        SELECT d.day_name, SUM(m.total_trips) AS total_trips, COUNT(*) AS dates
        FROM MARTS.BI_DAILY_METRICS m
        JOIN (SELECT DISTINCT date_key, day_name FROM MARTS.DIM_DATETIME) d ON m.date_key = d.date_key
        GROUP BY d.day_name""")


@register("full_refresh", O.with_ctes(
    [*O.two_load_ctes(), ("fact_all", O.fact_sql("stg_2")),
     ("daily_all", O.daily_sql("fact_all", "dd_2", "dim_trip_flags"))], "SELECT * FROM daily_all"))
def q_full_refresh(spark, sf_dir):
    """The daily mart after two loads and a full refresh of the fact: no date is frozen."""
    configure(spark)
    wh = Warehouse(spark, scratch_dir(spark, "refresh"), grain="month")
    raw = fixtures.raw_trips(spark, sf_dir)
    zones, hol = fixtures.zone_lookup(spark, sf_dir), seeds.holidays(spark)
    run_models(wh, fixtures.raw_trips_load(spark, sf_dir, 1), zones, hol)
    run_models(wh, raw, zones, hol, full_refresh=["fact_trips"])
    return wh.logical("bi_daily_metrics")


_ZONE_WINDOW = ("pulocation_id IN (3, 17) AND pickup_datetime >= TIMESTAMP_NTZ '2025-02-10 06:00:00' "
                "AND pickup_datetime < TIMESTAMP_NTZ '2025-08-20 18:00:00'")


@register("zone_window_scan", O.with_ctes(
    O.base_ctes(), "SELECT * FROM fact_trips WHERE " + _ZONE_WINDOW.replace("TIMESTAMP_NTZ", "TIMESTAMP")))
def q_zone_window_scan(spark, sf_dir):
    """Trips of two zones in a time window, from a fact laid out by time and zone: as a
    whole first, then its newest two periods once more by the cells' copy."""
    configure(spark)
    wh = Warehouse(spark, scratch_dir(spark, "recluster"), grain="month")
    wh.overwrite("fact_trips", FullBuild(spark, sf_dir).fact)
    wh.recluster("fact_trips")
    periods = wh.periods_of(wh.logical("fact_trips"))
    wh.recluster("fact_trips", periods=periods[-2:])
    return wh.logical("fact_trips").where(_ZONE_WINDOW)


def _two_load(table: str) -> Builder:
    def build(spark, sf_dir):
        return two_load_warehouse(spark, sf_dir).logical(table)
    build.__name__ = f"q_{table}_two_loads"
    return build


for _table, _cte in [("stg_trips", "stg_2"), ("fact_trips", "fact_2"), ("dim_datetime", "dd_2"),
                     ("bi_daily_metrics", "daily_2"), ("bi_driver_metrics", "driver_2"),
                     ("bi_flag_metrics", "flag_2"), ("bi_geo_time_metrics", "geo_2")]:
    register(f"{_table}_two_loads", O.select_all(_cte, O.two_load_ctes))(_two_load(_table))


@register("stg_trips_day_upsert", O.select_all("stg_2", O.two_load_ctes))
def q_stg_trips_day_upsert(spark, sf_dir):
    """Staging at day grain in four key buckets: load 1, then an upsert of
    everything past its mark."""
    wh = Warehouse(spark, scratch_dir(spark, "day-upsert"), grain="day", key_buckets=4)
    wh.overwrite("stg_trips", stage_trips(fixtures.raw_trips_load(spark, sf_dir, 1)))
    mark = high_water_mark(wh.read("stg_trips"))
    wh.upsert("stg_trips", stage_trips(fixtures.raw_trips(spark, sf_dir), after=mark), "trip_id")
    return wh.logical("stg_trips")


@register("layer_views", O.with_ctes(O.two_load_ctes(), """
SELECT m.year, m.mart_trips, s.staged_trips
FROM (SELECT year(date_key) AS year, CAST(SUM(total_trips) AS BIGINT) AS mart_trips FROM daily_2 GROUP BY 1) m
JOIN (SELECT year(pickup_datetime) AS year, COUNT(*) AS staged_trips FROM stg_2 GROUP BY 1) s ON m.year = s.year"""))
def q_layer_views(spark, sf_dir):
    """SQL over the views of two layers: trips a year in the mart and in staging."""
    two_load_warehouse(spark, sf_dir).register_views()
    return spark.sql("""
        SELECT m.year, m.mart_trips, s.staged_trips
        FROM (SELECT year(date_key) AS year, SUM(total_trips) AS mart_trips
              FROM marts_bi_daily_metrics GROUP BY year(date_key)) m
        JOIN (SELECT year(pickup_datetime) AS year, COUNT(*) AS staged_trips
              FROM staging_stg_trips GROUP BY year(pickup_datetime)) s ON m.year = s.year""")


@register("high_water_mark_filter", O.select_all("stg_increment", O.two_load_ctes))
def q_high_water_mark(spark, sf_dir):
    """Rows a later run stages: the whole raw table past staging's mark after load 1."""
    configure(spark)
    mark = newest_load(stage_trips(fixtures.raw_trips_load(spark, sf_dir, 1)))
    return stage_trips(fixtures.raw_trips(spark, sf_dir), after=mark)


# --- ingest: landing files -> raw table ---------------------------------------

RAW_LOADED = [c for c in O.RAW_COLUMNS if c != "ingestion_ts"]
BLANK_NULL_MONTHS = (6,)   # June files write a missing flag as ' '


_INGESTED: dict[tuple, dict[str, str]] = {}


def ingest_two_loads(spark: SparkSession, sf_dir: str, blank_null_months=()) -> DataFrame:
    """Write each load's monthly files, then run the file stream after each.

    Returns the raw table. The load stamp is the wall clock of each run, so
    results compare on the loaded columns.
    """
    return read_raw(spark, ingest_folders(spark, sf_dir, blank_null_months)["raw"])


def ingest_folders(spark: SparkSession, sf_dir: str, blank_null_months=()) -> dict[str, str]:
    """The landing, raw and quarantine folders after both loads were ingested.

    Built once per session, input folder and kind of files.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, tuple(blank_null_months))
    if key in _INGESTED:
        return _INGESTED[key]
    root = scratch_dir(spark, "ingest")
    raw_path, rejected = f"{root}/RAW/fhv_trips", f"{root}/RAW/_rejected_files"
    for load in (1, 2):
        write_landing(fixtures.raw_trips_load(spark, sf_dir, load), f"{root}/landing/load_{load}",
                      blank_null_months)
        ingest_landing(spark, f"{root}/landing", raw_path, rejected, f"{root}/_checkpoints/landing",
                       grain="month")
    _INGESTED[key] = {"landing": f"{root}/landing", "raw": raw_path, "rejected": rejected}
    return _INGESTED[key]


_FILE_GROUPS = """
SELECT *, ingestion_ts AS load_key, strftime(pickup_datetime, '%Y-%m') AS file_month FROM raw_trips"""
_BAD_FILES = """
SELECT DISTINCT load_key, file_month FROM files
WHERE month(pickup_datetime) IN ({months})
  AND (shared_request_flag IS NULL OR shared_match_flag IS NULL OR access_a_ride_flag IS NULL
       OR wav_request_flag IS NULL OR wav_match_flag IS NULL)"""


@register("stream_file_ingest", O.with_ctes(O.base_ctes(), f"SELECT {', '.join(RAW_LOADED)} FROM raw_trips"))
def q_stream_file_ingest(spark, sf_dir):
    return ingest_two_loads(spark, sf_dir).select(*RAW_LOADED)


@register("file_rejection", O.with_ctes(
    [*O.base_ctes(), ("files", _FILE_GROUPS),
     ("bad_files", _BAD_FILES.format(months=", ".join(map(str, BLANK_NULL_MONTHS))))],
    f"SELECT {', '.join(RAW_LOADED)} FROM files f WHERE NOT EXISTS "
    "(SELECT 1 FROM bad_files b WHERE b.load_key = f.load_key AND b.file_month = f.file_month)"))
def q_file_rejection(spark, sf_dir):
    return ingest_two_loads(spark, sf_dir, BLANK_NULL_MONTHS).select(*RAW_LOADED)


@register("load_stamps", O.with_ctes(O.base_ctes(), """
SELECT row_number() OVER (ORDER BY ingestion_ts) AS load_number, COUNT(*) AS row_count, 1::BIGINT AS stamps,
  TRUE AS stamped_now FROM raw_trips GROUP BY ingestion_ts"""))
def q_load_stamps(spark, sf_dir):
    """Rows and distinct load stamps of each load of the ingested raw table."""
    began = dt.datetime.now(dt.timezone.utc)
    _INGESTED.clear()  # loads of this call, not of an earlier query
    loads = ingest_two_loads(spark, sf_dir).groupBy("load_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("ingestion_ts").alias("stamps"),
        F.min("ingestion_ts").alias("first"))
    # One row a load: the window is over two rows.
    return loads.select(F.row_number().over(Window.orderBy("first")).cast("long").alias("load_number"), "row_count",
                        "stamps", (F.col("first") >= F.lit(began)).alias("stamped_now"))


@register("not_null_by_load", O.with_ctes(
    [*O.base_ctes(), ("per_load", "SELECT ingestion_ts, COUNT(*) AS row_count, "
      + ", ".join(f"COUNT(*) FILTER (WHERE {col} IS NULL) AS {col}" for col in RAW_NOT_NULL)
      + " FROM raw_trips GROUP BY 1")], "\nUNION ALL\n".join(
        f"SELECT row_number() OVER (ORDER BY ingestion_ts) AS load_number, row_count, '{col}' AS column_name, "
        f"{col} AS null_rows, CASE WHEN {col} > 0 THEN 'fail' ELSE 'pass' END AS status FROM per_load"
        for col in RAW_NOT_NULL)))
def q_not_null_by_load(spark, sf_dir):
    """Not-null checks of each load, from the metrics it observed while it was written."""
    loads = read_loads(spark, ingest_folders(spark, sf_dir)["raw"])
    # One row a load and column: the window is over the list of loads.
    number = F.row_number().over(Window.partitionBy("column_name").orderBy("ingestion_ts")).cast("long")
    return quality.not_null_by_load(loads).select(number.alias("load_number"), "row_count", "column_name", "null_rows",
                                                  "status")


# --- data-quality checks and month completeness ----------------------------

FRESHNESS_AS_OF = dt.datetime(2027, 3, 15, tzinfo=dt.timezone.utc)
MISSING_MONTHS_YEARS, MISSING_MONTHS_MONTHS = "2023-2027", "1-12"
SELECTED_DATES = "2024-02, 2025-13, 2026-7, not-a-month"


def _status_sql(expr: str) -> str:
    return f"CASE WHEN {expr} > 0 THEN 'fail' ELSE 'pass' END AS status"


_NOT_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{col}' AS column_name, CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS null_rows, "
    f"{_status_sql(f'COUNT(*) FILTER (WHERE {col} IS NULL)')} FROM raw_trips"
    for col in quality.RAW_NOT_NULL)


@register("not_null_check", O.with_ctes(O.base_ctes(), _NOT_NULL_SQL))
def q_not_null(spark, sf_dir):
    return quality.not_null_check(FullBuild(spark, sf_dir).raw)


_FRESH_AGE = "CAST(floor(epoch(TIMESTAMP '2027-03-15 00:00:00') - epoch(max(ingestion_ts))) AS BIGINT)"
_FRESH_SQL = f"""SELECT max(ingestion_ts) AS max_loaded_at, {_FRESH_AGE} AS age_seconds,
  CASE WHEN {_FRESH_AGE} IS NULL OR {_FRESH_AGE} > {quality.ERROR_AFTER_DAYS} * 86400 THEN 'error'
       WHEN {_FRESH_AGE} > {quality.WARN_AFTER_DAYS} * 86400 THEN 'warn' ELSE 'pass' END AS status
FROM raw_trips"""


@register("freshness_check", O.with_ctes(O.base_ctes(), _FRESH_SQL))
def q_freshness(spark, sf_dir):
    return quality.freshness_check(FullBuild(spark, sf_dir).raw, as_of=FRESHNESS_AS_OF)


@register("unique_check", O.with_ctes(O.base_ctes(), "SELECT trip_id, COUNT(*) AS row_count FROM stg_trips "
                                                     "GROUP BY trip_id HAVING COUNT(*) > 1"))
def q_unique(spark, sf_dir):
    return quality.unique_check(FullBuild(spark, sf_dir).stg, "trip_id")


_RELATIONSHIPS = [
    ("fact_trips.pulocation_id -> dim_location.location_id", "pulocation_id", "SELECT location_id FROM dim_location"),
    ("fact_trips.dolocation_id -> dim_location.location_id", "dolocation_id", "SELECT location_id FROM dim_location"),
    ("fact_trips.trip_flags_id -> dim_trip_flags.trip_flags_id", "trip_flags_id", "SELECT trip_flags_id FROM dim_trip_flags"),
    ("fact_trips.pickup_hour -> dim_datetime.full_timestamp", "date_trunc('hour', pickup_datetime)",
     "SELECT full_timestamp FROM dim_datetime"),
]
_REL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS relationship, CAST(COUNT(*) AS BIGINT) AS orphan_rows, {_status_sql('COUNT(*)')} "
    f"FROM fact_trips WHERE {child} NOT IN ({parent})" for name, child, parent in _RELATIONSHIPS)


@register("relationship_check", O.with_ctes(O.base_ctes(), _REL_SQL))
def q_relationship(spark, sf_dir):
    m = FullBuild(spark, sf_dir)
    return quality.relationship_check(m.fact, m.dim_datetime, m.dim_location, m.dim_trip_flags)


_MISSING_SQL = """SELECT m AS month FROM (
  SELECT strftime(make_date(CAST(y AS INTEGER), CAST(mo AS INTEGER), 1), '%Y-%m') AS m
  FROM range(2023, 2028) t(y), range(1, 13) s(mo)) target
WHERE m NOT IN (SELECT DISTINCT strftime(pickup_datetime, '%Y-%m') FROM raw_trips
                WHERE pickup_datetime IS NOT NULL)"""


@register("missing_months", O.with_ctes(O.base_ctes(), _MISSING_SQL))
def q_missing_months(spark, sf_dir):
    months = quality.month_range(MISSING_MONTHS_YEARS, MISSING_MONTHS_MONTHS)
    return quality.missing_months(spark, FullBuild(spark, sf_dir).raw, months)


@register("missing_month_files", O.with_ctes(
    [*O.base_ctes(), ("files", _FILE_GROUPS),
     ("bad_files", _BAD_FILES.format(months=", ".join(map(str, BLANK_NULL_MONTHS))))], """
SELECT m AS month, COUNT(f.file_month) AS files, COUNT(b.file_month) AS rejected
FROM (SELECT strftime(make_date(CAST(y AS INTEGER), CAST(mo AS INTEGER), 1), '%Y-%m') AS m
      FROM range(2023, 2028) t(y), range(1, 13) s(mo)) target
LEFT JOIN (SELECT DISTINCT load_key, file_month FROM files WHERE file_month IS NOT NULL) f ON f.file_month = m
LEFT JOIN bad_files b ON b.load_key = f.load_key AND b.file_month = f.file_month
GROUP BY m HAVING COUNT(f.file_month) = COUNT(b.file_month)"""))
def q_missing_month_files(spark, sf_dir):
    """Months without a good file after both loads were ingested, files of June with blanks refused."""
    at = ingest_folders(spark, sf_dir, BLANK_NULL_MONTHS)
    months = quality.month_range(MISSING_MONTHS_YEARS, MISSING_MONTHS_MONTHS)
    return missing_month_files(spark, at["landing"], at["rejected"], months)


@register("month_selection", O.with_ctes(
    O.base_ctes(), f"SELECT {', '.join(O.RAW_COLUMNS)} FROM raw_trips "
                   "WHERE strftime(pickup_datetime, '%Y-%m') IN ('2024-02', '2026-07')"))
def q_month_selection(spark, sf_dir):
    return quality.select_months(FullBuild(spark, sf_dir).raw, quality.month_list(SELECTED_DATES))


# --- dashboard slices -----------------------------------------------------

def _mt(col: str) -> str:
    return f"{O.msum(col)} AS {col}"


_MONTHLY_SQL = f"""SELECT CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
  COUNT(*) AS days, CAST(SUM(total_trips) AS BIGINT) AS total_trips,
  {_mt('total_trip_miles')},
  SUM(round(total_trip_time_days * 86400)) / 86400 AS total_trip_time_days,
  {', '.join(_mt(m) for m in slices.DAILY_MONEY)},
  SUM(round(percent_shared_rides * total_trips / 100)) / SUM(total_trips) * 100 AS percent_shared_rides
FROM daily GROUP BY 1, 2"""


@register("monthly_overview", O.with_ctes(
    [*O.base_ctes(), ("daily", O.daily_sql("fact_trips", "dim_datetime", "dim_trip_flags"))], _MONTHLY_SQL))
def q_monthly_overview(spark, sf_dir):
    return slices.monthly_overview(FullBuild(spark, sf_dir).daily)


_PEAK_SQL = f"""SELECT dd.hour_24, dd.is_peak_hour, dd.is_night, dd.is_weekend, dd.is_holiday,
  COUNT(*) AS trip_count, {O.mavg('trip_miles')} AS avg_trip_miles, AVG(trip_time) AS avg_trip_time,
  {O.mavg('base_passenger_fare')} AS avg_passenger_fare
FROM fact_trips ft JOIN dim_datetime dd ON date_trunc('hour', ft.pickup_datetime) = dd.full_timestamp
GROUP BY 1, 2, 3, 4, 5"""


@register("peak_hour_demand", O.with_ctes(O.base_ctes(), _PEAK_SQL))
def q_peak_hour(spark, sf_dir):
    m = FullBuild(spark, sf_dir)
    return slices.peak_hour_demand(m.fact, m.dim_datetime)


_ECON_SQL = f"""SELECT dd.year, dd.month, COUNT(*) AS trips,
  {O.mavg('driver_pay')} AS avg_driver_pay, {O.mavg('driver_pay + tips')} AS avg_driver_total,
  {O.mavg('driver_pay')} / {O.mavg('trip_miles')} AS avg_pay_per_mile,
  {O.mavg('driver_pay')} / (AVG(trip_time) / 3600.0) AS avg_pay_per_hour,
  COUNT(*) FILTER (WHERE pf.shared_match_flag) AS shared_rides,
  COUNT(*) FILTER (WHERE pf.shared_match_flag) / COUNT(*) * 100 AS percent_shared_rides
FROM fact_trips ft JOIN dim_datetime dd ON date_trunc('hour', ft.pickup_datetime) = dd.full_timestamp
JOIN dim_trip_flags pf ON ft.trip_flags_id = pf.trip_flags_id
WHERE ft.trip_miles > 0 AND ft.trip_time > 0
GROUP BY 1, 2"""


@register("driver_economics", O.with_ctes(O.base_ctes(), _ECON_SQL))
def q_driver_economics(spark, sf_dir):
    m = FullBuild(spark, sf_dir)
    return slices.driver_economics(m.fact, m.dim_datetime, m.dim_trip_flags)


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
