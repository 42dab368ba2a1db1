"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the model definitions, not from the Spark code: each function
returns a SELECT over named inputs, and :func:`with_ctes` strings them into
one statement over the pre-registered benchmark views. Money sums are exact
sums of doubles (see msum).
"""

from __future__ import annotations

from tripmart.functions.keys import KEY_NULL
from tripmart.schemas import FLAGS, MONEY, TIMESTAMPS
from tripmart.sources.seeds import US_HOLIDAYS

RAW_COLUMNS = ["hvfhs_license_num", *TIMESTAMPS, "PULocationID", "DOLocationID", "trip_miles",
               "trip_time", *MONEY, *FLAGS, "ingestion_ts"]
FACT_MEASURE_COLUMNS = ["trip_id", *TIMESTAMPS, "pulocation_id", "dolocation_id", "trip_miles",
                        "trip_time", *MONEY]

LOAD_1_TS = "TIMESTAMP '2026-02-01 00:00:00'"
LOAD_2_TS = "TIMESTAMP '2027-02-01 00:00:00'"


def key(*exprs: str) -> str:
    parts = [f"coalesce(CAST({e} AS VARCHAR), '{KEY_NULL}')" for e in exprs]
    return "md5(" + " || '-' || ".join(parts) + ")"


#: 2^68: amounts of the benchmark tables are multiples of its inverse.
_UNITS = f"CAST({2 ** 68} AS DOUBLE)"


def msum(expr: str) -> str:
    """Exact sum of doubles: whole multiples of 2^-68 add up as HUGEINT, and
    the total's decimal text is read back as the nearest double."""
    return f"(CAST(CAST(SUM(CAST(({expr}) * {_UNITS} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {_UNITS})"


def mavg(expr: str) -> str:
    return f"({msum(expr)} / COUNT({expr}))"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# --- inputs ---------------------------------------------------------------

RAW_TRIPS = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'HV0005' ELSE 'HV0003' END AS hvfhs_license_num,
  pickup_datetime - INTERVAL 5 MINUTE AS request_datetime,
  CASE WHEN l_linestatus = 'F' THEN pickup_datetime - INTERVAL 2 MINUTE END AS on_scene_datetime,
  pickup_datetime,
  pickup_datetime + to_seconds(trip_time) AS dropoff_datetime,
  CAST(1 + l_partkey % 26 AS INTEGER) AS PULocationID,
  CAST(1 + l_suppkey % 25 AS INTEGER) AS DOLocationID,
  CASE WHEN l_linenumber = 7 AND l_quantity <= 5 THEN CAST(0 AS DOUBLE) ELSE l_quantity / 4 END AS trip_miles,
  CAST(trip_time AS BIGINT) AS trip_time,
  l_extendedprice AS base_passenger_fare,
  CASE WHEN l_linenumber = 3 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls,
  l_discount AS bcf,
  l_tax AS sales_tax,
  CAST(2.75 AS DOUBLE) AS congestion_surcharge,
  CASE WHEN l_partkey % 26 = 0 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS airport_fee,
  l_quantity AS tips,
  l_quantity * CAST(10.5 AS DOUBLE) AS driver_pay,
  CASE WHEN pickup_datetime >= TIMESTAMP '2025-01-05 00:00:00' THEN CAST(1.5 AS DOUBLE) END AS cbd_congestion_fee,
  l_orderkey % 5 = 0 AS shared_request_flag,
  l_orderkey % 10 = 0 AS shared_match_flag,
  CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE FALSE END AS access_a_ride_flag,
  l_linestatus = 'O' AS wav_request_flag,
  l_partkey % 2 = 0 AS wav_match_flag,
  CASE WHEN pickup_datetime < TIMESTAMP '2026-01-01 00:00:00' AND l_linenumber < 7
    THEN TIMESTAMP '2026-02-01 00:00:00' ELSE TIMESTAMP '2027-02-01 00:00:00' END AS ingestion_ts
FROM (SELECT *,
    CASE WHEN l_quantity = 1 THEN 0 ELSE 60 * (1 + (l_partkey * 7 + l_orderkey * 53) % 90) END AS trip_time,
    CAST(DATE '2024-01-01' + CAST(DATEDIFF('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 1096 AS INT) AS TIMESTAMP)
      + to_seconds(600 * ((l_orderkey * 37 + l_partkey * 61 + l_linenumber * 3607) % 144)) AS pickup_datetime
  FROM lineitem) t"""

ZONE_LOOKUP = """
SELECT CAST(n_nationkey + 1 AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
  r_name AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey"""


def holidays_sql() -> str:
    rows = ",\n  ".join("('{}', '{}')".format(d, n.replace("'", "''")) for d, n in US_HOLIDAYS)
    return f"SELECT CAST(d AS DATE) AS holiday_date, n AS holiday_name FROM (VALUES\n  {rows}) v(d, n)"


# --- models ---------------------------------------------------------------

def stg_sql(raw: str, after: str | None = None) -> str:
    cols = [key("pickup_datetime", "dropoff_datetime") + " AS trip_id", *TIMESTAMPS,
            "PULocationID AS pulocation_id", "DOLocationID AS dolocation_id",
            "trip_miles", "trip_time", *MONEY, *FLAGS, "ingestion_ts"]
    where = ["hvfhs_license_num = 'HV0003'", "pickup_datetime IS NOT NULL",
             "dropoff_datetime IS NOT NULL"]
    if after is not None:
        where.append(f"ingestion_ts > ({after})")
    return f"SELECT {', '.join(cols)}\nFROM {raw}\nWHERE {' AND '.join(where)}"


def fact_sql(stg: str) -> str:
    return (f"SELECT {', '.join(FACT_MEASURE_COLUMNS)}, {key(*FLAGS)} AS trip_flags_id\n"
            f"FROM {stg}")


def dim_datetime_sql(stg: str, holidays: str = "holidays") -> str:
    h = "hour(date_hour)"
    return f"""
SELECT {key('date_hour')} AS datetime_key,
  date_hour AS full_timestamp,
  CAST(date_hour AS DATE) AS date_key,
  CAST(year(date_hour) AS INTEGER) AS year,
  CAST(quarter(date_hour) AS INTEGER) AS quarter,
  CAST(month(date_hour) AS INTEGER) AS month,
  CAST(day(date_hour) AS INTEGER) AS day_of_month,
  CAST(dayofweek(date_hour) AS INTEGER) AS day_of_week,
  strftime(date_hour, '%a') AS day_name,
  CAST({h} AS INTEGER) AS hour_24,
  ({h} BETWEEN 7 AND 9 OR {h} BETWEEN 17 AND 19) AS is_peak_hour,
  dayofweek(date_hour) IN (0, 6) AS is_weekend,
  ({h} BETWEEN 22 AND 23 OR {h} BETWEEN 0 AND 5) AS is_night,
  hd.holiday_date IS NOT NULL AS is_holiday,
  hd.holiday_name AS holiday_name
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS date_hour
      FROM (SELECT date_trunc('hour', MIN(pickup_datetime)) AS lo,
                   date_trunc('hour', MAX(pickup_datetime)) AS hi FROM {stg}) b) s
LEFT JOIN {holidays} hd ON CAST(date_hour AS DATE) = hd.holiday_date"""


DIM_TRIP_FLAGS = f"""
SELECT {key(*FLAGS)} AS trip_flags_id, {', '.join(FLAGS)}
FROM (VALUES (TRUE), (FALSE)) a(shared_request_flag)
CROSS JOIN (VALUES (TRUE), (FALSE)) b(shared_match_flag)
CROSS JOIN (VALUES (TRUE), (FALSE)) c(access_a_ride_flag)
CROSS JOIN (VALUES (TRUE), (FALSE)) d(wav_request_flag)
CROSS JOIN (VALUES (TRUE), (FALSE)) e(wav_match_flag)"""

DIM_LOCATION = "SELECT location_id, borough, zone, service_zone FROM zone_lookup"


def _hour_join(fact: str, dd: str) -> str:
    return f"{fact} ft JOIN {dd} dd ON date_trunc('hour', ft.pickup_datetime) = dd.full_timestamp"


def _not_done(target: str | None, lead: str = "WHERE") -> str:
    return f"{lead} dd.date_key NOT IN (SELECT date_key FROM {target})" if target else ""


def daily_sql(fact: str, dd: str, flags: str, done: str | None = None) -> str:
    return f"""
SELECT dd.date_key,
  COUNT(*) AS total_trips,
  {msum('trip_miles')} AS total_trip_miles,
  SUM(trip_time) / 86400 AS total_trip_time_days,
  {msum('base_passenger_fare + tips + tolls + airport_fee + congestion_surcharge + cbd_congestion_fee + sales_tax + bcf')} AS passenger_total_spend,
  {msum('base_passenger_fare + congestion_surcharge + cbd_congestion_fee')} AS platform_gross_revenue,
  {msum('driver_pay + tips')} AS driver_total_earnings,
  {msum('sales_tax + bcf + congestion_surcharge + cbd_congestion_fee + airport_fee')} AS fees_and_taxes,
  {msum('(base_passenger_fare + congestion_surcharge + cbd_congestion_fee) - driver_pay')} AS platform_net_earnings,
  SUM(CASE WHEN pf.shared_match_flag THEN 1 ELSE 0 END) / COUNT(*) * 100 AS percent_shared_rides
FROM {_hour_join(fact, dd)}
JOIN {flags} pf ON ft.trip_flags_id = pf.trip_flags_id
{_not_done(done)}
GROUP BY dd.date_key"""


def driver_sql(fact: str, dd: str, flags: str, done: str | None = None) -> str:
    return f"""
SELECT dd.date_key,
  {mavg('trip_miles')} AS avg_trip_miles,
  AVG(trip_time) AS avg_trip_time_seconds,
  {mavg('driver_pay')} AS avg_driver_pay,
  {mavg('tips')} AS avg_tips,
  {mavg('driver_pay + tips')} AS avg_driver_total,
  {mavg('driver_pay')} / {mavg('trip_miles')} AS avg_pay_per_mile,
  {mavg('driver_pay')} / (AVG(trip_time) / 3600.0) AS avg_pay_per_hour
FROM {_hour_join(fact, dd)}
JOIN {flags} pf ON ft.trip_flags_id = pf.trip_flags_id
WHERE ft.trip_miles > 0 AND ft.trip_time > 0 {_not_done(done, 'AND')}
GROUP BY dd.date_key"""


def flag_sql(fact: str, dd: str, flags: str, done: str | None = None) -> str:
    sums = ",\n  ".join(
        f"CAST(SUM(CASE WHEN {f} THEN 1 ELSE 0 END) AS BIGINT) AS {alias}"
        for f, alias in [("shared_request_flag", "total_shared_rides_requested"),
                         ("shared_match_flag", "total_shared_rides_matched"),
                         ("wav_request_flag", "total_wav_requested"),
                         ("wav_match_flag", "total_wav_matched"),
                         ("access_a_ride_flag", "total_access_a_ride_requested")])
    return f"""
SELECT dd.date_key,
  COUNT(*) AS total_trips,
  {sums}
FROM {_hour_join(fact, dd)}
JOIN {flags} pf ON ft.trip_flags_id = pf.trip_flags_id
WHERE ft.trip_miles > 0 AND ft.trip_time > 0 {_not_done(done, 'AND')}
GROUP BY dd.date_key"""


def geo_sql(fact: str, dd: str, loc: str, done: str | None = None) -> str:
    return f"""
SELECT dd.date_key, dd.year, dd.month, dd.day_of_week, dd.hour_24,
  pu.borough AS pu_borough, pu.zone AS pu_zone, dro.borough AS do_borough, dro.zone AS do_zone,
  COUNT(*) AS trip_count,
  {mavg('trip_miles')} AS avg_trip_miles,
  AVG(trip_time) AS avg_trip_time,
  {mavg('base_passenger_fare')} AS avg_passenger_fare
FROM {_hour_join(fact, dd)}
JOIN {loc} pu ON ft.pulocation_id = pu.location_id
JOIN {loc} dro ON ft.dolocation_id = dro.location_id
{_not_done(done)}
GROUP BY dd.date_key, dd.year, dd.month, dd.day_of_week, dd.hour_24,
  pu_borough, pu_zone, do_borough, do_zone"""


# --- standard chains ----------------------------------------------------------

def base_ctes() -> list[tuple[str, str]]:
    """Inputs and the first-run (full build) models."""
    return [
        ("raw_trips", RAW_TRIPS),
        ("zone_lookup", ZONE_LOOKUP),
        ("holidays", holidays_sql()),
        ("stg_trips", stg_sql("raw_trips")),
        ("fact_trips", fact_sql("stg_trips")),
        ("dim_datetime", dim_datetime_sql("stg_trips")),
        ("dim_trip_flags", DIM_TRIP_FLAGS),
        ("dim_location", DIM_LOCATION),
    ]


def two_load_ctes() -> list[tuple[str, str]]:
    """Models after two incremental runs (load 1, then load 2).

    Run 1 builds everything from load 1. Run 2 stages load-2 rows newer than
    staging's high-water mark and upserts them by trip_id; the fact adds
    staged rows whose trip_id it lacks; the calendar adds missing hours;
    the marts add dates they lack.
    """
    return [
        *base_ctes(),
        ("raw_1", f"SELECT * FROM raw_trips WHERE ingestion_ts = {LOAD_1_TS}"),
        ("raw_2", f"SELECT * FROM raw_trips WHERE ingestion_ts = {LOAD_2_TS}"),
        ("stg_1", stg_sql("raw_1")),
        ("stg_new", stg_sql("raw_2", after="SELECT max(ingestion_ts) FROM stg_1")),
        ("stg_increment", stg_sql("raw_trips", after="SELECT max(ingestion_ts) FROM stg_1")),
        ("stg_2", "SELECT * FROM stg_1 WHERE trip_id NOT IN (SELECT trip_id FROM stg_new)\n"
                  "UNION ALL SELECT * FROM stg_new"),
        ("fact_1", fact_sql("stg_1")),
        ("fact_2", "SELECT * FROM fact_1 UNION ALL\n"
                   f"SELECT * FROM ({fact_sql('stg_2')}) f WHERE trip_id NOT IN (SELECT trip_id FROM fact_1)"),
        ("dd_1", dim_datetime_sql("stg_1")),
        ("dd_2", "SELECT * FROM dd_1 UNION ALL\n"
                 f"SELECT * FROM ({dim_datetime_sql('stg_2')}) d "
                 "WHERE datetime_key NOT IN (SELECT datetime_key FROM dd_1)"),
        ("daily_1", daily_sql("fact_1", "dd_1", "dim_trip_flags")),
        ("daily_2", "SELECT * FROM daily_1 UNION ALL\n"
                    + daily_sql("fact_2", "dd_2", "dim_trip_flags", done="daily_1")),
        ("driver_1", driver_sql("fact_1", "dd_1", "dim_trip_flags")),
        ("driver_2", "SELECT * FROM driver_1 UNION ALL\n"
                     + driver_sql("fact_2", "dd_2", "dim_trip_flags", done="driver_1")),
        ("flag_1", flag_sql("fact_1", "dd_1", "dim_trip_flags")),
        ("flag_2", "SELECT * FROM flag_1 UNION ALL\n"
                   + flag_sql("fact_2", "dd_2", "dim_trip_flags", done="flag_1")),
        ("geo_1", geo_sql("fact_1", "dd_1", "dim_location")),
        ("geo_2", "SELECT * FROM geo_1 UNION ALL\n"
                  + geo_sql("fact_2", "dd_2", "dim_location", done="geo_1")),
    ]


def select_all(cte: str, chain=base_ctes) -> str:
    return with_ctes(chain(), f"SELECT * FROM {cte}")
