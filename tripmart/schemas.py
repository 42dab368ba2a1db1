"""Declared schemas of every table (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
B, NTZ, TS, DATE = T.BooleanType(), T.TimestampNTZType(), T.TimestampType(), T.DateType()

TIMESTAMPS = ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime"]
MONEY = ["base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
         "airport_fee", "tips", "driver_pay", "cbd_congestion_fee"]
MEASURES = ["trip_miles", "trip_time", *MONEY]
FLAGS = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag",
         "wav_request_flag", "wav_match_flag"]

# The raw table's declared not-null checks.
RAW_NOT_NULL = ["pickup_datetime", "PULocationID", "DOLocationID"]


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw trip table: 23 fields read from the files plus the load stamp.
RAW = _struct([
    ("hvfhs_license_num", S),
    *[(c, NTZ) for c in TIMESTAMPS],
    ("PULocationID", I), ("DOLocationID", I),
    ("trip_miles", D), ("trip_time", L),
    *[(c, D) for c in MONEY],
    *[(c, B) for c in FLAGS],
    ("ingestion_ts", TS),
])

# Physical layout of the monthly landing files as the publisher writes them:
# wide integers, flags as text. Older files lack cbd_congestion_fee.
LANDING = _struct([
    ("hvfhs_license_num", S),
    *[(c, NTZ) for c in TIMESTAMPS],
    ("PULocationID", L), ("DOLocationID", L),
    ("trip_miles", D), ("trip_time", L),
    *[(c, D) for c in MONEY],
    *[(c, S) for c in FLAGS],
])

STG_TRIPS = _struct([
    ("trip_id", S),
    *[(c, NTZ) for c in TIMESTAMPS],
    ("pulocation_id", I), ("dolocation_id", I),
    ("trip_miles", D), ("trip_time", L),
    *[(c, D) for c in MONEY],
    *[(c, B) for c in FLAGS],
    ("ingestion_ts", TS),
])

FACT_TRIPS = _struct([
    ("trip_id", S),
    *[(c, NTZ) for c in TIMESTAMPS],
    ("pulocation_id", I), ("dolocation_id", I),
    ("trip_miles", D), ("trip_time", L),
    *[(c, D) for c in MONEY],
    ("trip_flags_id", S),
])

DIM_DATETIME = _struct([
    ("datetime_key", S), ("full_timestamp", NTZ), ("date_key", DATE),
    ("year", I), ("quarter", I), ("month", I), ("day_of_month", I),
    ("day_of_week", I), ("day_name", S), ("hour_24", I),
    ("is_peak_hour", B), ("is_weekend", B), ("is_night", B),
    ("is_holiday", B), ("holiday_name", S),
])

DIM_LOCATION = _struct([("location_id", I), ("borough", S), ("zone", S), ("service_zone", S)])

DIM_TRIP_FLAGS = _struct([("trip_flags_id", S), *[(c, B) for c in FLAGS]])

HOLIDAYS = _struct([("holiday_date", DATE), ("holiday_name", S)])

BI_DAILY = _struct([
    ("date_key", DATE), ("total_trips", L), ("total_trip_miles", D),
    ("total_trip_time_days", D), ("passenger_total_spend", D),
    ("platform_gross_revenue", D), ("driver_total_earnings", D),
    ("fees_and_taxes", D), ("platform_net_earnings", D), ("percent_shared_rides", D),
])

BI_DRIVER = _struct([
    ("date_key", DATE), ("avg_trip_miles", D), ("avg_trip_time_seconds", D),
    ("avg_driver_pay", D), ("avg_tips", D), ("avg_driver_total", D),
    ("avg_pay_per_mile", D), ("avg_pay_per_hour", D),
])

BI_FLAG = _struct([
    ("date_key", DATE), ("total_trips", L), ("total_shared_rides_requested", L),
    ("total_shared_rides_matched", L), ("total_wav_requested", L),
    ("total_wav_matched", L), ("total_access_a_ride_requested", L),
])

BI_GEO = _struct([
    ("date_key", DATE), ("year", I), ("month", I), ("day_of_week", I), ("hour_24", I),
    ("pu_borough", S), ("pu_zone", S), ("do_borough", S), ("do_zone", S),
    ("trip_count", L), ("avg_trip_miles", D), ("avg_trip_time", D), ("avg_passenger_fare", D),
])


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    """``schema`` plus one nullable field (used for partition columns)."""
    return T.StructType([*schema.fields, T.StructField(name, dtype, True)])
