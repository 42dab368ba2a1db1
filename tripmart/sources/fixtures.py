"""Trip-shaped inputs derived from the benchmark tables.

One trip per ``lineitem`` row, shifted into 2024-2026 so the holiday
calendar applies; zones come from ``nation`` joined to ``region``. Every
value is a deterministic function of the row (see FIXTURES.md section 3),
so results can be checked exactly against an independent SQL engine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import RAW
from tripmart.sources.tables import read_table

# Fixed values of the mapping (FIXTURES.md section 3).
SHIFT_FROM = "1995-01-01"           # ship dates count days from here ...
SHIFT_TO = "2024-01-01"             # ... and land on this date ...
SHIFT_DAYS = 1096                   # ... modulo three years
SLOT_SECONDS = 600                  # pickups fall on 10-minute slots
CBD_FEE_START = "2025-01-05 00:00:00"
LOAD_SPLIT = "2026-01-01 00:00:00"
LOAD_1_TS = dt.datetime(2026, 2, 1, tzinfo=dt.timezone.utc)
LOAD_2_TS = dt.datetime(2027, 2, 1, tzinfo=dt.timezone.utc)

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                    "l_linestatus", "l_shipdate"]


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_trips`` rows (schema :data:`tripmart.schemas.RAW`) from lineitem.

    A narrow projection: one scan of lineitem's 11 columns, no shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem", *LINEITEM_COLUMNS, parallel=True)
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ln, qty = F.col("l_linenumber"), F.col("l_quantity")

    day = F.date_add(F.lit(SHIFT_TO).cast("date"),
                     (F.datediff(F.col("l_shipdate").cast("date"), F.lit(SHIFT_FROM).cast("date"))
                      % SHIFT_DAYS).cast("int"))
    slot = ((o * 37 + p * 61 + ln * 3607) % 144) * SLOT_SECONDS
    pickup = F.timestamp_add("SECOND", slot, day.cast("timestamp_ntz"))
    trip_time = F.when(qty == 1, F.lit(0).cast("bigint")).otherwise(60 * (1 + (p * 7 + o * 53) % 90))

    base = li.select(*LINEITEM_COLUMNS, pickup.alias("_pickup"), trip_time.alias("_trip_time"))
    pk, tt = F.col("_pickup"), F.col("_trip_time")
    zero, null_d = F.lit(0.0), F.lit(None).cast("double")

    cols = {
        "hvfhs_license_num": F.when(F.col("l_returnflag") == "A", "HV0005").otherwise("HV0003"),
        "request_datetime": F.timestamp_add("MINUTE", F.lit(-5), pk),
        "on_scene_datetime": F.when(F.col("l_linestatus") == "F", F.timestamp_add("MINUTE", F.lit(-2), pk)),
        "pickup_datetime": pk,
        "dropoff_datetime": F.timestamp_add("SECOND", tt, pk),
        "PULocationID": (1 + p % 26).cast("int"),
        "DOLocationID": (1 + s % 25).cast("int"),
        "trip_miles": F.when((ln == 7) & (qty <= 5), zero).otherwise(qty / 4),
        "trip_time": tt,
        "base_passenger_fare": F.col("l_extendedprice"),
        "tolls": F.when(ln == 3, F.lit(6.5)).otherwise(zero),
        "bcf": F.col("l_discount"),
        "sales_tax": F.col("l_tax"),
        "congestion_surcharge": F.lit(2.75),
        "airport_fee": F.when(p % 26 == 0, F.lit(2.5)).otherwise(zero),
        "tips": qty,
        "driver_pay": qty * 10.5,
        "cbd_congestion_fee": F.when(pk >= _ntz(CBD_FEE_START), F.lit(1.5)).otherwise(null_d),
        "shared_request_flag": o % 5 == 0,
        "shared_match_flag": o % 10 == 0,
        "access_a_ride_flag": F.when(s % 50 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(False)),
        "wav_request_flag": F.col("l_linestatus") == "O",
        "wav_match_flag": p % 2 == 0,
        "ingestion_ts": F.when((pk < _ntz(LOAD_SPLIT)) & (ln < 7), F.lit(LOAD_1_TS)).otherwise(F.lit(LOAD_2_TS)),
    }
    return base.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields])


def raw_trips_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Rows of the first (``load=1``) or second (``load=2``) monthly load.

    Load 1 holds pickups before 2026 except line 7; load 2 holds the 2026
    pickups plus the late line-7 rows for earlier dates.
    """
    raw = raw_trips(spark, sf_dir)
    stamp = LOAD_1_TS if load == 1 else LOAD_2_TS
    return raw.filter(F.col("ingestion_ts") == F.lit(stamp))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: location_id = nationkey + 1, borough = service_zone = region, zone = nation."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    # region has one row per region; its size is checked before broadcasting.
    from tripmart.operators.joins import bounded_broadcast
    j = nation.join(bounded_broadcast(region), nation.n_regionkey == region.r_regionkey)
    return j.select((F.col("n_nationkey") + 1).cast("int").alias("location_id"),
                    F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone"),
                    F.col("r_name").alias("service_zone"))
