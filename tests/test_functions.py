"""Column functions: keys, calendar, casts."""

from __future__ import annotations

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.functions import (KEY_NULL, calendar_columns, hour_floor, period_of, range_checked_int, surrogate_key, text_to_bool)


def test_surrogate_key_contract(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-01-01 00:30:00' AS a, CAST(NULL AS timestamp_ntz) AS b,
                             true AS c""")
    got = df.select(surrogate_key("a", "b", "c").alias("k")).first().k
    want = hashlib.md5(f"2024-01-01 00:30:00-{KEY_NULL}-true".encode()).hexdigest()
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2100, 1, 1)),
       st.integers(min_value=0, max_value=86400))
def test_surrogate_key_deterministic(spark, pickup, seconds):
    pickup = pickup.replace(microsecond=0)
    dropoff = pickup + dt.timedelta(seconds=seconds)
    text = f"{pickup:%Y-%m-%d %H:%M:%S}-{dropoff:%Y-%m-%d %H:%M:%S}"
    df = spark.createDataFrame([(pickup, dropoff), (pickup, dropoff)], "p timestamp_ntz, d timestamp_ntz")
    keys = {r.k for r in df.select(surrogate_key("p", "d").alias("k")).collect()}
    assert keys == {hashlib.md5(text.encode()).hexdigest()}


def test_hour_floor_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:37 on 2024-03-10 does not exist in New York; a wall-clock floor still gives 02:00.
        row = spark.sql("SELECT timestamp_ntz'2024-03-10 02:37:15' AS t").select(hour_floor("t").alias("h")).first()
        assert row.h == dt.datetime(2024, 3, 10, 2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_period_of(spark):
    row = spark.sql("SELECT timestamp_ntz'2025-07-19 23:59:59' AS t").select(
        period_of("t", "day").alias("d"), period_of("t", "month").alias("m")).first()
    assert (row.d, row.m) == (dt.date(2025, 7, 19), dt.date(2025, 7, 1))


def test_calendar_flags(spark):
    hours = [6, 7, 9, 10, 16, 17, 19, 20, 21, 22, 23, 0, 5]
    rows = [(dt.datetime(2026, 7, 3, h),) for h in hours] + [(dt.datetime(2026, 7, 4, 12),)]
    df = spark.createDataFrame(rows, "h timestamp_ntz").select(*calendar_columns("h"))
    got = {(r.full_timestamp.day, r.hour_24): r for r in df.collect()}
    peak = {h for (d, h), r in got.items() if d == 3 and r.is_peak_hour}
    night = {h for (d, h), r in got.items() if d == 3 and r.is_night}
    assert peak == {7, 9, 17, 19}
    assert night == {22, 23, 0, 5}
    sat = got[(4, 12)]
    assert (sat.day_of_week, sat.day_name, sat.is_weekend) == (6, "Sat", True)
    fri = got[(3, 6)]
    assert (fri.day_of_week, fri.day_name, fri.is_weekend, fri.quarter) == (5, "Fri", False, 3)


def test_text_to_bool_and_ranges(spark):
    df = spark.createDataFrame([("Y", "1"), ("N", "-999"), ("yes", "1000"), (" ", None), ("on", "12")],
                               "t string, n string")
    rows = df.select(text_to_bool(F.col("t")).alias("b"), range_checked_int(F.col("n")).alias("i")).collect()
    assert [r.b for r in rows] == [True, False, True, None, None]
    assert [r.i for r in rows] == [1, -999, None, None, 12]


def test_flag_dimension_is_all_32_combinations(spark):
    from tripmart.operators.core import build_dim_trip_flags
    from tripmart.schemas import FLAGS

    rows = build_dim_trip_flags(spark).collect()
    assert len(rows) == 32
    assert len({tuple(r[f] for f in FLAGS) for r in rows}) == 32
    assert len({r.trip_flags_id for r in rows}) == 32
    # The fact's key for a combination is the dimension's key for it.
    one = spark.createDataFrame([(True, False, True, False, False)], ", ".join(f"{f} boolean" for f in FLAGS))
    key = one.select(surrogate_key(*FLAGS).alias("k")).first().k
    assert key in {r.trip_flags_id for r in rows if (r.shared_request_flag, r.access_a_ride_flag) == (True, True)
                   and not (r.shared_match_flag or r.wav_request_flag or r.wav_match_flag)}


def test_layer_names_and_paths(spark):
    from tripmart.plans.warehouse import Warehouse, layer_name

    assert layer_name("staging", "PUBLIC") == "STAGING"
    assert layer_name(None, "PUBLIC") == "PUBLIC"
    wh = Warehouse(spark, "/shared/trips/")
    assert wh.path("stg_trips") == "/shared/trips/STAGING/stg_trips"
    assert wh.path("bi_daily_metrics") == "/shared/trips/MARTS/bi_daily_metrics"


def test_fixed_values_stated_on_their_own():
    """The SQL oracle shares these with the code, so they are pinned here."""
    import calendar
    import datetime as dt

    from tripmart.functions import KEY_NULL
    from tripmart.schemas import FLAGS
    from tripmart.sources.seeds import US_HOLIDAYS

    assert KEY_NULL == "_null_"
    assert FLAGS == ["shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag",
                     "wav_match_flag"]

    def nth(year, month, weekday, n):
        days = [d for d in calendar.Calendar().itermonthdates(year, month) if d.month == month and d.weekday() == weekday]
        return days[n]

    want = []
    for y in (2024, 2025, 2026):
        want += [(dt.date(y, 1, 1), "New Year"), (nth(y, 1, 0, 2), "Martin Luther King"), (nth(y, 2, 0, 2), "Washington"),
                 (nth(y, 5, 0, -1), "Memorial"), (dt.date(y, 6, 19), "Juneteenth"), (dt.date(y, 7, 4), "Independence"),
                 (nth(y, 9, 0, 0), "Labor"), (nth(y, 10, 0, 1), "Columbus"), (dt.date(y, 11, 11), "Veterans"),
                 (nth(y, 11, 3, 3), "Thanksgiving"), (dt.date(y, 12, 25), "Christmas")]
    assert [d for d, _ in US_HOLIDAYS] == [str(d) for d, _ in want]
    assert all(name.startswith(start) for (_, name), (_, start) in zip(US_HOLIDAYS, want, strict=True))


def test_monthly_totals_pass_the_bound_of_single_amounts(spark):
    from tripmart.plans.slices import DAILY_MONEY, monthly_overview

    totals = ", ".join(f"{m} double" for m in ["total_trip_miles", *DAILY_MONEY])
    days = [(dt.date(2024, 1, d), 10, 1.0, 50.0, *[x] * (1 + len(DAILY_MONEY)))
            for d, x in ((1, 2.5e10), (2, 0.25), (3, 3e15), (4, None))]
    daily = spark.createDataFrame(days, f"date_key date, total_trips long, total_trip_time_days double, "
                                        f"percent_shared_rides double, {totals}")
    row = monthly_overview(daily).first()
    assert row["days"] == 4
    assert {row[m] for m in ["total_trip_miles", *DAILY_MONEY]} == {3e15 + 2.5e10 + 0.25}
