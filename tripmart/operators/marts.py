"""The four reporting marts.

Dimensions are joined by broadcast (each is bounded: 32 flag combinations,
one row per zone, one row per hour of the data's span), so the fact is never
shuffled for a join; the only shuffle is the aggregation by date, after a
map-side partial aggregate has collapsed every date -- hot dates included --
to one row per task.

``skip_dates`` (a DataFrame with ``date_key``) implements the incremental
rule: dates already present in the target mart are not recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import hour_floor
from tripmart.operators.exact_sum import exact_sums, limbs, totals
from tripmart.operators.joins import bounded_broadcast
from tripmart.schemas import BI_DAILY, BI_DRIVER, BI_FLAG, BI_GEO

c = F.col


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _by_hour(df: DataFrame, dim_datetime: DataFrame, columns: list[str],
             ts: str = "pickup_datetime") -> DataFrame:
    """Inner join rows to the hour calendar on the hour of ``ts``."""
    dd = bounded_broadcast(dim_datetime.select("full_timestamp", *columns), basis=dim_datetime)
    hourly = df.withColumn("_hour", hour_floor(ts)) if ts != "_hour" else df
    return hourly.join(dd, c("_hour") == c("full_timestamp")).drop("_hour", "full_timestamp")


def _skip(df: DataFrame, skip_dates: DataFrame | None, dim_datetime: DataFrame) -> DataFrame:
    """Drop dates already in the target mart.

    A mart's dates all come from joining the hour calendar, so there are at
    most as many as the calendar has rows -- the bound ``_by_hour`` has
    already established, so no extra count is needed to broadcast them.
    """
    if skip_dates is None:
        return df
    done = bounded_broadcast(skip_dates.select("date_key").distinct(), basis=dim_datetime)
    return df.join(done, "date_key", "left_anti")


def _flag_count(flag: str) -> Column:
    return F.sum(F.when(c(flag), 1).otherwise(0))


def _positive(fact: DataFrame) -> DataFrame:
    return fact.filter((c("trip_miles") > 0) & (c("trip_time") > 0))


def _money() -> dict[str, Column]:
    """The daily mart's sums; a NULL term makes a sum's value NULL."""
    fare, tips, tolls, apt = c("base_passenger_fare"), c("tips"), c("tolls"), c("airport_fee")
    cong, cbd, tax, bcf, pay = (c("congestion_surcharge"), c("cbd_congestion_fee"),
                                c("sales_tax"), c("bcf"), c("driver_pay"))
    return {
        "total_trip_miles": c("trip_miles"),
        "passenger_total_spend": fare + tips + tolls + apt + cong + cbd + tax + bcf,
        "platform_gross_revenue": fare + cong + cbd,
        "driver_total_earnings": pay + tips,
        "fees_and_taxes": tax + bcf + cong + cbd + apt,
        "platform_net_earnings": (fare + cong + cbd) - pay,
    }


def _driver_terms() -> dict[str, Column]:
    return {"miles": c("trip_miles"), "pay": c("driver_pay"), "tips": c("tips"), "earned": c("driver_pay") + c("tips")}


def mean(name: str) -> Column:
    """Average from an exact sum and its count."""
    return F.try_divide(c(name), c(f"{name}_n"))


def _driver_columns(seconds: Column) -> list[Column]:
    return [mean("miles").alias("avg_trip_miles"), seconds.alias("avg_trip_time_seconds"),
            mean("pay").alias("avg_driver_pay"), mean("tips").alias("avg_tips"),
            mean("earned").alias("avg_driver_total"), F.try_divide(mean("pay"), mean("miles")).alias("avg_pay_per_mile"),
            F.try_divide(mean("pay"), seconds / F.lit(3600.0)).alias("avg_pay_per_hour")]


def _daily_columns() -> list[Column]:
    return ["date_key", c("trips").alias("total_trips"), (c("time") / F.lit(86400.0)).alias("total_trip_time_days"),
            (c("shared") / c("trips") * 100).alias("percent_shared_rides"), *_money()]


def build_daily(fact: DataFrame, dim_datetime: DataFrame, dim_trip_flags: DataFrame,
                skip_dates: DataFrame | None = None) -> DataFrame:
    """Trips, distance, time and money totals and the shared-ride share per date.

    A NULL money term removes the row from the sums that use it (no
    coalesce); trips with an unknown flag combination drop out at the join.
    Sums are exact (see ``exact_sum``).
    """
    j = _skip(_by_hour(fact, dim_datetime, ["date_key"]), skip_dates, dim_datetime)
    flags = bounded_broadcast(dim_trip_flags.select("trip_flags_id", "shared_match_flag"), basis=dim_trip_flags)
    out = exact_sums(j.join(flags, "trip_flags_id"), ["date_key"], _money(), {
        "trips": F.count(F.lit(1)), "time": F.sum("trip_time"), "shared": _flag_count("shared_match_flag")})
    return _typed(out.select(*_daily_columns()), BI_DAILY)


def build_driver(fact: DataFrame, dim_datetime: DataFrame, dim_trip_flags: DataFrame,
                 skip_dates: DataFrame | None = None) -> DataFrame:
    """Per-date driver averages over trips with positive distance and time.

    Pay per mile and per hour are ratios of averages. The flag dimension
    only filters (its key is unique), so it is a semi-join.
    """
    j = _skip(_by_hour(_positive(fact), dim_datetime, ["date_key"]), skip_dates, dim_datetime)
    j = j.join(bounded_broadcast(dim_trip_flags.select("trip_flags_id"), basis=dim_trip_flags),
               "trip_flags_id", "left_semi")
    out = exact_sums(j, ["date_key"], _driver_terms(), {"time": F.sum("trip_time"), "time_n": F.count("trip_time")})
    return _typed(out.select("date_key", *_driver_columns(mean("time"))), BI_DRIVER)


def build_flag(fact: DataFrame, dim_datetime: DataFrame, dim_trip_flags: DataFrame,
               skip_dates: DataFrame | None = None) -> DataFrame:
    """Per-date trip count and counts of each TRUE flag (positive trips only)."""
    j = _skip(_by_hour(_positive(fact), dim_datetime, ["date_key"]), skip_dates, dim_datetime)
    j = j.join(bounded_broadcast(dim_trip_flags), "trip_flags_id")
    out = j.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _flag_count("shared_request_flag").alias("total_shared_rides_requested"),
        _flag_count("shared_match_flag").alias("total_shared_rides_matched"),
        _flag_count("wav_request_flag").alias("total_wav_requested"),
        _flag_count("wav_match_flag").alias("total_wav_matched"),
        _flag_count("access_a_ride_flag").alias("total_access_a_ride_requested"),
    )
    return _typed(out, BI_FLAG)


def build_date_marts(fact: DataFrame, dim_datetime: DataFrame, dim_trip_flags: DataFrame,
                     skip_dates: dict[str, DataFrame | None] | None = None) -> dict[str, DataFrame]:
    """Daily, driver and flag marts from one scan, one join and one aggregation.

    The three marts share the fact-to-calendar and fact-to-flags joins and
    the date grain; they differ only in which trips count (driver and flag
    take positive trips). Conditional aggregates compute all of them in one
    pass; the per-date result -- one row per date -- is cached and split.
    Each mart then drops the dates it already holds (``skip_dates`` by mart
    name). Values equal :func:`build_daily`, :func:`build_driver` and
    :func:`build_flag`. The cached aggregate is returned under ``"_cache"``
    for the caller to unpersist after writing.
    """
    skip_dates = skip_dates or {}
    j = _by_hour(fact, dim_datetime, ["date_key"])
    j = j.join(bounded_broadcast(dim_trip_flags), "trip_flags_id")
    pos = (c("trip_miles") > 0) & (c("trip_time") > 0)

    def p(x: Column) -> Column:          # value for positive trips, else NULL
        return F.when(pos, x)

    flags = ["shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag", "access_a_ride_flag"]
    agg = exact_sums(j, ["date_key"], _money() | {n: p(x) for n, x in _driver_terms().items()}, {
        "trips": F.count(F.lit(1)), "time": F.sum("trip_time"), "shared": _flag_count("shared_match_flag"),
        "n_pos": F.count_if(pos), "p_time": F.sum(p(c("trip_time"))), "p_time_n": F.count(p(c("trip_time"))),
        **{f"p_{f}": F.count_if(pos & c(f)) for f in flags}}).persist()
    out = {
        "bi_daily_metrics": _typed(agg.select(*_daily_columns()), BI_DAILY),
        "bi_driver_metrics": _typed(agg.filter(c("n_pos") > 0).select("date_key", *_driver_columns(mean("p_time"))),
                                    BI_DRIVER),
        "bi_flag_metrics": _typed(agg.filter(c("n_pos") > 0).select(
            "date_key", c("n_pos").alias("total_trips"),
            c("p_shared_request_flag").alias("total_shared_rides_requested"),
            c("p_shared_match_flag").alias("total_shared_rides_matched"),
            c("p_wav_request_flag").alias("total_wav_requested"),
            c("p_wav_match_flag").alias("total_wav_matched"),
            c("p_access_a_ride_flag").alias("total_access_a_ride_requested")), BI_FLAG),
    }
    return {**{name: _skip(df, skip_dates.get(name), dim_datetime) for name, df in out.items()},
            "_cache": agg}


GEO_KEYS = ["date_key", "year", "month", "day_of_week", "hour_24",
            "pu_borough", "pu_zone", "do_borough", "do_zone"]


def build_geo(fact: DataFrame, dim_datetime: DataFrame, dim_location: DataFrame,
              skip_dates: DataFrame | None = None) -> DataFrame:
    """Trips and averages per date, hour, pickup zone and dropoff zone names.

    Two stages: aggregate the fact by (hour, pickup id, dropoff id) on narrow
    keys first, then join names to those partial sums and re-aggregate by
    names (ids that share borough and zone merge). The joins and the wide
    9-column grouping then touch partials instead of fact rows. Averages are
    rebuilt from sums and non-NULL counts, so they equal one-pass AVGs.
    """
    part = limbs(fact.withColumn("_hour", hour_floor("pickup_datetime")), ["_hour", "pulocation_id", "dolocation_id"],
                 {"miles": c("trip_miles"), "fare": c("base_passenger_fare")},
                 {"trip_count": F.count(F.lit(1)), "time": F.sum("trip_time"), "time_n": F.count("trip_time")})
    j = _skip(_by_hour(part, dim_datetime, ["date_key", "year", "month", "day_of_week", "hour_24"],
                       ts="_hour"), skip_dates, dim_datetime)
    loc = dim_location.select("location_id", "borough", "zone")
    pu = bounded_broadcast(loc.toDF("_pu_id", "pu_borough", "pu_zone"), basis=dim_location)
    do = bounded_broadcast(loc.toDF("_do_id", "do_borough", "do_zone"), basis=dim_location)
    j = (j.join(pu, c("pulocation_id") == c("_pu_id"))
          .join(do, c("dolocation_id") == c("_do_id")))
    out = totals(j.drop("pulocation_id", "dolocation_id", "_pu_id", "_do_id"), GEO_KEYS).select(
        *GEO_KEYS, "trip_count", mean("miles").alias("avg_trip_miles"), mean("time").alias("avg_trip_time"),
        mean("fare").alias("avg_passenger_fare"))
    return _typed(out, BI_GEO)
