"""Dashboard slices over the marts and the star schema.

Monthly overview (from the daily mart), peak-hour demand (fact by calendar
hour attributes) and driver economics (positive trips by month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.exact_sum import exact_sums
from tripmart.operators.joins import bounded_broadcast
from tripmart.operators.marts import _by_hour, _positive, mean

c = F.col
DAILY_MONEY = ["passenger_total_spend", "platform_gross_revenue", "driver_total_earnings",
               "fees_and_taxes", "platform_net_earnings"]


def monthly_overview(daily: DataFrame) -> DataFrame:
    """Roll the daily mart up to months.

    Counts and money re-add exactly; trip time goes back to whole seconds
    before re-adding; the shared share is re-weighted by trips (shared
    trips per day are recovered from the percentage and the trip count).
    """
    shared = F.round(c("percent_shared_rides") * c("total_trips") / 100).cast("bigint")
    seconds = F.round(c("total_trip_time_days") * 86400).cast("bigint")
    by = daily.select(F.year("date_key").alias("year"), F.month("date_key").alias("month"), "*")
    out = exact_sums(by, ["year", "month"], {m: c(m) for m in ["total_trip_miles", *DAILY_MONEY]}, {
        "days": F.count(F.lit(1)), "total_trips": F.sum("total_trips"), "seconds": F.sum(seconds), "shared": F.sum(shared)})
    return out.select("year", "month", "days", "total_trips", "total_trip_miles",
                      (c("seconds") / F.lit(86400.0)).alias("total_trip_time_days"), *DAILY_MONEY,
                      (c("shared") / c("total_trips") * 100).alias("percent_shared_rides"))


def peak_hour_demand(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    """Trips and averages by hour of day and the peak/night/weekend/holiday flags."""
    keys = ["hour_24", "is_peak_hour", "is_night", "is_weekend", "is_holiday"]
    j = _by_hour(fact, dim_datetime, keys)
    out = exact_sums(j, keys, {"miles": c("trip_miles"), "fare": c("base_passenger_fare")}, {
        "trip_count": F.count(F.lit(1)), "time": F.sum("trip_time"), "time_n": F.count("trip_time")})
    return out.select(*keys, "trip_count", mean("miles").alias("avg_trip_miles"), mean("time").alias("avg_trip_time"),
                      mean("fare").alias("avg_passenger_fare"))


def driver_economics(fact: DataFrame, dim_datetime: DataFrame, dim_trip_flags: DataFrame) -> DataFrame:
    """Driver pay and shared-ride share per month over positive trips."""
    j = _by_hour(_positive(fact), dim_datetime, ["year", "month"])
    j = j.join(bounded_broadcast(dim_trip_flags.select("trip_flags_id", "shared_match_flag"),
                                 basis=dim_trip_flags), "trip_flags_id")
    out = exact_sums(j, ["year", "month"], {
        "miles": c("trip_miles"), "pay": c("driver_pay"), "earned": c("driver_pay") + c("tips")}, {
        "trips": F.count(F.lit(1)), "time": F.sum("trip_time"), "time_n": F.count("trip_time"),
        "shared_rides": F.count_if(c("shared_match_flag"))})
    return out.select(
        "year", "month", "trips", mean("pay").alias("avg_driver_pay"), mean("earned").alias("avg_driver_total"),
        F.try_divide(mean("pay"), mean("miles")).alias("avg_pay_per_mile"),
        F.try_divide(mean("pay"), mean("time") / F.lit(3600.0)).alias("avg_pay_per_hour"),
        "shared_rides", (c("shared_rides") / c("trips") * 100).alias("percent_shared_rides"))
