"""Reconciliation of tables that incremental runs let drift apart.

Staging takes a key's newest rows, the fact discards a row whose key it has,
and a mart never recomputes a date it holds. Each rule is kept on purpose;
these reports say what they leave behind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.joins import bounded_broadcast


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """keys and rows of a key on both sides, where the numbers differ.

    The full outer join of both sides' counts, planned as one aggregation
    over both: each task first counts its own rows by key, so a key of any
    size is one row a task in the one shuffle there is. NULL is a key like
    any other; repeated rows count each.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    a, b = names
    both = left.select(*keys, one.alias(a), none.alias(b)).unionByName(right.select(*keys, none.alias(a), one.alias(b)))
    return both.groupBy(*keys).agg(F.sum(a).alias(a), F.sum(b).alias(b)).where(F.col(a) != F.col(b))


def stg_fact_drift(stg: DataFrame, fact: DataFrame) -> DataFrame:
    """trip_id, staged_rows, fact_rows of keys that staging and the fact hold differently often."""
    return reconcile(stg, fact, ["trip_id"], ("staged_rows", "fact_rows"))


def changed_rows(keyed: DataFrame, fact: DataFrame) -> DataFrame:
    """trip_id, staged_only, fact_only: keys whose rows differ in any column.

    ``keyed``: the fact rows that staging gives today. Rows are compared by a
    128-bit digest of all their columns, as multisets.
    """
    columns = fact.columns
    digest = [F.xxhash64(*columns).alias("_a"), F.xxhash64(F.lit(1), *columns).alias("_b")]
    found = reconcile(keyed.select("trip_id", *digest), fact.select("trip_id", *digest), ["trip_id", "_a", "_b"],
                      ("staged", "held"))
    return found.groupBy("trip_id").agg(
        F.sum(F.greatest(F.col("staged") - F.col("held"), F.lit(0))).alias("staged_only"),
        F.sum(F.greatest(F.col("held") - F.col("staged"), F.lit(0))).alias("fact_only"))


def frozen_date_gap(fact: DataFrame, dim_trip_flags: DataFrame, daily: DataFrame) -> DataFrame:
    """date_key, fact_trips, unknown_flag_trips, mart_trips, gap of dates with a gap.

    ``gap``: trips of the fact that the daily mart should count for a date
    and does not, because the date was frozen before they came (negative if
    the mart counts more than there are). Trips whose flags are unknown leave
    the mart by its join and are no gap. Dates on one side only are listed.
    """
    known = bounded_broadcast(dim_trip_flags.select("trip_flags_id", F.lit(True).alias("known")), basis=dim_trip_flags)
    trips = fact.select(F.to_date("pickup_datetime").alias("date_key"), "trip_flags_id").join(known, "trip_flags_id", "left")
    # One row a date on both sides: bounded by the calendar.
    held = trips.groupBy("date_key").agg(F.count(F.lit(1)).alias("fact_trips"),
                                         F.count_if(F.col("known").isNull()).alias("unknown_flag_trips"))
    told = daily.select(F.col("date_key").alias("mart_date"), F.col("total_trips").alias("mart_trips"))
    both = held.join(told, F.col("date_key").eqNullSafe(F.col("mart_date")), "full_outer")

    def number(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0).cast("long"))

    gap = number("fact_trips") - number("unknown_flag_trips") - number("mart_trips")
    return both.select(F.coalesce("date_key", "mart_date").alias("date_key"),
                       *[number(c).alias(c) for c in ("fact_trips", "unknown_flag_trips", "mart_trips")],
                       gap.alias("gap")).where(F.col("gap") != 0)


def totals(stg: DataFrame, fact: DataFrame, daily: DataFrame) -> dict[str, int]:
    """Rows of staging and the fact, and trips of the daily mart."""
    counts = [stg.agg(F.count(F.lit(1)).alias("staged")), fact.agg(F.count(F.lit(1)).alias("fact")),
              daily.agg(F.coalesce(F.sum("total_trips"), F.lit(0)).alias("mart"))]
    return reduce(lambda a, b: a | b, [c.first().asDict() for c in counts])
