"""End-to-end model run: staging -> star schema -> marts, first or later run.

First run (target missing): each model is built in full. Later runs:

* staging takes raw rows loaded after its high-water mark and upserts them
  by ``trip_id`` (the mark is strict; an empty target loads nothing);
* the fact adds staged rows whose ``trip_id`` it lacks;
* the hour calendar adds hours it lacks;
* each mart adds the dates it lacks -- a date once written is frozen;
* the flag and location dimensions are rebuilt in full.

Later runs read only the periods (days or months) staging touched. Those
periods are recorded in a small state table before staging is written and
cleared after the last mart, so a run that dies midway is finished by the
next one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import core, marts
from tripmart.operators.joins import anti_join_increment, anti_join_keys
from tripmart.operators.staging import FIRST_RUN, high_water_mark, stage_trips
from tripmart.plans.warehouse import Warehouse

DATE_MARTS = ["bi_daily_metrics", "bi_driver_metrics", "bi_flag_metrics"]


@dataclass
class RunReport:
    first_run: dict = field(default_factory=dict)
    periods: list = field(default_factory=list)
    mart_periods: list = field(default_factory=list)
    high_water_mark: int | None = None


def open_periods(wh: Warehouse, periods: list, marts_done) -> list:
    """Touched periods that still hold a date some mart lacks.

    Marts never recompute a date they hold, so a period whose every day is
    already in all marts contributes nothing: late trips for old dates then
    cost no fact rescan. Dates held by every mart are one small intersect
    (bounded by the calendar: one row per day).
    """
    common = None
    for m in marts_done:
        dates = m.select("date_key")
        common = dates if common is None else common.intersect(dates)
    closed = {r[0] for r in common.collect()}

    def days(p):
        if wh.grain == "day":
            return [p]
        first, nxt = p.replace(day=1), (p.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return [first + dt.timedelta(days=i) for i in range((nxt - first).days)]

    return [p for p in periods if any(d not in closed for d in days(p))]


#: What each model is built from.
PARENTS = {
    "stg_trips": [], "dim_location": [], "dim_trip_flags": [],
    "fact_trips": ["stg_trips"], "dim_datetime": ["stg_trips"],
    **{m: ["fact_trips", "dim_datetime", "dim_trip_flags"] for m in DATE_MARTS},
    "bi_geo_time_metrics": ["fact_trips", "dim_datetime", "dim_location"],
}


def with_descendants(names) -> set[str]:
    """The models and all that are built from them, directly or not."""
    unknown = set(names) - PARENTS.keys()
    if unknown:
        raise ValueError(f"no such models: {sorted(unknown)}")
    found = set(names)
    while more := {m for m, parents in PARENTS.items() if found & set(parents)} - found:
        found |= more
    return found


def run_models(wh: Warehouse, raw: DataFrame, zone_lookup: DataFrame,
               holidays: DataFrame, full_refresh: list[str] | None = None) -> RunReport:
    """Bring every model in ``wh`` up to date with ``raw``.

    The models in ``full_refresh`` and their descendants are built from
    scratch, each beside its old table, which stays readable until the new
    one is whole. To refresh staging, ``raw`` must hold all loads.
    """
    refresh = with_descendants(full_refresh or [])

    def has(name: str) -> bool:
        return name not in refresh and wh.exists(name)

    spark = wh.spark
    wh.recover()
    rep = RunReport()
    increment = None

    # Staging: high-water mark + keyed upsert.
    if not has("stg_trips"):
        rep.first_run["stg_trips"] = True
        wh.overwrite("stg_trips", stage_trips(raw, FIRST_RUN))
        wh.set_high_water_mark(high_water_mark(wh.read("stg_trips")))
        periods = None
    else:
        rep.first_run["stg_trips"] = False
        rep.high_water_mark = wh.high_water_mark()
        # Written once: periods, cells, mark and merge all read the copy.
        increment, new, cells, touched, new_mark = wh.store_increment(stage_trips(raw, after=rep.high_water_mark))
        pending = wh.pending_periods()
        periods = sorted(set(touched) | set(pending))
        wh.set_pending_periods(periods)
        rows = new.count()
        wh.upsert_cells("stg_trips", new, cells, touched, "trip_id", rows)
        if touched:
            # Written after the upsert commits, so the mark never runs ahead of staging.
            wh.set_high_water_mark(new_mark, previous=rep.high_water_mark)
    rep.periods = periods or []

    # Fact: add staged trips whose key is new. After a finished run only the
    # increment can hold such trips, and only its cells the keys to compare;
    # after a run that stopped midway, all of staging's touched periods can.
    # A missing target is built from all of staging, whatever ran before.
    stg = wh.read("stg_trips", periods)
    if has("fact_trips") and increment and not pending:
        rep.first_run["fact_trips"] = False
        fact_new = wh.with_period(core.build_fact(new.filter(F.col("pickup_period").isin(periods))))
        existing = wh.read("fact_trips", periods, cells)
        wh.append("fact_trips", anti_join_increment(fact_new, existing, ["pickup_period", "trip_id"], rows))
    elif has("fact_trips"):
        rep.first_run["fact_trips"] = False
        fact_new = wh.with_period(core.build_fact(stg))
        existing = wh.read("fact_trips", periods)
        wh.append("fact_trips", anti_join_keys(fact_new, existing, ["pickup_period", "trip_id"]))
    else:
        rep.first_run["fact_trips"] = True
        wh.overwrite("fact_trips", wh.with_period(core.build_fact(wh.read("stg_trips"))))

    # Dimensions.
    wh.overwrite("dim_location", core.build_dim_location(zone_lookup))
    flags = core.build_dim_trip_flags(spark)   # 32 rows by construction; reused below
    wh.overwrite("dim_trip_flags", flags)
    if has("dim_datetime"):
        # The calendar already spans every earlier staged pickup; widen it by
        # the touched periods only (staging's range only grows).
        rep.first_run["dim_datetime"] = False
        old = wh.read("dim_datetime").select(F.col("full_timestamp").alias("h"))
        new = stg.select(F.col("pickup_datetime").alias("h"))
        span = core.hour_range(old.unionByName(new), "h")
        dd_new = core.build_dim_datetime(stg, holidays, span=span)
        wh.append("dim_datetime", anti_join_keys(dd_new, wh.read("dim_datetime"), ["datetime_key"]))
    else:
        rep.first_run["dim_datetime"] = True
        wh.overwrite("dim_datetime", core.build_dim_datetime(wh.read("stg_trips"), holidays))

    # Marts: new dates only. The three date-grain marts come from one pass.
    dd = wh.read("dim_datetime")
    done = {name: wh.read(name) for name in [*DATE_MARTS, "bi_geo_time_metrics"] if has(name)}
    # New dates live in the touched periods; a missing mart needs the whole fact.
    mart_periods = None
    if periods is not None and len(done) == len(DATE_MARTS) + 1:
        mart_periods = open_periods(wh, periods, done.values())
    rep.mart_periods = mart_periods or []
    fact = wh.read("fact_trips", mart_periods)
    built = marts.build_date_marts(fact, dd, flags, done)
    built["bi_geo_time_metrics"] = marts.build_geo(fact, dd, wh.read("dim_location"),
                                                   done.get("bi_geo_time_metrics"))
    cache = built.pop("_cache")
    try:
        for name, df in built.items():
            rep.first_run[name] = name not in done
            (wh.append if name in done else wh.overwrite)(name, df)
    finally:
        cache.unpersist()

    if periods is not None:
        wh.set_pending_periods([])
        wh.drop_scratch(increment)
    return rep
