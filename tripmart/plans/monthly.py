"""The monthly run: ingest new files, bring models up to date, run checks.

    python -m tripmart.plans.monthly --landing DIR --warehouse DIR \\
        --zones zone_lookup.csv [--holidays holidays.csv] [--years 2025-2026 --months 1-12 | --dates 2025-01,2025-02]

Equivalent of the reference's scheduled chain (find missing months, load
raw, build models, test). Downloading and scheduling are outside Spark and
not part of this package; point ``--landing`` at the folder the monthly
files arrive in.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import quality
from tripmart.plans.pipeline import run_models
from tripmart.plans.warehouse import Warehouse
from tripmart.sources import seeds
from tripmart.sources.ingest import after_mark, load_ids, read_loads, read_raw
from tripmart.sources.month_files import missing_month_files
from tripmart.streaming.file_stream import ingest_landing


def raw_paths(root: str) -> dict[str, str]:
    return {"raw": f"{root}/RAW/fhv_trips", "rejected": f"{root}/RAW/_rejected_files",
            "checkpoint": f"{root}/RAW/_checkpoints/landing"}


def run_checks(wh: Warehouse, raw: DataFrame, loads: DataFrame, as_of=None,
               present: list[str] | None = None) -> dict[str, list[dict]]:
    """Data tests: raw not-null, raw freshness, key uniqueness, fact relationships.

    Every test covers its whole table: a dimension row that went missing, or
    an old load with NULLs, is found by any later run. The not-null test and
    freshness come from the list of loads, which holds what each load
    observed of itself; of the raw table only loads without metrics are read
    (``present``: the loads that have a folder). The scans of the fact are
    narrow (ids and hour).
    """
    spark = wh.spark
    fact = wh.logical("fact_trips")
    out = {
        "not_null": quality.not_null_total(loads, raw, present),
        "freshness": quality.freshness_check(loads, as_of=as_of),
        "unique_fact_trip_id": quality.unique_check(fact, "trip_id"),
        "unique_dim_datetime_key": quality.unique_check(wh.logical("dim_datetime"), "datetime_key"),
        "unique_dim_location_key": quality.unique_check(wh.logical("dim_location"), "location_id"),
        "relationships": quality.relationship_check(fact, wh.logical("dim_datetime"),
                                                    wh.logical("dim_location"), wh.logical("dim_trip_flags")),
    }
    # Uniqueness results are summarised (duplicate keys and the rows they
    # cover) so the report stays one row whatever the data holds.
    for k in [k for k in out if k.startswith("unique")]:
        out[k] = out[k].agg(F.count(F.lit(1)).alias("duplicate_keys"),
                            F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    return {k: [r.asDict() for r in v.collect()] for k, v in out.items()} | {"_spark": spark.version}


def failures(report: dict) -> list[str]:
    """What a run must not pass over: failed checks, rejected files and
    missing months."""
    checks = report["checks"]
    out = [f"not_null {r['column_name']}" for r in checks["not_null"] if r["status"] == "fail"]
    out += [f"freshness {r['status']}" for r in checks["freshness"] if r["status"] == "error"]
    out += [k for k, rows in checks.items() if k.startswith("unique") and rows[0]["duplicate_keys"]]
    out += [f"relationship {r['relationship']}" for r in checks["relationships"] if r["orphan_rows"]]
    out += [f"rejected files in load {r['load_id']}" for r in report["loads"] if r["rejected_files"]]
    return out + [f"missing month {m}" for m in report.get("missing_months", [])]


def run_monthly(spark: SparkSession, landing: str, warehouse: str, zones_csv: str,
                holidays_csv: str | None = None, grain: str = "day", as_of=None,
                key_buckets: int = 1, months: list[tuple[int, int]] | None = None,
                full_refresh: list[str] | None = None, recluster: bool = False) -> dict:
    """One run; ``months`` are those the landing folder should have a good file of by now.

    ``full_refresh`` names models to build anew, with all that follows from
    them (see :func:`tripmart.plans.pipeline.run_models`). With ``recluster``
    the fact's touched periods (all of it, if it was built anew) are laid out
    by pickup time and zone (see :meth:`Warehouse.recluster`).
    """
    wh = Warehouse(spark, warehouse, grain=grain, key_buckets=key_buckets)
    paths = raw_paths(wh.root)
    loads = ingest_landing(spark, landing, paths["raw"], paths["rejected"], paths["checkpoint"],
                           grain=wh.grain)
    raw = read_raw(spark, paths["raw"])
    report: dict = {"loads": loads}
    if months is not None:
        missing = missing_month_files(spark, landing, paths["rejected"], months)
        report["missing_months"] = [r.month for r in missing.collect()]
    zones = seeds.read_zone_lookup_csv(spark, zones_csv)
    hol = seeds.read_holidays_csv(spark, holidays_csv) if holidays_csv else seeds.holidays(spark)
    stamps = read_loads(spark, paths["raw"])
    later = wh.exists("stg_trips") and "stg_trips" not in (full_refresh or [])
    mark = wh.high_water_mark() if later else None
    rep = run_models(wh, raw if mark is None else after_mark(raw, stamps, mark), zones, hol, full_refresh)
    if recluster:
        wh.recluster("fact_trips", periods=None if rep.first_run["fact_trips"] else rep.periods)
    report |= {"models": rep.__dict__, "checks": run_checks(wh, raw, stamps, as_of, load_ids(spark, paths["raw"]))}
    return report | {"failures": failures(report)}


def target_months(dates: str | None, years: str | None, months: str) -> list[tuple[int, int]] | None:
    """The months asked for: a list of dates, or a range; None if neither."""
    if dates:
        return quality.month_list(dates)
    return quality.month_range(years, months) if years else None


def main(argv=None, spark: SparkSession | None = None) -> int:
    """Exit status 1 if the run's report lists failures."""
    from tripmart.session import build_session

    ap = argparse.ArgumentParser(description="Monthly trip ingest and model run.")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--zones", required=True, help="zone lookup CSV")
    ap.add_argument("--holidays", help="holiday CSV (default: built-in calendar)")
    ap.add_argument("--grain", default="day", choices=["day", "month"], help="fixed at the first run")
    ap.add_argument("--key-buckets", type=int, default=1,
                    help="trip-key buckets per period (fixed at the first run)")
    ap.add_argument("--dates", help="months that must be present, e.g. 2025-01,2025-02 (bad ones are skipped)")
    ap.add_argument("--years", help="years that must be present, e.g. 2025-2026")
    ap.add_argument("--months", default="1-12", help="months of each of these years")
    ap.add_argument("--full-refresh", default="", help="models to build anew, e.g. fact_trips,bi_daily_metrics")
    ap.add_argument("--recluster", action="store_true", help="lay out the fact's touched periods by time and zone")
    args = ap.parse_args(argv)
    try:
        months = target_months(args.dates, args.years, args.months)
    except ValueError as e:
        ap.error(str(e))
    report = run_monthly(spark or build_session(), args.landing, args.warehouse, args.zones, args.holidays,
                         args.grain, key_buckets=args.key_buckets, months=months,
                         full_refresh=[m for m in args.full_refresh.split(",") if m], recluster=args.recluster)
    print(json.dumps(report, default=str, indent=2))
    return 1 if report["failures"] else 0


if __name__ == "__main__":
    raise SystemExit(main())
