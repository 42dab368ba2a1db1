"""Load metrics, missing files, drift reports, databases and full refresh."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_plans import plan
from tripmart.operators import marts, quality, reconcile
from tripmart.operators.staging import newest_load, stage_trips
from tripmart.plans import catalog
from tripmart.plans.models import FullBuild
from tripmart.plans.pipeline import PARENTS, run_models, with_descendants
from tripmart.plans.warehouse import TABLES, Warehouse
from tripmart.sources import fixtures, ingest, seeds
from tripmart.sources.landing import write_landing
from tripmart.sources.month_files import missing_month_files, month_of
from tripmart.streaming.file_stream import ingest_landing


@pytest.fixture(scope="module")
def landed(spark):
    """Both loads ingested; June files with a missing flag are refused."""
    from tripmart.session import scratch_dir

    root = scratch_dir(spark, "tests")
    at = {"landing": f"{root}/landing", "raw": f"{root}/raw", "rejected": f"{root}/rejected"}
    for load in (1, 2):
        write_landing(fixtures.raw_trips_load(spark, SF_SMALL, load), f"{at['landing']}/load_{load}", (6,))
        ingest_landing(spark, at["landing"], at["raw"], at["rejected"], f"{root}/checkpoint", grain="month")
    return at


def test_metrics_equal_a_scan_of_the_raw_table(spark, landed):
    raw, loads = ingest.read_raw(spark, landed["raw"]), ingest.read_loads(spark, landed["raw"])
    assert loads.count() == 2 and loads.agg(F.sum("row_count")).first()[0] == raw.count()
    both = [sorted(tuple(r) for r in df.select("column_name", "null_rows", "status").collect())
            for df in (quality.not_null_total(loads, raw), quality.not_null_check(raw))]
    assert both[0] == both[1]


def test_metrics_count_nulls_by_load(spark, workdir):
    raw = fixtures.raw_trips_load(spark, SF_SMALL, 1).limit(300).withColumn(
        "PULocationID", F.when(F.col("PULocationID") > 5, F.col("PULocationID")))
    write_landing(raw, f"{workdir}/landing")
    ingest_landing(spark, f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/rejected", f"{workdir}/checkpoint")
    loads = ingest.read_loads(spark, f"{workdir}/raw")
    table = ingest.read_raw(spark, f"{workdir}/raw")
    rows = {r["column_name"]: (r["null_rows"], r["status"]) for r in quality.not_null_by_load(loads).collect()}
    nulls = table.where("PULocationID IS NULL").count()
    assert nulls > 0 and rows["PULocationID"] == (nulls, "fail") and rows["DOLocationID"] == (0, "pass")


def test_no_raw_data_is_scanned_for_not_null(spark, landed):
    loads = ingest.read_loads(spark, landed["raw"])
    p = plan(quality.not_null_total(loads, ingest.read_raw(spark, landed["raw"])))
    assert "null_pickup_datetime" in p and f"{landed['raw']}_loads" in p
    assert f"{landed['raw']}]" not in p and "hvfhs_license_num" not in p


def test_loads_without_metrics_are_scanned_alone(spark, landed):
    loads, raw = ingest.read_loads(spark, landed["raw"]), ingest.read_raw(spark, landed["raw"])
    first = loads.orderBy("ingestion_ts").first()["load_id"]
    old = loads.select("load_id", "ingestion_ts", *[
        F.when(F.col("load_id") != first, F.col(m)).alias(m) for m in ingest.METRICS])
    assert {r["status"] for r in quality.not_null_by_load(old).collect()} == {"unknown", "pass"}
    mixed = quality.not_null_total(old, raw)
    assert {r["column_name"]: r["null_rows"] for r in mixed.collect()} == dict.fromkeys(quality.RAW_NOT_NULL, 0)
    assert re.search(r"PartitionFilters: \[[^\]]*load_id", plan(mixed))


def test_a_load_of_refused_files_only_has_metrics(spark, workdir):
    raw = fixtures.raw_trips_load(spark, SF_SMALL, 1).where(F.month("pickup_datetime") == 6)
    write_landing(raw.withColumn("access_a_ride_flag", F.lit(None).cast("boolean")), f"{workdir}/landing", (6,))
    reports = ingest_landing(spark, f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/rejected", f"{workdir}/checkpoint")
    assert reports[0]["rejected_files"] > 0
    assert ingest.read_loads(spark, f"{workdir}/raw").first()["row_count"] == 0


def test_missing_month_files(spark, landed, workdir):
    months = quality.month_range("2023-2024")
    rows = {r["month"]: (r["files"], r["rejected"]) for r in
            missing_month_files(spark, landed["landing"], landed["rejected"], months).collect()}
    assert rows.keys() >= {f"2023-{m:02d}" for m in range(1, 13)} and rows["2023-05"] == (0, 0)
    refused = {m: n for m, n in rows.items() if n[0]}
    assert refused.keys() <= {"2024-06"} and all(f == r > 0 for f, r in refused.values())
    assert missing_month_files(spark, landed["landing"], landed["rejected"], []).count() == 0
    # Without a quarantine every listed month is there.
    all_there = missing_month_files(spark, landed["landing"], f"{workdir}/none", [(2024, 6), (2024, 7), (1999, 1)])
    assert [r["month"] for r in all_there.collect()] == ["1999-01"]


def test_month_of_a_file(spark):
    names = {"/a/fhvhv_tripdata_2024-01.parquet": "2024-01", "/2020-05/x_2024-13.parquet": None,
             "/a/load_1/_month=2025-12": "2025-12", "/a/12024-01": None, "/a/2024-012": None, "/a/none.parquet": None}
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert {r["p"]: r["m"] for r in df.select("p", month_of(F.col("p")).alias("m")).collect()} == names


# --- drift ------------------------------------------------------------------

def test_reconcile_is_a_full_outer_join_of_counts(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("d",), ("d",)], "trip_id string")
    right = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), (None,), (None,)], "trip_id string")
    rows = {r["trip_id"]: (r["staged_rows"], r["fact_rows"]) for r in reconcile.stg_fact_drift(left, right).collect()}
    assert rows == {"a": (2, 1), "c": (0, 1), None: (1, 2)}
    assert reconcile.stg_fact_drift(left, left).count() == 0
    assert reconcile.stg_fact_drift(left.limit(0), right.limit(0)).count() == 0
    p = plan(reconcile.stg_fact_drift(left, right))
    assert "Join" not in p and "partial_sum" in p


def test_changed_rows_compare_whole_rows(spark):
    schema = "trip_id string, x double, y string"
    now = spark.createDataFrame([("a", 1.0, "p"), ("a", 1.0, "p"), ("b", 2.0, None), ("c", 3.0, "q")], schema)
    held = spark.createDataFrame([("a", 1.0, "p"), ("b", 2.0, "new"), ("c", 3.0, "q")], schema)
    rows = {r["trip_id"]: (r["staged_only"], r["fact_only"]) for r in reconcile.changed_rows(now, held).collect()}
    assert rows == {"a": (1, 0), "b": (1, 1)}


def test_frozen_dates(spark):
    d = dt.datetime
    fact = spark.createDataFrame([(d(2025, 1, 1, 3), "k"), (d(2025, 1, 1, 4), "k"), (d(2025, 1, 1, 5), "no"),
                                  (d(2025, 1, 2), "k"), (d(2025, 1, 4), "k")], "pickup_datetime timestamp_ntz, trip_flags_id string")
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (dt.date(2025, 1, 2), 1), (dt.date(2025, 1, 3), 7)],
                                  "date_key date, total_trips long")
    flags = spark.createDataFrame([("k",)], "trip_flags_id string")
    rows = sorted(tuple(r) for r in reconcile.frozen_date_gap(fact, flags, daily).collect())
    assert rows == [(dt.date(2025, 1, 1), 3, 1, 1, 1), (dt.date(2025, 1, 3), 0, 0, 7, -7), (dt.date(2025, 1, 4), 1, 0, 0, 1)]


# --- full refresh and databases -----------------------------------------------

def inputs(spark):
    return fixtures.zone_lookup(spark, SF_SMALL), seeds.holidays(spark)


def test_models_and_what_follows():
    assert PARENTS.keys() == TABLES.keys()
    assert with_descendants(["dim_location"]) == {"dim_location", "bi_geo_time_metrics"}
    assert with_descendants(["stg_trips"]) == set(TABLES) - {"dim_location", "dim_trip_flags"}
    assert with_descendants([]) == set()
    with pytest.raises(ValueError):
        with_descendants(["fact"])


def test_full_refresh_and_a_stop_before_the_switch(spark, workdir, monkeypatch):
    wh = Warehouse(spark, workdir, grain="month")
    raw = fixtures.raw_trips(spark, SF_SMALL)
    run_models(wh, fixtures.raw_trips_load(spark, SF_SMALL, 1), *inputs(spark))
    run_models(wh, raw, *inputs(spark))
    frozen = wh.logical("bi_daily_metrics").agg(F.sum("total_trips")).first()[0]
    rows, place = wh.logical("fact_trips").count(), wh.path("fact_trips")

    def stop(self, name, folder):
        raise KeyboardInterrupt(name)

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_switch", stop)
        with pytest.raises(KeyboardInterrupt):
            run_models(wh, raw, *inputs(spark), full_refresh=["fact_trips"])
    again = Warehouse(spark, workdir, grain="month")
    assert again.path("fact_trips") == place and again.logical("fact_trips").count() == rows

    rep = run_models(again, raw, *inputs(spark), full_refresh=["fact_trips"])
    assert rep.first_run == {"stg_trips": False, "dim_datetime": False, "fact_trips": True, "bi_daily_metrics": True,
                             "bi_driver_metrics": True, "bi_flag_metrics": True, "bi_geo_time_metrics": True}
    last = Warehouse(spark, workdir, grain="month")
    assert last.path("fact_trips") != place
    stg = last.logical("stg_trips")
    assert last.logical("fact_trips").count() == stg.count()
    assert reconcile.stg_fact_drift(stg, last.logical("fact_trips")).count() == 0
    assert last.logical("bi_daily_metrics").agg(F.sum("total_trips")).first()[0] > frozen
    assert reconcile.frozen_date_gap(last.logical("fact_trips"), last.logical("dim_trip_flags"),
                                     last.logical("bi_daily_metrics")).count() == 0
    # A later run goes on from the switched tables.
    assert run_models(last, raw, *inputs(spark)).first_run["fact_trips"] is False


def test_databases(spark, workdir):
    wh = Warehouse(spark, workdir, grain="month")
    run_models(wh, fixtures.raw_trips_load(spark, SF_SMALL, 1), *inputs(spark))
    assert set(catalog.register_databases(wh)) == {catalog.qualified(t) for t in TABLES}
    assert catalog.is_built(spark, "fact_trips")
    n = spark.sql("SELECT COUNT(*) AS n FROM MARTS.FACT_TRIPS").first()["n"]
    assert n == wh.logical("fact_trips").count() > 0
    periods = spark.sql("SHOW PARTITIONS marts.fact_trips").count()
    assert periods == wh.read("fact_trips").select("pickup_period", "key_bucket").distinct().count()
    # After a refresh the table has moved; registering again follows it.
    wh.overwrite("fact_trips", wh.logical("fact_trips").limit(5))
    catalog.register_table(wh, "fact_trips")
    assert spark.sql("SELECT COUNT(*) AS n FROM marts.fact_trips").first()["n"] == 5


# --- the mark as a subquery ------------------------------------------------------

def test_the_mark_is_a_subquery_of_the_scan(spark, landed):
    raw = ingest.read_raw(spark, landed["raw"])
    first = raw.where(F.col("ingestion_ts") == raw.agg(F.min("ingestion_ts")).scalar())
    mark = newest_load(stage_trips(first))
    later = stage_trips(raw, after=mark)
    p = plan(later)
    assert "Subquery" in p and "ingestion_ts" in p.split("DataFilters", 1)[-1]
    micros = mark.select(F.unix_micros(F.col("max(ingestion_ts)"))).first()[0]
    assert later.count() == stage_trips(raw, after=micros).count() > 0
    # An empty target has no mark and loads nothing.
    assert stage_trips(raw, after=newest_load(stage_trips(raw.limit(0)))).count() == 0


def test_methods_too_long_to_compile_are_split(spark, capsys):
    """The date marts' fused sums are beyond what HotSpot compiles, so Spark must not fuse them."""
    m = FullBuild(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it runs, before it has run
    try:
        rows = marts.build_date_marts(m.fact, m.dim_datetime, m.dim_trip_flags)["_cache"].unpersist()
        rows.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert limit <= 8000 < max(sizes)
