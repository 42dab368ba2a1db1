"""Hand-written edge rows (FIXTURES.md section 4) through staging, marts,
incremental runs and file ingest."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.operators import core, marts
from tripmart.operators.staging import stage_trips
from tripmart.plans.pipeline import run_models
from tripmart.plans.warehouse import Warehouse
from tripmart.schemas import DIM_LOCATION, FLAGS, RAW
from tripmart.sources import seeds
from tripmart.sources.ingest import after_mark, read_loads, read_raw
from tripmart.streaming.file_stream import ingest_landing

UTC = dt.timezone.utc
LOAD1 = dt.datetime(2026, 2, 1, tzinfo=UTC)
LOAD2 = dt.datetime(2026, 3, 1, tzinfo=UTC)


def trip(pickup, minutes=20, **kw):
    row = dict(
        hvfhs_license_num="HV0003",
        request_datetime=pickup - dt.timedelta(minutes=5), on_scene_datetime=None,
        pickup_datetime=pickup, dropoff_datetime=pickup + dt.timedelta(minutes=minutes),
        PULocationID=1, DOLocationID=2, trip_miles=3.0, trip_time=minutes * 60,
        base_passenger_fare=20.0, tolls=0.0, bcf=0.5, sales_tax=1.0, congestion_surcharge=2.75,
        airport_fee=0.0, tips=2.0, driver_pay=15.0, cbd_congestion_fee=1.5,
        **{f: False for f in FLAGS}, ingestion_ts=LOAD1)
    row.update(kw)
    return row


def raw_df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in RAW.fields) for r in rows], RAW)


def zones(spark):
    rows = [(1, "Queens", "Astoria", "Boro Zone"), (2, "Queens", "Corona", "Boro Zone"),
            (3, "Queens", "Corona", "Boro Zone"), (4, "Manhattan", "Midtown", "Yellow Zone")]
    return spark.createDataFrame(rows, DIM_LOCATION)


D1 = dt.datetime(2025, 3, 3, 10, 15)
D2 = dt.datetime(2025, 3, 4, 8, 0)


def build(spark, rows):
    stg = stage_trips(raw_df(spark, rows))
    fact = core.build_fact(stg)
    dd = core.build_dim_datetime(stg, seeds.holidays(spark))
    flags = core.build_dim_trip_flags(spark)
    loc = core.build_dim_location(zones(spark))
    return stg, fact, dd, flags, loc


def test_staging_rules(spark):
    rows = [trip(D1), trip(D1, hvfhs_license_num="HV0005"), trip(D1, pickup_datetime=None),
            trip(D1, dropoff_datetime=None), trip(D2, tips=1.0), trip(D2, tips=9.0)]
    stg = stage_trips(raw_df(spark, rows)).collect()
    assert len(stg) == 3                      # licence and NULL times dropped
    same = [r for r in stg if r.pickup_datetime == D2]
    assert len(same) == 2 and same[0].trip_id == same[1].trip_id   # collide, both kept


def test_null_flag_unknown_zone_zero_trips_null_fee(spark):
    rows = [
        trip(D1),                                    # plain
        trip(D1, access_a_ride_flag=None),           # NULL flag
        trip(D1, DOLocationID=99),                   # unknown zone
        trip(D1, trip_miles=0.0),                    # zero distance
        trip(D1, cbd_congestion_fee=None),           # missing fee
    ]
    stg, fact, dd, flags, loc = build(spark, rows)
    assert fact.count() == 5
    daily = marts.build_daily(fact, dd, flags).first()
    assert daily.total_trips == 4                  # NULL-flag trip drops out
    # fee NULL: that row adds nothing to gross revenue; the others add fare + 2.75 + 1.5
    assert daily.platform_gross_revenue == pytest.approx(3 * 24.25)
    assert daily.driver_total_earnings == pytest.approx(4 * 17.0)
    driver = marts.build_driver(fact, dd, flags).first()
    assert driver.avg_trip_miles == 3.0            # zero-mile trip excluded
    flag = marts.build_flag(fact, dd, flags).first()
    assert flag.total_trips == 3                    # zero-mile and NULL-flag trips excluded
    geo = marts.build_geo(fact, dd, loc).collect()
    assert sum(r.trip_count for r in geo) == 4      # unknown zone only drops here; NULL flag stays


def test_zones_sharing_names_merge_in_geo(spark):
    rows = [trip(D1, DOLocationID=2), trip(D1 + dt.timedelta(minutes=1), DOLocationID=3)]
    _, fact, dd, _, loc = build(spark, rows)
    geo = marts.build_geo(fact, dd, loc).collect()
    assert len(geo) == 1 and geo[0].trip_count == 2 and geo[0].do_zone == "Corona"


def test_holiday_on_weekend(spark):
    rows = [trip(dt.datetime(2026, 7, 4, 13, 0))]
    _, _, dd, _, _ = build(spark, rows)
    r = dd.first()
    assert (r.is_weekend, r.is_holiday, r.holiday_name) == (True, True, "Independence Day")
    assert dd.count() == 1


def test_incremental_runs(spark, workdir):
    wh = Warehouse(spark, workdir, grain="day")
    hol = seeds.holidays(spark)
    first = [trip(D1), trip(D2)]
    run_models(wh, raw_df(spark, first), zones(spark), hol)
    before = {r.date_key: r.total_trips for r in wh.logical("bi_daily_metrics").collect()}
    assert before == {D1.date(): 1, D2.date(): 1}

    late_same_key = trip(D1, tips=7.0, ingestion_ts=LOAD2)           # same trip_id as a fact row
    late_new = trip(D1 + dt.timedelta(minutes=3), ingestion_ts=LOAD2)  # new trip on a frozen date
    new_date = trip(dt.datetime(2025, 3, 9, 7, 0), ingestion_ts=LOAD2)
    rows = first + [late_same_key, late_new, new_date]
    rep = run_models(wh, raw_df(spark, rows), zones(spark), hol)
    assert rep.high_water_mark is not None
    # D1 is touched by late trips but already in every mart: only the new date is re-read.
    assert rep.periods == [D1.date(), dt.date(2025, 3, 9)]
    assert wh.high_water_mark() == int(LOAD2.timestamp() * 1_000_000)
    assert rep.mart_periods == [dt.date(2025, 3, 9)]

    stg = wh.logical("stg_trips").collect()
    assert len(stg) == 4                                      # upsert replaced the D1 trip
    assert {r.tips for r in stg if r.pickup_datetime == D1} == {7.0}
    fact = wh.logical("fact_trips").collect()
    assert len(fact) == 4                                     # same key not re-added
    assert {r.tips for r in fact if r.pickup_datetime == D1} == {2.0}
    daily = {r.date_key: r.total_trips for r in wh.logical("bi_daily_metrics").collect()}
    assert daily[D1.date()] == 1                              # frozen despite the late trip
    assert daily[dt.date(2025, 3, 9)] == 1
    assert wh.pending_periods() == []

    # Rerun with nothing new: every table unchanged.
    counts = {t: wh.logical(t).count() for t in ["stg_trips", "fact_trips", "dim_datetime",
                                                 "bi_daily_metrics", "bi_geo_time_metrics"]}
    run_models(wh, raw_df(spark, rows), zones(spark), hol)
    assert counts == {t: wh.logical(t).count() for t in counts}


def test_empty_staging_target_loads_nothing(spark, workdir):
    wh = Warehouse(spark, workdir)
    empty = raw_df(spark, [trip(D1, hvfhs_license_num="HV0005")])
    run_models(wh, empty, zones(spark), seeds.holidays(spark))
    assert wh.exists("stg_trips") and wh.logical("stg_trips").count() == 0
    rep = run_models(wh, raw_df(spark, [trip(D2, ingestion_ts=LOAD2)]), zones(spark), seeds.holidays(spark))
    assert rep.high_water_mark is None
    assert wh.logical("stg_trips").count() == 0


def _landing(spark, rows, path, drop_fee=False, flag_text=None):
    df = raw_df(spark, rows).drop("ingestion_ts")
    for f in FLAGS:
        text = F.when(F.col(f), "Y").when(~F.col(f), "N")
        if flag_text is not None:
            text = F.lit(flag_text)
        df = df.withColumn(f, text)
    df = df.withColumn("PULocationID", F.col("PULocationID").cast("bigint")).withColumn(
        "DOLocationID", F.col("DOLocationID").cast("bigint"))
    if drop_fee:
        df = df.drop("cbd_congestion_fee")
    df.coalesce(1).write.mode("overwrite").parquet(path)


def test_file_ingest_rejects_whole_files_and_loads_once(spark, workdir):
    land, raw_path, rej, ck = (f"{workdir}/landing", f"{workdir}/RAW/fhv_trips",
                               f"{workdir}/RAW/_rejected", f"{workdir}/_ck")
    _landing(spark, [trip(D1), trip(D2)], f"{land}/2025-03", drop_fee=True)
    _landing(spark, [trip(D1 + dt.timedelta(hours=1))], f"{land}/2025-04", flag_text=" ")
    rep = ingest_landing(spark, land, raw_path, rej, ck)
    assert sum(r["rejected_files"] for r in rep) == 1
    raw = read_raw(spark, raw_path).collect()
    assert len(raw) == 2                                   # the blank-flag file is skipped whole
    assert all(r.cbd_congestion_fee is None for r in raw)  # absent column reads as NULL
    assert all(r.shared_request_flag is False for r in raw)
    assert len({r.ingestion_ts for r in raw}) == 1         # one stamp per load
    # The list of loads prunes the raw table to those after a mark.
    loads = read_loads(spark, raw_path)
    assert [r.ingestion_ts for r in loads.collect()] == [raw[0].ingestion_ts]
    later = after_mark(read_raw(spark, raw_path), loads, 0)
    assert later.count() == 2 and after_mark(read_raw(spark, raw_path), loads, 1 << 60).count() == 0
    import re
    assert re.search(r"PartitionFilters: \[[^\n]*load_id", later._jdf.queryExecution().executedPlan().toString())
    # Re-scanning the folder loads nothing twice.
    rep2 = ingest_landing(spark, land, raw_path, rej, ck)
    assert rep2 == [] and read_raw(spark, raw_path).count() == 2
    rejected = spark.read.parquet(rej).collect()
    assert len(rejected) == 1 and rejected[0]["_file"].endswith("2025-04") and rejected[0]["reason"] == "value"


def test_unreadable_files_are_skipped_whole_and_never_offered_again(spark, workdir):
    """A truncated file and one with a DOUBLE trip_time next to a good one."""
    import glob
    import os
    import shutil

    land, raw_path, rej, ck = (f"{workdir}/landing", f"{workdir}/RAW/fhv_trips",
                               f"{workdir}/RAW/_rejected", f"{workdir}/_ck")
    _landing(spark, [trip(D1), trip(D2)], f"{workdir}/good")
    raw_df(spark, [trip(D1)]).drop("ingestion_ts").withColumn("trip_time", F.lit(1.5)).coalesce(1).write.parquet(
        f"{workdir}/wrong")
    os.makedirs(land)
    good, wrong = (glob.glob(f"{workdir}/{n}/part-*.parquet")[0] for n in ("good", "wrong"))
    shutil.copy(good, f"{land}/2025-03.parquet")
    shutil.copy(wrong, f"{land}/2025-04.parquet")
    with open(good, "rb") as f, open(f"{land}/2025-05.parquet", "wb") as out:
        out.write(f.read()[:-100])
    rep = ingest_landing(spark, land, raw_path, rej, ck)
    assert [r["rejected_files"] for r in rep] == [2]
    assert read_raw(spark, raw_path).count() == 2
    rows = spark.read.parquet(rej).collect()
    assert sorted((r["_file"][-15:], r["reason"]) for r in rows) == [("2025-04.parquet", "unreadable"),
                                                                     ("2025-05.parquet", "unreadable")]
    assert ingest_landing(spark, land, raw_path, rej, ck) == []


def test_rejection_does_not_depend_on_the_number_of_parts(spark, workdir):
    from tests.conftest import SF_SMALL
    from tripmart.sources import fixtures
    from tripmart.sources.landing import write_landing

    raw = fixtures.raw_trips_load(spark, SF_SMALL, 1)
    write_landing(raw, f"{workdir}/a/landing", (6,))
    spark.read.option("basePath", f"{workdir}/a/landing").parquet(f"{workdir}/a/landing").repartition(3).write.partitionBy(
        "_month").parquet(f"{workdir}/b/landing")
    counts = []
    for d in ("a", "b"):
        ingest_landing(spark, f"{workdir}/{d}/landing", f"{workdir}/{d}/raw", f"{workdir}/{d}/rej", f"{workdir}/{d}/ck")
        counts.append((read_raw(spark, f"{workdir}/{d}/raw").count(), spark.read.parquet(f"{workdir}/{d}/rej").count()))
    assert counts[0] == counts[1] and counts[0][1] > 0


def test_upsert_over_many_days_and_a_reopened_warehouse(spark, workdir):
    """1000 days in 16 buckets; the stored grain holds when another is asked."""
    wh = Warehouse(spark, workdir, grain="day", key_buckets=16)
    days = [D1 + dt.timedelta(days=i) for i in range(1000)]
    first = stage_trips(raw_df(spark, [trip(d) for d in days]))
    wh.overwrite("stg_trips", first)
    late = [trip(d, tips=9.0, ingestion_ts=LOAD2) for d in days[:990]] + [trip(days[-1] + dt.timedelta(days=9))]
    again = Warehouse(spark, workdir, grain="month", key_buckets=1)
    assert (again.grain, again.key_buckets) == ("day", 16)
    again.upsert("stg_trips", stage_trips(raw_df(spark, late)), "trip_id")
    rows = again.logical("stg_trips")
    assert rows.count() == 1001 and rows.filter("tips = 9.0").count() == 990
    assert rows.select("trip_id").distinct().count() == 1001


def test_a_stopped_upsert_is_finished_by_the_next_run(spark, workdir, monkeypatch):
    wh = Warehouse(spark, workdir, grain="day")
    wh.overwrite("stg_trips", stage_trips(raw_df(spark, [trip(D1), trip(D2)])))
    updates = stage_trips(raw_df(spark, [trip(D1, tips=9.0, ingestion_ts=LOAD2)]))

    def stop(self, name, df):
        # As a driver that dies after the old partitions are gone.
        self.overwrite(name, df.limit(0))
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "replace_periods", stop)
        try:
            wh.upsert("stg_trips", updates, "trip_id")
        except KeyboardInterrupt:
            pass
    Warehouse(spark, workdir).recover()
    assert 9.0 in {r.tips for r in wh.logical("stg_trips").collect()}
    assert wh.read_state("_pending_copy") == []


def test_state_keeps_the_newest_complete_version(spark, workdir):
    wh = Warehouse(spark, workdir)
    assert wh.read_state("_pending_periods") is None
    wh.set_pending_periods([D1.date()])
    spark.createDataFrame([(D2.date(),)], "pickup_period date").write.parquet(
        f"{wh._state_path('_pending_periods')}/v0000000009")
    import os
    os.remove(f"{wh._state_path('_pending_periods')}/v0000000009/_SUCCESS")
    assert wh.pending_periods() == [D1.date()]
    wh.set_pending_periods([])
    assert wh.pending_periods() == []


def test_shared_root_needs_a_shared_folder_off_local_masters():
    import pytest

    from tripmart.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        class _jsc:
            class sc:
                class getCheckpointDir:
                    isDefined = isEmpty = staticmethod(lambda: False)

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_location_id_out_of_range_rejects_file(spark, workdir):
    land = f"{workdir}/landing"
    _landing(spark, [trip(D1, PULocationID=1234)], f"{land}/bad")
    _landing(spark, [trip(D2)], f"{land}/good")
    ingest_landing(spark, land, f"{workdir}/raw", f"{workdir}/rej", f"{workdir}/ck")
    assert [r.pickup_datetime for r in read_raw(spark, f"{workdir}/raw").collect()] == [D2]


def test_hot_key_holding_a_third_of_rows(spark, workdir):
    from tripmart.operators.quality import unique_check

    wh = Warehouse(spark, workdir, grain="day")
    hol = seeds.holidays(spark)
    hot = [trip(D1, tips=float(i)) for i in range(40)]                  # one trip_id, 40 rows
    other = [trip(D1 + dt.timedelta(minutes=i + 1)) for i in range(80)]
    run_models(wh, raw_df(spark, hot + other), zones(spark), hol)
    assert wh.logical("stg_trips").count() == 120 and wh.logical("fact_trips").count() == 120
    dup = unique_check(wh.logical("fact_trips"), "trip_id").collect()
    assert [(r.row_count) for r in dup] == [40]
    assert wh.logical("bi_daily_metrics").first().total_trips == 120

    late_hot = [trip(D1, tips=100.0 + i, ingestion_ts=LOAD2) for i in range(20)]
    run_models(wh, raw_df(spark, hot + other + late_hot), zones(spark), hol)
    stg = wh.logical("stg_trips")
    assert stg.count() == 100                                  # all 40 hot rows replaced by the 20 new
    assert stg.filter(F.col("tips") >= 100).count() == 20
    assert wh.logical("fact_trips").count() == 120             # key already in the fact
    assert wh.logical("bi_daily_metrics").first().total_trips == 120


def test_missing_downstream_tables_are_rebuilt_in_full(spark, workdir):
    """A first run that died after staging: the next run builds the fact,
    dimensions and marts from all of staging, not just the new periods."""
    from tripmart.operators.staging import high_water_mark

    wh = Warehouse(spark, workdir, grain="day")
    hol = seeds.holidays(spark)
    first = [trip(D1), trip(D2)]
    wh.overwrite("stg_trips", stage_trips(raw_df(spark, first)))       # only staging committed
    wh.set_high_water_mark(high_water_mark(wh.read("stg_trips")))
    late = trip(dt.datetime(2025, 3, 9, 7, 0), ingestion_ts=LOAD2)
    rep = run_models(wh, raw_df(spark, first + [late]), zones(spark), hol)
    assert rep.first_run["stg_trips"] is False and rep.first_run["fact_trips"] is True
    assert wh.logical("fact_trips").count() == 3
    assert sum(r.trip_count for r in wh.logical("bi_geo_time_metrics").collect()) == 3
    assert wh.logical("bi_daily_metrics").count() == 3


def test_upsert_rewrites_only_touched_key_buckets(spark, workdir):
    import os

    wh = Warehouse(spark, workdir, grain="day", key_buckets=4)
    hol = seeds.holidays(spark)
    first = [trip(D1 + dt.timedelta(minutes=i)) for i in range(40)]
    run_models(wh, raw_df(spark, first), zones(spark), hol)
    root = wh.path("stg_trips").replace("file:", "")

    def cells():
        out = {}
        for d, _, files in os.walk(root):
            parquet = sorted(f for f in files if f.endswith(".parquet"))
            if parquet:
                out[os.path.relpath(d, root)] = parquet
        return out

    before = cells()
    assert len(before) == 4                       # one day, four key buckets
    late = trip(D1 + dt.timedelta(minutes=5), tips=9.0, ingestion_ts=LOAD2)
    run_models(wh, raw_df(spark, first + [late]), zones(spark), hol)
    after = cells()
    assert set(after) == set(before)
    assert sum(before[c] != after[c] for c in before) == 1   # only the late key's cell rewritten
    stg = wh.logical("stg_trips")
    assert stg.count() == 40 and stg.filter(F.col("tips") == 9.0).count() == 1
    assert wh.logical("fact_trips").count() == 40
    # The bucket count is part of the layout: reopening keeps it.
    assert Warehouse(spark, workdir, grain="day", key_buckets=16).key_buckets == 4


def test_an_upsert_of_most_rows_writes_the_table_once_and_switches(spark, workdir, monkeypatch):
    wh = Warehouse(spark, workdir, grain="day", key_buckets=4)
    days = [D1 + dt.timedelta(days=i) for i in range(10)]
    wh.overwrite("stg_trips", stage_trips(raw_df(spark, [trip(d) for d in days])))
    updates = stage_trips(raw_df(spark, [trip(d, tips=9.0, ingestion_ts=LOAD2) for d in days[:8]]))
    before = wh.path("stg_trips")

    def stop(self, name, folder):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_switch", stop)
        try:
            wh.upsert("stg_trips", updates, "trip_id")
        except KeyboardInterrupt:
            pass
    # Stopped before the switch: the old table, whole.
    again = Warehouse(spark, workdir)
    assert again.path("stg_trips") == before and again.logical("stg_trips").filter("tips = 9.0").count() == 0
    again.upsert("stg_trips", updates, "trip_id")
    assert again.read_state("_pending_copy") is None and again.path("stg_trips") != before
    rows = again.logical("stg_trips")
    assert rows.count() == 10 and rows.filter("tips = 9.0").count() == 8
    assert {r.pickup_datetime for r in rows.filter("tips <> 9.0").collect()} == set(days[8:])
    # An increment of few rows still rewrites its own cells only.
    again.upsert("stg_trips", stage_trips(raw_df(spark, [trip(days[9], tips=7.0, ingestion_ts=LOAD2)])), "trip_id")
    assert again.read_state("_pending_copy") == [] and again.logical("stg_trips").count() == 10


def test_only_suspected_files_are_decoded_in_full_before_the_load(spark, workdir, monkeypatch):
    from tripmart.sources import ingest

    land, raw_path, rej, ck = f"{workdir}/landing", f"{workdir}/RAW/fhv_trips", f"{workdir}/RAW/_rejected", f"{workdir}/_ck"
    judged, full = [], ingest.refused
    monkeypatch.setattr(ingest, "refused", lambda spark, paths: judged.append(paths) or full(spark, paths))
    _landing(spark, [trip(D1), trip(D2)], f"{land}/2025-03")
    ingest_landing(spark, land, raw_path, rej, ck)
    assert judged == [] and read_raw(spark, raw_path).count() == 2
    assert spark.read.parquet(rej).count() == 0
    _landing(spark, [trip(D1)], f"{land}/2025-04", flag_text=" ")
    _landing(spark, [trip(D2)], f"{land}/2025-05")
    ingest_landing(spark, land, raw_path, rej, ck)
    assert [len(p) for p in judged] == [1] and "2025-04" in judged[0][0]
    assert read_raw(spark, raw_path).count() == 3
    assert [(r["reason"], r["bad_rows"]) for r in spark.read.parquet(rej).collect()] == [("value", 1)]
