"""The monthly entry point end to end: landing files -> raw -> models -> checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.plans.monthly import run_monthly
from tripmart.sources import fixtures
from tripmart.sources.landing import write_landing


def test_monthly_runs(spark, workdir):
    raw = fixtures.raw_trips(spark, SF_SMALL)
    zones = fixtures.zone_lookup(spark, SF_SMALL).toDF("LocationID", "Borough", "Zone", "service_zone")
    zones.coalesce(1).write.option("header", True).csv(f"{workdir}/zones")
    landing, wh = f"{workdir}/landing", f"{workdir}/warehouse"

    write_landing(raw.filter(F.col("ingestion_ts") == F.lit(fixtures.LOAD_1_TS)), f"{landing}/load_1")
    rep1 = run_monthly(spark, landing, wh, f"{workdir}/zones", grain="month")
    assert rep1["models"]["first_run"]["stg_trips"] is True
    assert [r["status"] for r in rep1["checks"]["not_null"]] == ["pass"] * 3
    assert rep1["checks"]["unique_dim_datetime_key"] == [{"duplicate_keys": 0, "rows": 0}]

    write_landing(raw.filter(F.col("ingestion_ts") == F.lit(fixtures.LOAD_2_TS)), f"{landing}/load_2")
    rep2 = run_monthly(spark, landing, wh, f"{workdir}/zones", grain="month")
    assert rep2["models"]["first_run"]["stg_trips"] is False
    assert len(rep2["loads"]) == 1 and rep2["loads"][0]["rejected_files"] == 0
    rel = {r["relationship"]: r["orphan_rows"] for r in rep2["checks"]["relationships"]}
    assert rel["fact_trips.pickup_hour -> dim_datetime.full_timestamp"] == 0

    # Through files and the stream, the two runs give the same staging and
    # fact as the two-load SQL oracle (load stamps differ, rows do not).
    from tests.oracle_compare import duck
    from tripmart.plans import oracle as O
    from tripmart.plans.warehouse import Warehouse
    w = Warehouse(spark, wh, grain="month")
    con = duck(SF_SMALL)
    for table, cte in [("stg_trips", "stg_2"), ("fact_trips", "fact_2"), ("bi_daily_metrics", "daily_2")]:
        cols = [c for c in w.logical(table).columns if c != "ingestion_ts"]
        key = lambda t: tuple((v is None, str(v)) for v in t)
        got = sorted((tuple(r) for r in w.logical(table).select(*cols).collect()), key=key)
        sql = O.with_ctes(O.two_load_ctes(), f"SELECT {', '.join(cols)} FROM {cte}")
        want = sorted((tuple(r) for r in con.execute(sql).fetchall()), key=key)
        assert got == want, table


def test_views_expose_tables_to_sql(spark, workdir):
    from tripmart.plans.pipeline import run_models
    from tripmart.plans.warehouse import Warehouse
    from tripmart.sources import seeds

    wh = Warehouse(spark, workdir, grain="month")
    run_models(wh, fixtures.raw_trips_load(spark, SF_SMALL, 1), fixtures.zone_lookup(spark, SF_SMALL),
               seeds.holidays(spark))
    views = wh.register_views()
    assert {"bi_daily_metrics", "marts_bi_daily_metrics", "staging_stg_trips"} <= set(views)
    total = spark.sql("SELECT SUM(total_trips) AS n FROM marts_bi_daily_metrics").first().n
    joined = spark.sql("""SELECT COUNT(*) AS n FROM fact_trips f
                          JOIN dim_trip_flags d ON f.trip_flags_id = d.trip_flags_id""").first().n
    assert total == joined > 0


def test_seed_csv_readers(spark, workdir):
    from tripmart.sources import seeds

    # Holidays: header with an extra column, read back to (date, name).
    hol = seeds.holidays(spark).withColumn("is_federal_holiday", F.lit(True))
    hol.coalesce(1).write.option("header", True).csv(f"{workdir}/holidays")
    back = seeds.read_holidays_csv(spark, f"{workdir}/holidays")
    assert back.columns == ["holiday_date", "holiday_name"]
    assert sorted(back.collect()) == sorted(seeds.holidays(spark).collect())

    # Zones: a header that already names location_id is kept; N/A stays text.
    rows = [("1", "EWR", "Newark Airport", "EWR"), ("264", "Unknown", "N/A", "N/A")]
    spark.createDataFrame(rows, "location_id string, borough string, zone string, service_zone string") \
        .coalesce(1).write.option("header", True).csv(f"{workdir}/zones")
    z = seeds.read_zone_lookup_csv(spark, f"{workdir}/zones").orderBy("location_id").collect()
    assert [(r.location_id, r.zone) for r in z] == [(1, "Newark Airport"), (264, "N/A")]


def _inputs(spark, workdir):
    raw = fixtures.raw_trips_load(spark, SF_SMALL, 1).limit(200)
    zones = fixtures.zone_lookup(spark, SF_SMALL).toDF("LocationID", "Borough", "Zone", "service_zone")
    zones.coalesce(1).write.option("header", True).csv(f"{workdir}/zones")
    write_landing(raw, f"{workdir}/landing/load_1")
    used = raw.groupBy("PULocationID").count().orderBy(F.desc("count")).first()[0]
    zones.filter(F.col("LocationID") != used).coalesce(1).write.option("header", True).csv(f"{workdir}/fewer")


def test_later_runs_check_whole_tables_and_set_the_exit_status(spark, workdir, capsys):
    """A zone that went missing, and NULLs in an old load, are found by a run
    without a new file; so is a month that should be there."""
    from tripmart.plans.monthly import main, raw_paths

    _inputs(spark, workdir)
    args = ["--landing", f"{workdir}/landing", "--warehouse", f"{workdir}/wh", "--grain", "month", "--zones"]
    import json
    main([*args, f"{workdir}/zones"], spark)
    first = json.loads(capsys.readouterr().out)
    # The made-up trips hold unknown zones and flags by design.
    assert all(f.startswith("relationship") for f in first["failures"])

    def orphans(report):
        return {r["relationship"]: r["orphan_rows"] for r in report["checks"]["relationships"]}
    assert main([*args, f"{workdir}/fewer", "--dates", "2001-02,no-month"], spark) == 1
    report = json.loads(capsys.readouterr().out)
    assert report["loads"] == [] and report["missing_months"] == ["2001-02"]
    assert "missing month 2001-02" in report["failures"]
    pickup = "fact_trips.pulocation_id -> dim_location.location_id"
    assert orphans(report)[pickup] > orphans(first)[pickup] and f"relationship {pickup}" in report["failures"]
    raw = spark.read.parquet(raw_paths(f"{workdir}/wh")["raw"])
    raw.limit(1).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz")).drop("load_id", "pickup_period").write.parquet(
        f"{raw_paths(f'{workdir}/wh')['raw']}/load_id=old/pickup_period=__HIVE_DEFAULT_PARTITION__")
    assert main([*args, f"{workdir}/zones"], spark) == 1
    assert "not_null pickup_datetime" in json.loads(capsys.readouterr().out)["failures"]


def test_month_arguments():
    import pytest

    from tripmart.plans.monthly import main, target_months

    assert target_months("2025-01, 2025-13", None, "1-12") == [(2025, 1)]
    assert target_months(None, "2025-2026", "12-12") == [(2025, 12), (2026, 12)]
    assert target_months(None, None, "1-12") is None
    for years, months in [("2025-2025", "0-13"), ("2026-2025", "1-12"), ("x", "1-12")]:
        with pytest.raises(ValueError):
            target_months(None, years, months)
    with pytest.raises(SystemExit):
        main(["--landing", "a", "--warehouse", "b", "--zones", "c", "--years", "2025-2025", "--months", "0-13"])
