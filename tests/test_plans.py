"""Plan shapes that matter at scale: broadcasts, partial aggregation,
pushed filters, partition pruning, column pruning."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SF_SMALL
from tripmart.plans.models import FullBuild


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def model(spark):
    return FullBuild(spark, SF_SMALL)


@pytest.mark.parametrize("mart", ["daily", "driver", "flag", "geo"])
def test_marts_broadcast_dimensions_and_aggregate_partially(model, mart):
    p = plan(getattr(model, mart))
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p
    assert "BroadcastHashJoin" in p
    # partial aggregate below the shuffle, final above it
    assert re.search(r"HashAggregate[\s\S]*Exchange[\s\S]*HashAggregate", p)
    assert "partial_" in p


def test_geo_aggregates_ids_before_names(model):
    p = plan(model.geo)
    # The first shuffle is keyed by the hour and the two location ids.
    first = re.search(r"Arguments: hashpartitioning\(([^)]*)\)", p).group(1)
    assert "pulocation_id" in first and "dolocation_id" in first
    assert "zone" not in first and "borough" not in first


def test_lineitem_scan_reads_only_needed_columns(model):
    p = plan(model.daily)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "l_returnflag" in schema and "l_comment" not in schema


def test_incremental_reads_prune(spark, workdir):
    from pyspark.sql import functions as F

    from tripmart.operators.staging import stage_trips
    from tripmart.plans.warehouse import Warehouse
    from tripmart.sources import fixtures

    wh = Warehouse(spark, workdir, grain="month")
    raw = fixtures.raw_trips(spark, SF_SMALL).filter(F.col("ingestion_ts") == F.lit(fixtures.LOAD_1_TS))
    wh.overwrite("stg_trips", stage_trips(raw))
    periods = wh.periods_of(wh.read("stg_trips"))[:2]
    p = plan(wh.read("stg_trips", periods).select("trip_id"))
    assert "PartitionFilters: [pickup_period" in p
    assert re.search(r"ReadSchema: struct<trip_id:string>", p)
    # The high-water-mark filter reaches the Parquet reader.
    later = stage_trips(wh.read("stg_trips").withColumnRenamed("pulocation_id", "PULocationID")
                        .withColumnRenamed("dolocation_id", "DOLocationID")
                        .withColumn("hvfhs_license_num", F.lit("HV0003")), after=1)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ingestion_ts", plan(later))


def test_no_python_udfs_anywhere(model):
    for df in [model.stg, model.fact, model.daily, model.driver, model.flag, model.geo]:
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_upsert_cells_prune_on_both_partition_columns(spark, workdir):
    from pyspark.sql import functions as F

    from tripmart.operators.staging import stage_trips
    from tripmart.plans.warehouse import Warehouse
    from tripmart.sources import fixtures

    wh = Warehouse(spark, workdir, grain="month", key_buckets=4)
    raw = fixtures.raw_trips(spark, SF_SMALL).filter(F.col("ingestion_ts") == F.lit(fixtures.LOAD_1_TS))
    wh.overwrite("stg_trips", stage_trips(raw))
    period = wh.periods_of(wh.read("stg_trips"))[0]
    cells = spark.createDataFrame([(period, 1), (period, 3)], "pickup_period date, key_bucket int")
    df = wh.read("stg_trips", [period], cells)
    p = plan(df.select("trip_id"))
    filters = re.search(r"PartitionFilters: \[([^\n]*)\]", p).group(1)
    assert "pickup_period" in filters and "key_bucket" in filters
    assert set(r.key_bucket for r in df.select("key_bucket").distinct().collect()) <= {1, 3}


def _increment(spark, workdir):
    """A month table of the first load and a stored increment that overlaps it."""
    from pyspark.sql import functions as F

    from tripmart.operators.staging import stage_trips
    from tripmart.plans.warehouse import Warehouse
    from tripmart.sources import fixtures

    wh = Warehouse(spark, workdir, grain="month", key_buckets=4)
    raw = fixtures.raw_trips(spark, SF_SMALL)
    wh.overwrite("stg_trips", stage_trips(raw.filter(F.col("ingestion_ts") == F.lit(fixtures.LOAD_1_TS))))
    old = wh.read("stg_trips").where("month(pickup_datetime) = 3")
    later = stage_trips(raw).where("month(pickup_datetime) < 5").unionByName(old.select(*stage_trips(raw).columns))
    _, new, cells, periods, _ = wh.store_increment(later)
    return wh, new.filter(F.col("pickup_period").isin(periods)), cells, periods


def test_increment_anti_join_moves_no_row_of_the_large_side(spark, workdir):
    from tripmart.operators.joins import anti_join_increment, anti_join_keys

    keys = ["pickup_period", "trip_id"]
    wh, new, cells, periods = _increment(spark, workdir)
    existing = wh.read("stg_trips", periods, cells)
    rows = new.count()
    df = anti_join_increment(new, existing, keys, rows)
    p = plan(df)
    assert "SortMergeJoin" not in p and p.count("Join type: LeftSemi") >= 1 and "Join type: LeftAnti" in p
    # The large side's scan reads keys only, and only the increment's keys are exchanged before the semi-join.
    assert re.search(r"ReadSchema: struct<trip_id:string>", p)
    want = anti_join_keys(new, wh.read("stg_trips"), keys)
    assert 0 < want.count() < rows
    assert df.exceptAll(want).count() == want.exceptAll(df).count() == 0


def test_increment_anti_join_beyond_the_limit_has_a_bloom_filter(spark, workdir):
    from tripmart.operators.joins import anti_join_increment, anti_join_keys

    keys = ["pickup_period", "trip_id"]
    wh, new, cells, periods = _increment(spark, workdir)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = anti_join_increment(new, wh.read("stg_trips", periods), keys, rows=10**12)
        p = plan(df)
        assert "might_contain" in p and "BroadcastHashJoin" not in p
        want = anti_join_keys(new, wh.read("stg_trips"), keys)
        assert df.exceptAll(want).count() == want.exceptAll(df).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_upsert_of_a_small_increment_shuffles_no_row_of_the_target(spark, workdir):
    from tripmart.operators.joins import anti_join_keys

    wh, new, cells, periods = _increment(spark, workdir)
    keys = ["pickup_period", "key_bucket", "trip_id"]
    p = plan(anti_join_keys(wh.read("stg_trips", periods, cells), new, keys, new.count()))
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    # One exchange: the increment's distinct keys.
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
