"""Interleaved keys and tables laid out by several columns."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tripmart.functions import interleave, place
from tripmart.plans.models import FullBuild
from tripmart.plans.warehouse import BUCKET, ORDER, PERIOD, Warehouse

SF = "/root/testdata/sf0.01"


def morton(places: list[int], bits: int) -> int:
    out = 0
    for b in reversed(range(bits)):
        for p in places:
            out = out * 2 + (p >> b & 1)
    return out


def test_interleaved_bits(spark):
    rows = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (5, 2, 7), (4095, 0, 4095), (4095, 4095, 4095)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    got = [r[0] for r in df.select(interleave([F.col("a"), F.col("b"), F.col("c")], 12)).collect()]
    assert got == [morton(list(r), 12) for r in rows]
    with pytest.raises(ValueError):
        interleave([F.col("a")] * 6, 12)
    with pytest.raises(ValueError):
        interleave([], 12)


def test_places(spark):
    df = spark.createDataFrame([(None,), (-9,), (0,), (50,), (100,), (900,)], "v int")
    got = [r[0] for r in df.select(place(F.col("v"), F.lit(0), F.lit(100), 4)).collect()]
    assert got == [0, 0, 0, 7, 15, 15]
    assert {r[0] for r in df.select(place(F.col("v"), F.lit(7), F.lit(7), 4)).collect()} == {0}
    assert {r[0] for r in df.select(place(F.col("v"), F.lit(None).cast("int"), F.lit(None).cast("int"), 4)).collect()} == {0}


def groups_to_read(wh: Warehouse, zone: int, since: dt.datetime, until: dt.datetime) -> tuple[int, int]:
    """Row groups whose statistics allow the zone and the time, and all row groups."""
    hit = total = 0
    for path in glob.glob(f"{wh.path('fact_trips').removeprefix('file:')}/{PERIOD}=*/{BUCKET}=*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            total += 1
            z, t = (meta.row_group(g).column(names[c]).statistics for c in ("pulocation_id", "pickup_datetime"))
            hit += z.min <= zone <= z.max and t.min < until and t.max >= since
    return hit, total


def multiset(df):
    return sorted(map(tuple, df.groupBy(df.columns).count().collect()), key=repr)


@pytest.fixture()
def small_row_groups(spark):
    names = {"parquet.block.size": "4096", "parquet.page.size": "1024", "parquet.block.size.row.check.min": "40",
             "parquet.page.size.row.check.min": "40", "parquet.block.size.row.check.max": "60"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_fewer_row_groups_for_zone_and_time(spark, workdir, small_row_groups):
    wh = Warehouse(spark, workdir, grain="month")
    fact = FullBuild(spark, SF).fact.where("pickup_datetime < TIMESTAMP_NTZ '2024-05-01 00:00:00'")
    wh.overwrite("fact_trips", fact)
    before = multiset(wh.logical("fact_trips"))
    zones = [r[0] for r in fact.select("pulocation_id").distinct().collect()]
    asked = [(z, dt.datetime(2024, 3, d), dt.datetime(2024, 3, d + 12)) for z in sorted(zones)[::4] for d in (1, 9, 17)]
    by_time = [groups_to_read(wh, *a) for a in asked]
    wh.recluster("fact_trips")
    by_both = [groups_to_read(wh, *a) for a in asked]
    assert multiset(wh.logical("fact_trips")) == before
    assert by_time[0][1] >= 20, "the table has too few row groups to tell"
    assert sum(h for h, _ in by_both) < 0.6 * sum(h for h, _ in by_time)
    assert ORDER not in wh.read("fact_trips").columns
    p = plan(wh.logical("fact_trips").where("pulocation_id = 3"))
    assert "EqualTo(pulocation_id,3)" in p


def test_periods_are_reclustered_from_a_copy(spark, workdir, monkeypatch):
    wh = Warehouse(spark, workdir, grain="month", key_buckets=2)
    fact = FullBuild(spark, SF).fact.where("pickup_datetime < TIMESTAMP_NTZ '2024-04-01 00:00:00'")
    fact = fact.withColumn("pulocation_id", F.when(F.hour("pickup_datetime") != 5, F.col("pulocation_id")))
    wh.overwrite("fact_trips", fact)
    before, place_ = multiset(wh.read("fact_trips")), wh.path("fact_trips")
    periods = wh.periods_of(wh.logical("fact_trips"))
    assert len(periods) > 2

    def stop(self, name, df):
        raise KeyboardInterrupt(name)

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "replace_periods", stop)
        with pytest.raises(KeyboardInterrupt):
            wh.recluster("fact_trips", periods=periods[:1])
    again = Warehouse(spark, workdir)
    assert again.read_state("_pending_copy") and multiset(again.read("fact_trips")) == before
    again.recover()
    assert not again.read_state("_pending_copy")
    assert multiset(again.read("fact_trips")) == before and again.path("fact_trips") == place_
    again.recluster("fact_trips", periods=[])
    with pytest.raises(ValueError):
        again.recluster("dim_location")


def test_an_empty_table_is_reclustered(spark, workdir):
    wh = Warehouse(spark, workdir)
    wh.overwrite("fact_trips", FullBuild(spark, SF).fact.limit(0))
    wh.recluster("fact_trips")
    assert wh.logical("fact_trips").count() == 0
