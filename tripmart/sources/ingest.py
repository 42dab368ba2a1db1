"""Raw load: cast landing rows by name, reject whole files, stamp, append.

One call handles one batch of files (a streaming micro-batch). The unit of
acceptance is the publisher's file: a Parquet file, or the folder of the
``part-*`` files Spark wrote for it. A unit is skipped as a whole and listed
in a quarantine table if

* a value that is present does not fit its declared type (flag text that is
  not a boolean, a location id beyond three digits, a licence longer than six
  characters), or
* the Parquet reader cannot read all of it (a truncated file, a column of a
  type that cannot be widened).

All other units load, and the batch is never offered again. A field a file
lacks reads as NULL.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.calendar import period_of
from tripmart.functions.casts import range_checked_int, text_to_bool
from tripmart.operators.joins import bounded_broadcast
from tripmart.schemas import FLAGS, LANDING, RAW, RAW_NOT_NULL, with_field
from tripmart.session import child_names

FILE = "_file"      # the unit of acceptance
PATH = "_path"      # a Parquet file of it
LOAD_ID = "load_id"

#: What a load says of itself: its rows, and rows without a value that must be there.
METRICS = ["row_count", *[f"null_{c}" for c in RAW_NOT_NULL]]


def load_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in RAW_NOT_NULL]]


def _typed(name: str) -> Column:
    src = F.col(name)
    if name in FLAGS:
        return text_to_bool(src)
    if name in ("PULocationID", "DOLocationID"):
        return range_checked_int(src, 3)
    if name == "hvfhs_license_num":
        s = src.cast("string")
        return F.when(F.length(s) <= 6, s)
    return src.try_cast(RAW[name].dataType)


#: Columns with a value that can fail its cast; the others have the raw table's type already.
CHECKED = [f.name for f in LANDING.fields
           if f.dataType != RAW[f.name].dataType or f.name == "hvfhs_license_num"]


def bad_row() -> Column:
    """Whether some source value is non-NULL but its typed value is NULL (the cast failed)."""
    return reduce(lambda a, b: a | b, [F.col(n).isNotNull() & _typed(n).isNull() for n in CHECKED])


def cast_batch(batch: DataFrame) -> DataFrame:
    """Typed raw columns and the unit they come from."""
    return batch.select(*[_typed(n).alias(n) for n in LANDING.fieldNames()], F.col(FILE))


def unit_of(path: Column) -> Column:
    """The unit a file belongs to: its folder if it is a part, else itself."""
    return F.regexp_replace(path, "/part-[^/]*$", "")


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the files with their path; a file that cannot be read ends
    early instead of failing the job, which :func:`refused` finds."""
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
    return rows.withColumn(PATH, F.col("_metadata.file_path")).withColumn(FILE, unit_of(F.col(PATH)))


def _counted(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """(path, unit, stated, decoded, bad, broken) of every file.

    A count without columns comes from the footers alone; reading ``columns``
    as declared must give as many rows, else the file is unreadable. The same
    pass counts the rows with a value that does not fit its type.
    """
    listed = spark.createDataFrame([(p,) for p in paths], f"{PATH} string")
    stated = _read(spark, paths, T.StructType()).groupBy(PATH).agg(F.count(F.lit(1)).alias("stated"))
    # Rows counted by a hash of the columns, so that the reader decodes each
    # of them (a plain count of the hash would be planned without columns).
    even = F.xxhash64(*columns) % 2 == 0
    seen = (_read(spark, paths, LANDING).select(PATH, even.alias("even"), bad_row().alias("bad")).groupBy(PATH)
            .agg((F.count_if("even") + F.count_if(~F.col("even"))).alias("decoded"), F.count_if("bad").alias("bad")))
    files = listed.join(stated, PATH, "left").join(seen, PATH, "left")
    empty = (F.col("stated") == 0) & F.col("decoded").isNull()
    broken = F.col("stated").isNull() | (F.coalesce("decoded", F.lit(0)) < F.col("stated")) & ~empty
    return files.select("*", unit_of(F.col(PATH)).alias(FILE), broken.alias("broken"))


def refused(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(unit, reason, bad_rows) of units to skip, from one pass over the files
    that decodes every column. It runs on the executors."""
    units = _counted(spark, paths, LANDING.fieldNames()).groupBy(FILE).agg(
        F.max("broken").alias("broken"), F.sum("bad").alias("bad"))

    def reason(name: str, rows: Column) -> Column:
        return F.struct(F.lit(name).alias("reason"), rows.cast("long").alias("bad_rows"))

    reasons = F.array_compact(F.array(F.when(F.col("broken"), reason("unreadable", F.lit(None))),
                                      F.when(F.col("bad") > 0, reason("value", F.col("bad")))))
    return units.select(FILE, F.explode(reasons).alias("r")).select(FILE, "r.*")


def suspects(spark: SparkSession, paths: list[str]) -> tuple[list[str], dict[str, int]]:
    """Files of the units that :func:`refused` must judge, and the rows the
    footers of each unit state.

    Only the columns that a cast can fail on are decoded. A file that cannot
    be read in another column is not among them: the load finds that it wrote
    too few rows. The driver holds the list of files already.
    """
    rows = _counted(spark, paths, CHECKED).select(
        PATH, FILE, "stated", (F.col("broken") | (F.coalesce("bad", F.lit(0)) > 0)).alias("suspect")).collect()
    units = {r[FILE] for r in rows if r["suspect"]}
    stated: dict[str, int] = {}
    for r in rows:
        stated[r[FILE]] = stated.get(r[FILE], 0) + (r["stated"] or 0)
    return sorted(r[PATH] for r in rows if r[FILE] in units), stated


def _quarantine(spark: SparkSession, paths: list[str], path: str, when: Column, stated: dict[str, int]) -> tuple[int, int]:
    """Write the refused units among ``paths``; their number, and the rows the other units of the load state."""
    rows = refused(spark, paths) if paths else spark.createDataFrame([], f"{FILE} string, reason string, bad_rows long")
    rows.select("*", when).coalesce(1).write.mode("overwrite").parquet(path)
    bad = {r[0] for r in spark.read.parquet(path).select(FILE).distinct().collect()}
    return len(bad), sum(n for unit, n in stated.items() if unit not in bad)


def _write_good(spark: SparkSession, paths: list[str], raw_path: str, rejected_path: str, load_id: str, when: Column,
                n_bad: int, grain: str) -> dict:
    """Write the units that are not quarantined; the metrics observed meanwhile."""
    bad = spark.read.parquet(f"{rejected_path}/{LOAD_ID}={load_id}").select(FILE).distinct()
    good = cast_batch(_read(spark, paths, LANDING)).join(bounded_broadcast(bad, rows=n_bad), FILE, "left_anti")
    out = good.select(*[F.col(f.name) for f in RAW.fields if f.name != "ingestion_ts"], when)
    out = out.withColumn("pickup_period", period_of("pickup_datetime", grain))
    out = out.hint("rebalance", "pickup_period").sortWithinPartitions("pickup_period", "pickup_datetime")
    # Observed above the last shuffle: only the tasks that write are counted,
    # and a task that is run again counts once.
    seen = Observation(f"load {load_id}")
    # Static: a replay must not keep partitions it no longer writes.
    (out.observe(seen, *load_metrics()).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("pickup_period").parquet(f"{raw_path}/{LOAD_ID}={load_id}"))
    return seen.get


def load_batch(spark: SparkSession, paths: list[str], raw_path: str, rejected_path: str, load_id: str,
               stamp: dt.datetime, grain: str = "day") -> dict:
    """Load the files into ``raw_path/load_id=<load_id>`` (idempotent per id),
    clustered by pickup ``grain`` (day or month) within the load.

    Bad units are found first and written as the load's quarantine rows (at
    most one a file and reason); the good ones are then read again, so no
    batch has to fit in memory. Units that a pass over the checked columns
    suspects are judged by all columns; should the load write fewer rows than
    the footers of the other units state, every unit is judged so, and the
    load written again. The load's metrics are observed while it is
    written, and kept with its row in the list of loads. ``stamp`` is the load's ``ingestion_ts``.
    """
    when = F.lit(stamp).cast("timestamp").alias("ingestion_ts")
    judged, stated = suspects(spark, paths)
    n_bad, kept = _quarantine(spark, judged, f"{rejected_path}/{LOAD_ID}={load_id}", when, stated)
    metrics = _write_good(spark, paths, raw_path, rejected_path, load_id, when, n_bad, grain)
    if (metrics.get("row_count") or 0) != kept:
        n_bad, _ = _quarantine(spark, paths, f"{rejected_path}/{LOAD_ID}={load_id}", when, stated)
        metrics = _write_good(spark, paths, raw_path, rejected_path, load_id, when, n_bad, grain)
    # Written last: a load listed here is complete (a replay lists it again).
    (spark.range(1).select(when, *[F.lit(metrics.get(m) or 0).cast("long").alias(m) for m in METRICS])
        .coalesce(1).write.mode("overwrite").parquet(f"{loads_path(raw_path)}/{LOAD_ID}={load_id}"))
    return {"load_id": load_id, "rejected_files": n_bad}


def loads_path(raw_path: str) -> str:
    return f"{raw_path}_loads"


def read_loads(spark: SparkSession, raw_path: str) -> DataFrame:
    """(ingestion_ts, METRICS, load_id) of every load, one small row each.

    Loads written before metrics were kept have NULL metrics.
    """
    metrics = ", ".join(f"{m} long" for m in METRICS)
    return spark.read.schema(f"ingestion_ts timestamp, {metrics}, {LOAD_ID} string").parquet(loads_path(raw_path))


def load_ids(spark: SparkSession, raw_path: str) -> list[str]:
    """Ids of the loads that have a folder, from its listing."""
    return [n.split("=", 1)[1] for n in child_names(spark, raw_path) if n.startswith(f"{LOAD_ID}=")]


def after_mark(raw: DataFrame, loads: DataFrame, mark: int) -> DataFrame:
    """The raw rows of loads stamped after ``mark`` (epoch micros): prunes
    the partitions of all earlier loads. Loads after a mark are few."""
    ids = [r[0] for r in loads.filter(F.unix_micros("ingestion_ts") > mark).select(LOAD_ID).collect()]
    return raw.filter(F.col(LOAD_ID).isin(ids))


def read_raw(spark, raw_path: str) -> DataFrame:
    """The raw table (all loads) with its declared schema."""
    schema = with_field(with_field(RAW, LOAD_ID, T.StringType()), "pickup_period", T.DateType())
    return spark.read.schema(schema).parquet(raw_path)
