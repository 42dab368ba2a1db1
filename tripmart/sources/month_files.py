"""Months that the landing folder has no good file for.

Which months were delivered is a question about files, not about trips: a
file holds trips that begin before midnight of its first day, and a month's
only file may have been rejected. Files are listed with the binary-file
source, of which only the path column is read: no file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.quality import months_frame
from tripmart.session import path_exists
from tripmart.sources.ingest import FILE, unit_of

REJECTED = f"{FILE} string, reason string, bad_rows long, ingestion_ts timestamp, load_id string"


def same_path(path: Column) -> Column:
    """One form of a path: ``file:///a`` and ``file:/a`` are the same file."""
    return F.regexp_replace(path, "^([a-z][a-z0-9+.-]*):/+", "$1:/")


def month_of(unit: Column) -> Column:
    """The ``yyyy-MM`` in the name of a publisher's file or of its folder; NULL without one."""
    name = F.regexp_extract(F.element_at(F.split(unit, "/"), -1), "(?<![0-9])([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9])", 1)
    return F.when(name != "", name)


def listed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(_file, month): the units under ``landing``, a row each."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(landing).select(same_path(unit_of(F.col("path"))).alias(FILE)))
    return files.distinct().withColumn("month", month_of(F.col(FILE)))


def rejected_files(spark: SparkSession, rejected_path: str) -> DataFrame:
    """(_file): units that some load refused. A refused unit is not offered again."""
    if not path_exists(spark, rejected_path):
        return spark.createDataFrame([], f"{FILE} string")
    rows = spark.read.schema(REJECTED).parquet(rejected_path)
    return rows.select(same_path(F.col(FILE)).alias(FILE)).distinct()


def missing_month_files(spark: SparkSession, landing: str, rejected_path: str,
                        months: list[tuple[int, int]]) -> DataFrame:
    """month, files, rejected: wanted months without a good file, sorted.

    ``files`` and ``rejected`` tell a month never delivered from one whose
    files were all refused. Files without a month in their name count for
    none; an empty list of months gives no rows.
    """
    refused = rejected_files(spark, rejected_path).withColumn("refused", F.lit(True))
    units = listed_files(spark, landing).join(refused, FILE, "left")
    by_month = units.groupBy("month").agg(F.count(F.lit(1)).alias("files"), F.count("refused").alias("rejected"))
    none = F.lit(0).cast("long")
    return (months_frame(spark, months).join(by_month, "month", "left")
            .select("month", F.coalesce("files", none).alias("files"), F.coalesce("rejected", none).alias("rejected"))
            .where(F.col("files") == F.col("rejected")).orderBy("month"))
