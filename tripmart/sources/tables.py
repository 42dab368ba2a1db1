"""Readers for the input Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Partitions a caller asks for when it knows that the trip table is stored
#: in fewer splits than it has cores (as the benchmark's single-row-group
#: files are). None, the default, leaves the scan as it is: a round-robin
#: shuffle of a large table would cost more than it gains.
SPREAD: int | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str,
               parallel: bool = False) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``, selecting only ``columns`` if given.

    Selecting up front keeps the scan's ReadSchema to what the job uses even
    before Catalyst's own pruning runs. ``parallel`` marks the large trip
    source, which :data:`SPREAD` applies to.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return df.repartition(SPREAD) if parallel and SPREAD else df
