"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_dir


#: Narrow rows that a task handles at least to write a table of a known size.
FILE_ROWS = 1 << 17


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``rows``, where known, bounds the rows that the writing stage handles: a
    small table is written by a task for each FILE_ROWS of them (a task for
    each core at least), not by one for each shuffle partition. The files
    follow the data then, and so do the processes that Hadoop starts in an
    executor for each file of a local file system (chmod).

    This cuts lineage: a lost executor costs a re-read of the table, not a
    recomputation of everything above it. The folder is the one the cluster
    names in ``spark.checkpoint.dir``; tables stay there until its owner
    clears it, since the returned frame is lazy.
    """
    path = scratch_dir(df.sparkSession, "llm", name)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once a context."""
    sc = spark.sparkContext
    if not getattr(sc, "_tripmart_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tripmart"), "zip",
                                   os.path.dirname(package), os.path.basename(package))
        sc.addPyFile(path)
        sc._tripmart_shipped = True


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """mapInPandas with a function of this package."""
    _ship(df.sparkSession)
    return df.mapInPandas(fn, schema)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch of the jobs run inside: for
    wide rows, of which the usual 10,000 would weigh on each task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a document row: its id and its text together.

    Rows equal in both get the same key, and every operator defines such
    repeats as one result that each of them receives.
    """
    return F.xxhash64(F.col(id_col), F.col(text_col))


def row_digest(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128-bit digest of a document row, id and text together (nulls apart
    from empty values): for joins whose result follows from equal keys."""
    def marked(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))

    return F.unhex(F.md5(F.concat_ws("|", marked(id_col), marked(text_col)))).alias("key")


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count, for repartition(n, key)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
