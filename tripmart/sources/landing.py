"""Publisher-style monthly trip files, materialised from raw trip rows.

Real input arrives as one Parquet file per month from the publisher: wide
integer ids, flags as ``Y``/``N`` text, and no ``cbd_congestion_fee``
column before 2025. This writes rows in that shape so the ingest path can
be exercised on data derived from the benchmark tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import FLAGS, LANDING

FEE_COLUMN_FROM = "2025-01-01"     # files for earlier months lack the column


def flag_text(flag: Column, null_text: Column) -> Column:
    return F.when(flag, F.lit("Y")).when(~flag, F.lit("N")).otherwise(null_text)


def landing_rows(raw: DataFrame, blank_null_months: tuple[int, ...] = ()) -> DataFrame:
    """Raw rows in the landing layout plus ``_month`` (``yyyy-MM``).

    In ``blank_null_months`` (calendar month numbers) the producer writes a
    missing flag as a blank ``' '`` instead of NULL -- unparseable text, so
    the loader rejects every such file that has a missing flag.
    """
    pk = F.col("pickup_datetime")
    blank = F.month(pk).isin(list(blank_null_months)) if blank_null_months else F.lit(False)
    null_text = F.when(blank, F.lit(" ")).otherwise(F.lit(None).cast("string"))
    cols = []
    for f in LANDING.fields:
        if f.name in FLAGS:
            cols.append(flag_text(F.col(f.name), null_text).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return raw.select(*cols, F.date_format(pk, "yyyy-MM").alias("_month"))


def write_landing(raw: DataFrame, path: str, blank_null_months: tuple[int, ...] = ()) -> None:
    """Write monthly files under ``path`` (``_month=yyyy-MM/part-*.parquet``).

    Months before 2025 are written without ``cbd_congestion_fee``. A month's
    folder is one file of the publisher, whatever number of parts it has:
    the loader accepts or rejects it as a whole. A part is a day of the
    month, so no single task writes an unbounded month.
    """
    rows = landing_rows(raw, blank_null_months)
    pk = F.col("pickup_datetime")
    old = pk < F.lit(FEE_COLUMN_FROM).cast("timestamp_ntz")
    for part, keep_fee in [(rows.filter(old), False), (rows.filter(~old), True)]:
        cols = [c for c in part.columns if keep_fee or c != "cbd_congestion_fee"]
        (part.repartition("_month", F.dayofmonth(pk)).select(*cols).write.mode("append")
             .partitionBy("_month").parquet(path))
