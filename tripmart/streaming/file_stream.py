"""Incremental file ingest with Structured Streaming.

The landing folder is a file stream source: the checkpoint remembers every
file already offered, so each monthly file loads exactly once however often
the folder is re-scanned. The stream carries paths only (the binary-file
source without its content column): a file that Parquet cannot read is found
by the loader and cannot stop the stream. ``trigger(availableNow=True)`` turns
one monthly run into "process everything new, then stop"; all new files are
one batch with one load stamp. The batch goes through
:func:`tripmart.sources.ingest.load_batch`, keyed by a load id derived from
the checkpoint and the batch id, so a batch replayed after a failure
overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import SparkSession

from tripmart.sources.ingest import load_batch


# The binary-file source's columns; only path is read.
FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_landing(spark: SparkSession, landing_dir: str, raw_path: str, rejected_path: str,
                   checkpoint: str, grain: str = "day") -> list[dict]:
    """Load every landing file not loaded before; return one report per batch."""
    tag = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]
    stamp = dt.datetime.now(dt.timezone.utc)
    reports: list[dict] = []

    def each_batch(batch, batch_id: int) -> None:
        # The file source holds this list on the driver already.
        paths = sorted(r.path for r in batch.collect())
        if paths:
            reports.append(load_batch(spark, paths, raw_path, rejected_path, f"{tag}-{batch_id:08d}", stamp, grain))

    src = (spark.readStream.format("binaryFile").schema(FILES)
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.parquet")
           .load(landing_dir).select("path"))
    query = (src.writeStream.foreachBatch(each_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return reports
