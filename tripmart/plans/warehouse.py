"""Parquet warehouse: one folder per layer, declared schemas, keyed writes.

Tables live at ``{root}/{LAYER}/{name}`` on shared storage. Trip-grain
tables are partitioned by ``pickup_period`` (the pickup's day, or month at
small volume) and then by ``key_bucket`` (a hash bucket of the trip key): a
trip's key is a function of its pickup time, so equal keys always share a
(period, bucket) cell and every keyed operation can be pruned to the cells
a batch touches.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.functions.calendar import period_of
from tripmart.functions.interleave import interleave, place
from tripmart.operators.joins import anti_join_keys, bounded_broadcast
from tripmart.session import child_names, configure, delete_path, path_exists

PERIOD = "pickup_period"
BUCKET = "key_bucket"
# Place of a row in the order of a reclustered table; not stored in it.
ORDER = "cluster_order"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableSpec:
    layer: str
    schema: T.StructType
    partitioned: bool = False      # by PERIOD, derived from pickup_datetime
    cluster: str | None = None     # sort key within files


TABLES: dict[str, TableSpec] = {
    "stg_trips": TableSpec("STAGING", schemas.STG_TRIPS, True, "pickup_datetime"),
    "fact_trips": TableSpec("MARTS", schemas.FACT_TRIPS, True, "pickup_datetime"),
    "dim_datetime": TableSpec("MARTS", schemas.DIM_DATETIME, False, "date_key"),
    "dim_location": TableSpec("MARTS", schemas.DIM_LOCATION),
    "dim_trip_flags": TableSpec("MARTS", schemas.DIM_TRIP_FLAGS),
    "bi_daily_metrics": TableSpec("MARTS", schemas.BI_DAILY, False, "date_key"),
    "bi_driver_metrics": TableSpec("MARTS", schemas.BI_DRIVER, False, "date_key"),
    "bi_flag_metrics": TableSpec("MARTS", schemas.BI_FLAG, False, "date_key"),
    "bi_geo_time_metrics": TableSpec("MARTS", schemas.BI_GEO, False, "date_key"),
}

# Small state tables, one folder a version (see Warehouse.write_state).
STATE: dict[str, str] = {
    "_pending_periods": "pickup_period date",
    "_pending_copy": "copy string, target string, ordered boolean",
    "_high_water_mark": "ingestion_micros long",
    "_layout": "key_buckets int, grain string",
    "_tables": "name string, folder string",
}


def layer_name(custom: str | None, default: str) -> str:
    """Layer (database) name: the custom name upper-cased, else the default."""
    return default if custom is None else custom.upper()


class Warehouse:
    """Tables under ``root``. Trip tables are partitioned by pickup period
    and, within it, by ``key_buckets`` buckets of the trip key, so a keyed
    upsert rewrites only the (period, bucket) cells its keys fall in. Grain
    and bucket count are fixed when the first trip table is written and read
    back from the layout state afterwards, whatever the caller asks for."""

    def __init__(self, spark: SparkSession, root: str, grain: str = "month", key_buckets: int = 1):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self._layout, self._layout_read = (key_buckets, grain), False
        self._tables: dict[str, str] | None = None

    def _stored_layout(self) -> tuple[int, str]:
        if not self._layout_read:
            self._layout_read = True
            rows = self.read_state("_layout")
            if rows:
                asked, self._layout = self._layout, (rows[0][0], rows[0][1])
                if asked != self._layout:
                    log.warning("%s is laid out by %s key buckets and %s; asked for %s", self.root, *self._layout, asked)
        return self._layout

    @property
    def key_buckets(self) -> int:
        return self._stored_layout()[0]

    @property
    def grain(self) -> str:
        return self._stored_layout()[1]

    def _save_layout(self) -> None:
        if self.read_state("_layout") is None:
            self.write_state("_layout", [(self.key_buckets, self.grain)])

    # -- state ----------------------------------------------------------------
    def _state_path(self, name: str) -> str:
        return f"{self.root}/{layer_name('STATE', 'PUBLIC')}/{name}"

    def _versions(self, name: str) -> list[str]:
        return [v for v in child_names(self.spark, self._state_path(name)) if v.startswith("v")]

    def read_state(self, name: str) -> list | None:
        """Rows of the newest complete version; None if there is none."""
        for version in reversed(self._versions(name)):
            path = f"{self._state_path(name)}/{version}"
            if path_exists(self.spark, f"{path}/_SUCCESS"):
                return self.spark.read.schema(STATE[name]).parquet(path).collect()
        return None

    def write_state(self, name: str, rows: list[tuple]) -> None:
        """Write a new version, then remove the older ones: a stop at any
        point leaves either the old or the new rows to read."""
        old = self._versions(name)
        version = f"v{int(old[-1][1:]) + 1 if old else 0:010d}"
        self.spark.createDataFrame(rows, STATE[name]).coalesce(1).write.parquet(f"{self._state_path(name)}/{version}")
        for v in old:
            delete_path(self.spark, f"{self._state_path(name)}/{v}")

    def scratch(self, name: str) -> str:
        """A new path for a temporary table; shared, since the root is."""
        return f"{self.root}/_scratch/{name}-{uuid.uuid4().hex}"

    # -- layout -------------------------------------------------------------
    def _folders(self) -> dict[str, str]:
        """Folder of each table that a full refresh has switched; others have their name."""
        if self._tables is None:
            self._tables = {r[0]: r[1] for r in self.read_state("_tables") or []}
        return self._tables

    def _layer(self, name: str) -> str:
        return f"{self.root}/{layer_name(TABLES[name].layer, 'PUBLIC')}"

    def path(self, name: str) -> str:
        return f"{self._layer(name)}/{self._folders().get(name, name)}"

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def read_schema(self, name: str) -> T.StructType:
        spec = TABLES[name]
        if not spec.partitioned:
            return spec.schema
        return schemas.with_field(schemas.with_field(spec.schema, PERIOD, T.DateType()), BUCKET, T.IntegerType())

    def read(self, name: str, periods: list | None = None, cells: DataFrame | None = None) -> DataFrame:
        """The table (with its partition columns if partitioned), pruned to
        ``periods``, and to the (period, bucket) rows of ``cells``.

        Periods prune partitions with one flat IN; cells are a semi-join, so
        the plan does not grow with them. Both sides filter by period, which
        lets Spark prune by the cells' buckets at run time as well.
        """
        df = self.spark.read.schema(self.read_schema(name)).parquet(self.path(name))
        if periods is not None:
            df = df.filter(F.col(PERIOD).isin(list(periods)))
        if cells is not None:
            cells = cells.select(PERIOD, BUCKET)
            if periods is not None:
                cells = cells.filter(F.col(PERIOD).isin(list(periods)))
            df = df.join(bounded_broadcast(cells), [PERIOD, BUCKET], "left_semi")
        return df

    def logical(self, name: str) -> DataFrame:
        """The table with exactly its model columns."""
        return self.read(name).select(*TABLES[name].schema.fieldNames())

    # -- writes -------------------------------------------------------------
    def with_period(self, df: DataFrame) -> DataFrame:
        """Add the partition columns: pickup period and trip-key bucket."""
        df = df.withColumn(PERIOD, period_of("pickup_datetime", self.grain))
        return df.withColumn(BUCKET, F.pmod(F.xxhash64("trip_id"), F.lit(self.key_buckets)).cast("int"))

    def _prepare(self, name: str, df: DataFrame) -> DataFrame:
        spec = TABLES[name]
        cols = spec.schema.fieldNames() + ([PERIOD, BUCKET] if spec.partitioned else [])
        if spec.partitioned and BUCKET not in df.columns:
            df = self.with_period(df)
        if ORDER in df.columns:
            # Ranges of the order: a cell's files hold disjoint ranges, and a
            # hot cell is cut into several. The sampling reads a stored table.
            keys = [PERIOD, BUCKET, ORDER]
            return df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*cols)
        df = df.select(*cols)
        if spec.partitioned:
            # Rebalance by partition value: AQE splits a hot period into
            # advisory-sized tasks instead of funnelling it through one.
            df = df.hint("rebalance", PERIOD, BUCKET).sortWithinPartitions(PERIOD, BUCKET, spec.cluster)
        elif spec.cluster:
            df = df.sortWithinPartitions(spec.cluster)
        return df

    def _writer(self, name: str, df: DataFrame, mode: str, dynamic: bool = False):
        if TABLES[name].partitioned:
            self._save_layout()
        w = self._prepare(name, df).write.mode(mode)
        if TABLES[name].partitioned:
            w = (w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
                  .partitionBy(PERIOD, BUCKET))
        return w

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Full refresh: the table becomes exactly ``df``.

        The commit writes ``_SUCCESS`` at the table root, which is what
        :meth:`exists` looks for, so a first build that dies midway counts
        as not built. A table that exists is built beside itself and then
        switched to by one small state write: a stop at any point leaves the
        old or the new table, whole. The folder switched from stays until the
        next refresh, for those who still read it.
        """
        if not self.exists(name):
            self._writer(name, df, "overwrite").parquet(self.path(name))
            return
        self._refresh(name, df)

    def _refresh(self, name: str, df: DataFrame) -> None:
        """Build an existing table anew beside itself, and switch to it."""
        before, folder = self._folders().get(name, name), f"{name}-{uuid.uuid4().hex}"
        self._writer(name, df, "errorifexists").parquet(f"{self._layer(name)}/{folder}")
        self._switch(name, folder)
        for other in child_names(self.spark, self._layer(name)):
            if (other == name or other.startswith(f"{name}-")) and other not in (before, folder):
                self.drop_scratch(f"{self._layer(name)}/{other}")

    def _switch(self, name: str, folder: str) -> None:
        folders = {**self._folders(), name: folder}
        self.write_state("_tables", sorted(folders.items()))
        self._tables = folders

    def replace_periods(self, name: str, df: DataFrame) -> None:
        """Replace only the partitions ((period, bucket) cells) present in ``df``."""
        self._writer(name, df, "overwrite", dynamic=True).parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        self._writer(name, df, "append").parquet(self.path(name))

    def store_increment(self, staged: DataFrame) -> tuple[str, DataFrame, DataFrame, list, int | None]:
        """Write an increment once; return its path, its rows, its cells, its
        periods and its newest load stamp (epoch micros).

        Cells (one row per period and bucket, from one partial + final
        aggregate) stay a table; only periods, at most one per day or month
        of the calendar, reach the driver.
        """
        path = self.scratch("increment")
        self.with_period(staged).write.parquet(path)
        new = self.spark.read.parquet(path)
        cells = new.groupBy(PERIOD, BUCKET).agg(F.unix_micros(F.max("ingestion_ts")).alias("mark"))
        cells.coalesce(1).write.parquet(f"{path}-cells")
        cells = self.spark.read.parquet(f"{path}-cells")
        per = cells.groupBy(PERIOD).agg(F.max("mark").alias("mark")).collect()
        marks = [r.mark for r in per if r.mark is not None]
        return path, new, cells, sorted(r[0] for r in per), (max(marks) if marks else None)

    def drop_scratch(self, path: str) -> None:
        for p in (path, f"{path}-cells"):
            try:
                delete_path(self.spark, p)
            except Exception as exc:  # the tables have committed; a leftover copy is harmless
                log.warning("could not remove %s: %s", p, exc)

    def periods_of(self, df: DataFrame) -> list:
        """Distinct partition values of ``df`` (bounded by the calendar: one
        per day or month), via a partial+final aggregate."""
        p = df.select(period_of("pickup_datetime", self.grain).alias(PERIOD)).distinct()
        return sorted(r[0] for r in p.collect())

    def upsert(self, name: str, updates: DataFrame, key: str) -> list:
        """Replace rows of ``name`` whose ``key`` occurs in ``updates``; add the rest.

        ``updates`` is written once and read back (see ``store_increment``).
        Returns the touched periods.
        """
        path, new, cells, periods, _ = self.store_increment(updates)
        self.upsert_cells(name, new, cells, periods, key, new.count())
        self.drop_scratch(path)
        return periods

    def upsert_cells(self, name: str, new: DataFrame, cells: DataFrame, periods: list, key: str,
                     rows: int | None = None) -> None:
        """Upsert a stored increment: only the (period, bucket) cells it
        touches are read and rewritten; a key lives in exactly one cell. With
        ``rows``, the increment's row count, the keys of a small increment are
        broadcast and the target's rows are not shuffled for the comparison.

        Every target row whose key appears in ``new`` is replaced (duplicate
        keys in ``new`` are all kept). The merged cells are written to a copy
        under the root and the copy is recorded before the partitions are
        overwritten from it. A run that stops in between is finished by
        ``recover``, so no kept row is lost. An increment whose cells hold
        more than half of the table's rows, each of which that would write
        twice, has the whole table written once instead, beside itself, and
        switched to (see ``overwrite``).
        """
        if not periods:
            return
        if not self.exists(name):
            self.overwrite(name, new)
            return
        whole = self._mostly_touched(name, cells)
        held = self.read(name) if whole else self.read(name, periods, cells)
        keep = anti_join_keys(held, new, [PERIOD, BUCKET, key], rows)
        merged = keep.unionByName(new.select(*keep.columns))
        if whole:
            self._refresh(name, merged)
            return
        copy = self.scratch(f"upsert-{name}")
        merged.select(*self.read_schema(name).fieldNames()).write.parquet(copy)
        self.write_state("_pending_copy", [(copy, name, False)])
        self.recover()

    def _mostly_touched(self, name: str, cells: DataFrame) -> bool:
        """Whether ``cells`` hold more than half of the table's rows; counted
        from the files' footers."""
        touched = cells.select(PERIOD, BUCKET, F.lit(1).alias("touched"))
        counts = self.read(name).groupBy(PERIOD, BUCKET).count().join(touched, [PERIOD, BUCKET], "left")
        n = counts.agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("touched")).alias("touched")).first()
        return 2 * (n["touched"] or 0) > (n["all"] or 0)

    def recover(self) -> None:
        """Replay a recorded upsert copy, if one is complete, and forget it."""
        for copy, name, ordered in self.read_state("_pending_copy") or []:
            if path_exists(self.spark, f"{copy}/_SUCCESS"):
                schema = self.read_schema(name)
                if ordered:
                    schema = schemas.with_field(schema, ORDER, T.LongType())
                self.replace_periods(name, self.spark.read.schema(schema).parquet(copy))
            self.write_state("_pending_copy", [])
            self.drop_scratch(copy)

    def recluster(self, name: str, by: tuple[str, ...] = ("pickup_datetime", "pulocation_id"),
                  periods: list | None = None, bits: int = 12) -> None:
        """Lay out a trip table so that filters on any of ``by`` skip row groups.

        Rows of a (period, bucket) cell are ordered by the interleaved bits of
        their places in the columns ``by`` (numbers, or wall-clock times, which
        count from their period's start): each row group, and each file of a
        cell cut into several, then spans a short range of every column, not
        of the first one only. The rows stay the same, NULLs included.

        Without ``periods`` the table is built beside itself and switched to;
        with them, only their cells are rewritten, from a recorded copy, as in
        an upsert. Later upserts and appends write their cells by time again,
        so this is run for the periods a load has touched.
        """
        if not TABLES[name].partitioned:
            raise ValueError(f"{name} has no cells to order")
        if periods is not None and not periods:
            return
        rows = self.read(name, periods)
        kinds = dict(rows.dtypes)

        def number(c: str):
            if kinds[c] != "timestamp_ntz":
                return F.col(c)
            days = F.date_diff(F.col(c).cast("date"), F.col(PERIOD))
            return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

        # One row: the span of each column.
        span = rows.agg(*[f(number(c)).alias(f"{c}{k}") for c in by for k, f in enumerate((F.min, F.max))]).first()
        places = [place(number(c), F.lit(span[f"{c}0"]), F.lit(span[f"{c}1"]), bits) for c in by]
        ordered = rows.withColumn(ORDER, interleave(places, bits))
        if periods is None:
            self._refresh(name, ordered)
            return
        copy = self.scratch(f"recluster-{name}")
        ordered.select(*self.read_schema(name).fieldNames(), ORDER).write.parquet(copy)
        self.write_state("_pending_copy", [(copy, name, True)])
        self.recover()

    def register_views(self) -> list[str]:
        """Expose every built table as a temp view ``<layer>_<name>`` and ``<name>``
        so the marts can be queried with ``spark.sql``."""
        names = []
        for name, spec in TABLES.items():
            if name.startswith("_") or not self.exists(name):
                continue
            df = self.logical(name)
            for view in (name, f"{spec.layer.lower()}_{name}"):
                df.createOrReplaceTempView(view)
                names.append(view)
        return names

    # -- run state ------------------------------------------------------------
    def pending_periods(self) -> list:
        return sorted(r[0] for r in self.read_state("_pending_periods") or [])

    def high_water_mark(self):
        """Staging's high-water mark (epoch micros, ``None`` if empty).

        Read from the state table written after each staging write; a
        missing state falls back to ``max(ingestion_ts)`` over staging. The
        state never runs ahead of staging (it is written after the commit),
        so a stale value only re-stages rows the upsert replaces with
        themselves.
        """
        from tripmart.operators.staging import high_water_mark
        rows = self.read_state("_high_water_mark")
        if rows is not None:
            return rows[0][0] if rows else None
        return high_water_mark(self.read("stg_trips"))

    def set_high_water_mark(self, micros, previous=None) -> None:
        if previous is None:
            rows = self.read_state("_high_water_mark")
            previous = rows[0][0] if rows else None
        marks = [m for m in (micros, previous) if m is not None]
        self.write_state("_high_water_mark", [(max(marks),)] if marks else [])

    def set_pending_periods(self, periods) -> None:
        self.write_state("_pending_periods", [(p,) for p in sorted(set(periods))])
