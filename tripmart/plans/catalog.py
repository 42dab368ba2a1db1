"""Layers as databases of the session's catalog.

Each layer is a database and each built table an external Parquet table in
it, so that ``SELECT ... FROM MARTS.BI_DAILY_METRICS`` works as in a
warehouse. The catalog is the session's own (in memory unless the cluster
has another); it holds names, schemas and partitions, and the files stay
where :class:`Warehouse` wrote them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripmart.plans.warehouse import BUCKET, PERIOD, TABLES, Warehouse


def qualified(name: str) -> str:
    """Database and table of a model: ``fact_trips`` is ``MARTS.fact_trips``."""
    return f"{TABLES[name].layer}.{name}"


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(wh: Warehouse, name: str) -> str:
    """(Re)register one built table at its present folder and find its partitions."""
    spark, spec, table = wh.spark, TABLES[name], qualified(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {spec.layer} LOCATION {_quoted(f'{wh.root}/{spec.layer}')}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wh.read_schema(name).fields)
    by = f"PARTITIONED BY ({PERIOD}, {BUCKET})" if spec.partitioned else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION {_quoted(wh.path(name))}")
    if spec.partitioned:
        spark.catalog.recoverPartitions(table)
    return table


def register_databases(wh: Warehouse) -> list[str]:
    """Register every table that is built; returns their qualified names.

    Call it again after a run: partitions are found anew, and a table that a
    full refresh has switched to another folder follows. A table of another
    warehouse under the same name is replaced by this one's.
    """
    return [register_table(wh, name) for name in TABLES if wh.exists(name)]


def is_built(spark: SparkSession, name: str) -> bool:
    """Whether a model's table is registered."""
    return spark.catalog.tableExists(qualified(name))
