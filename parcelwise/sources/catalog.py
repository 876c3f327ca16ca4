"""Partitions of session-catalog tables: ``SHOW PARTITIONS`` as a source, ``ALTER TABLE`` and overwrites as sinks.

A table is partitioned by one column that holds the partition's name, ``<table>_<yyyyMMdd>_<yyyyMMdd>`` or the table's own
name for the catch-all partition.  The catalog keeps no more than the names, so ranges are read from them.

Writers of one table take turns (``table_lock``): two overwrites of one table at a time would remove each other's
staged files.
"""

from __future__ import annotations

import contextlib
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import python_date
from ..session import local_frame
from .storage import PARTITION_COLUMN, Partition

CATALOG_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("partition_name", T.StringType())])
_RANGE = re.compile(r"(.*)_(\d{8})_(\d{8})", re.DOTALL)
_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)


def table_lock(name: str) -> threading.RLock:
    """The lock of a catalog table's writers in this driver."""
    return _locks[name.lower()]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def range_of(table: str, name: str) -> Partition:
    """A partition by its name: with the range the name carries, or none."""
    found = _RANGE.fullmatch(name)
    if found and found[1] == table:
        try:
            return Partition(table, name, python_date(found[2]), python_date(found[3]))
        except ValueError:
            pass
    return Partition(table, name)


def partition_column(spark: SparkSession, name: str) -> str:
    """The one column a catalog table is partitioned by."""
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if len(columns) != 1:
        raise ValueError(f"{name!r} must be partitioned by one column, not by {columns}")
    return columns[0]


def partition_names(spark: SparkSession, name: str) -> list[str]:
    """Names of a catalog table's partitions; Spark reports them escaped, as ``column=name``."""
    column = partition_column(spark, name)
    return [unquote(r[0][len(column) + 1:]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def catalog_partitions(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """(table_name, partition_name) of the named catalog tables, as the refresh operators take them."""
    return local_frame(spark, [(t.split(".")[-1].strip("`"), n) for t in tables for n in partition_names(spark, t)], CATALOG_SCHEMA)


def create_table(spark: SparkSession, name: str, rows: DataFrame, location: str | None = None) -> None:
    """An empty Parquet table with the columns of ``rows``, partitioned by name, unless there is one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != PARTITION_COLUMN)
    at = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PARTITION_COLUMN} STRING) USING parquet PARTITIONED BY ({PARTITION_COLUMN}){at}")


@contextlib.contextmanager
def writing(source: DataFrame):
    """``source`` as a frame of a session of its own, with the caller's settings and dynamic overwrites.

    Whether an overwrite of a catalog table replaces the whole table or only the partitions it has rows of is a setting of the
    session, so it must not be changed where other threads write.
    """
    spark = source.sparkSession
    own, view = spark.newSession(), f"parcelwise_{uuid.uuid4().hex}"
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    source.createGlobalTempView(view)
    try:
        yield own.table(f"{own.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def overwrite(rows: DataFrame, name: str) -> None:
    """Replace the partitions that ``rows`` (with ``partition_name``) have rows of; Spark records new ones in the catalog.

    ``rows`` must come from a session that overwrites dynamically (``writing``): any other would empty the table.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise ValueError("the rows' session does not overwrite partitions dynamically")
    column = partition_column(spark, name)
    order = [F.col(PARTITION_COLUMN if c == column else f"`{c}`") for c in spark.table(name).columns]
    rows.select(*order).write.insertInto(name, overwrite=True)


def add_partitions(spark: SparkSession, name: str, names: list[str], at_once: int = 500) -> None:
    """Record partitions that need no rows to exist."""
    column = partition_column(spark, name)
    for i in range(0, len(names), at_once):
        specs = " ".join(f"PARTITION (`{column}` = {_quoted(n)})" for n in names[i:i + at_once])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def clear_partition(spark: SparkSession, name: str, partition: str) -> None:
    """Remove a partition's rows; it still exists.  A static overwrite, as a drop leaves the files of an external table."""
    column = partition_column(spark, name)
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in spark.table(name).schema if f.name != column)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{column}` = {_quoted(partition)}) SELECT {columns} FROM range(0)")


def drop_partitions(spark: SparkSession, name: str, names: list[str]) -> None:
    """Remove partitions with their rows."""
    column = partition_column(spark, name)
    for n in names:
        clear_partition(spark, name, n)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = {_quoted(n)})")
