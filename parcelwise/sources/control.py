"""Control inputs: partition specs, selections, table lists, catalogs, edges.

Control frames are small metadata, but they are still DataFrames so the
operators that consume them compose into one Spark plan.  JSON text is
read with an explicit all-STRING schema (no inference), so a
``first_date`` of ``"20200101"`` stays text and ``number_of_intervals`` has
one type whatever its neighbours hold.  Input that cannot be read, lacks a
required field or names nothing raises ``ValueError``: a typo must never widen
what a run touches.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame

SPEC_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("first_date", T.StringType()),
    T.StructField("partition_by", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("refresh_from", T.StringType()),
    T.StructField("number_of_intervals", T.StringType()),
])
COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
])
RANGES_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("partition_name", T.StringType()),
    T.StructField("range_start", T.DateType()),
    T.StructField("range_end", T.DateType()),
])
#: a partition as the manifest keeps it: its range, the column its rows are dated by, and statistics of them
MANIFEST_SCHEMA = T.StructType([*RANGES_SCHEMA.fields, T.StructField("date_col", T.StringType()), T.StructField("n_rows", T.LongType()),
                                T.StructField("min_date", T.DateType()), T.StructField("max_date", T.DateType()),
                                T.StructField("n_bytes", T.LongType())])
EDGES_SCHEMA = T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("dst", T.StringType()),
])
TABLES_SCHEMA = T.StructType([T.StructField("table_name", T.StringType())])

# A selection may carry its partition names as CSV text or as a JSON array.
SELECTION_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("selected_partitions", T.StringType()),
])


def _is_blank(text) -> bool:
    return text is None or (isinstance(text, str) and not text.strip())


# The fields every record must hold.
SPEC_REQUIRED = ("table", "first_date", "partition_by", "interval")
SELECTION_REQUIRED = ("table", "selected_partitions")


def _records(given, required: tuple, what: str) -> list[dict]:
    """Records from JSON text or a list of mappings; raises for text that is no JSON, a missing or a blank field."""
    if isinstance(given, str):
        try:
            given = json.loads(given)
        except ValueError as exc:
            raise ValueError(f"{what} is not valid JSON: {exc}") from exc
    given = [given] if isinstance(given, Mapping) else given
    if not isinstance(given, (list, tuple)) or not all(isinstance(r, Mapping) for r in given):
        raise ValueError(f"{what} must be a list of records")
    bad = [f"record {i}: {name!r} is missing or blank" for i, r in enumerate(given) for name in required
           if _is_blank(r.get(name)) or r.get(name) == []]
    if bad:
        raise ValueError(f"{what}: {len(bad)} problems: {bad}")
    return [dict(r) for r in given]


def _text(value) -> str | None:
    return None if value is None else str(value)


def read_spec(spark: SparkSession, spec) -> DataFrame:
    """Spec frame from JSON text, a list of dicts, a path to JSON lines, or a DataFrame.

    Missing optional fields (``refresh_from``, ``number_of_intervals``) come
    back as NULL.  Values are kept as text; operators parse them once.  Text that is
    not valid JSON and records without a required field raise ``ValueError``.
    """
    if isinstance(spec, DataFrame):
        missing = [f.name for f in SPEC_SCHEMA if f.name not in spec.columns]
        for name in missing:
            if name in SPEC_REQUIRED:
                raise ValueError(f"partition spec: column {name!r} is missing")
            spec = spec.withColumn(name, F.lit(None).cast("string"))
        return spec.select(*[F.col(f.name).cast("string") for f in SPEC_SCHEMA])
    if _is_blank(spec):
        return local_frame(spark, [], SPEC_SCHEMA)
    if isinstance(spec, str) and "\n" not in spec.strip() and spec.strip().endswith(".json"):
        spec = [r.asDict() for r in spark.read.schema(SPEC_SCHEMA).option("mode", "FAILFAST").json(spec.strip()).collect()]
    rows = _records(spec, SPEC_REQUIRED, "partition spec")
    return local_frame(spark, [tuple(_text(r.get(k)) for k in SPEC_SCHEMA.names) for r in rows], SPEC_SCHEMA)


def _file_records(spark: SparkSession, path: str, what: str) -> list:
    """Records of a small JSON file: one JSON text, or a record per line."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    lines = [x for x in text.splitlines() if x.strip()]
    try:
        found = json.loads(text) if text.lstrip().startswith("[") else [json.loads(x) for x in lines]
    except ValueError as exc:
        raise ValueError(f"{what}: {path} is not valid JSON: {exc}") from exc
    if not found:
        raise ValueError(f"{what}: {path} holds no record")
    return found


def read_selection(spark: SparkSession, selection) -> DataFrame | None:
    """Selection frame ``(table, selected_partitions)`` from JSON text, records, a path to a JSON file or a frame; None when blank.

    A file holds one JSON text (an array of records) or a record per line.  ``selected_partitions`` may be CSV text or a JSON array of names; both
    come back as text and :func:`explode_selection` handles either.  A selection that is
    given but is no JSON, misses a field or names no partition raises ``ValueError``.
    """
    if isinstance(selection, DataFrame):
        return selection
    if _is_blank(selection):
        return None
    if isinstance(selection, str) and "\n" not in selection.strip() and selection.strip().endswith(".json"):
        selection = _file_records(spark, selection.strip(), "partitions to refresh")
    rows = []
    for r in _records(selection, SELECTION_REQUIRED, "partitions to refresh"):
        names = r["selected_partitions"]
        names = names if isinstance(names, (list, tuple)) else str(names).split(",")
        names = [str(n).strip() for n in names if not _is_blank(n)]
        if not names:
            raise ValueError(f"partitions to refresh: no partition is named for table {r['table']!r}")
        rows.append((str(r["table"]).strip(), ",".join(names)))
    if not rows:
        raise ValueError("partitions to refresh: the selection names no table")
    return local_frame(spark, rows, SELECTION_SCHEMA)


def table_list(spark: SparkSession, tables) -> DataFrame | None:
    """``(table_name)`` frame from CSV text, a list or a DataFrame; None when blank.

    Blank items are dropped (``"a,,b"`` is ``a, b``) and names are trimmed; text or a list that is
    given but holds no name raises ``ValueError``.
    """
    if isinstance(tables, DataFrame):
        return tables.select(F.col(tables.columns[0]).alias("table_name"))
    names = list_names(tables)
    return None if names is None else local_frame(spark, [(n,) for n in names], TABLES_SCHEMA)


def list_names(tables) -> list[str] | None:
    """The names of a CSV text or list (see ``table_list``)."""
    if _is_blank(tables):
        return None
    given = tables.split(",") if isinstance(tables, str) else list(tables)
    names = [str(t).strip() for t in given if not _is_blank(t)]
    if not names:
        raise ValueError(f"the table list names no table: {tables!r}")
    return list(dict.fromkeys(names))


def columns_catalog(spark: SparkSession, tables: Mapping[str, DataFrame] | Iterable[str]) -> DataFrame:
    """``(table_name, column_name)`` for the given tables.

    ``tables`` is either a mapping name -> DataFrame (columns read from the
    schema, no data scanned) or names of tables in the session catalog.
    """
    rows = []
    if isinstance(tables, Mapping):
        for name, df in tables.items():
            rows.extend((name, c) for c in df.columns)
    else:
        for name in tables:
            rows.extend((name, c.name) for c in spark.catalog.listColumns(name))
    return local_frame(spark, rows, COLUMNS_SCHEMA)


def edges_frame(spark: SparkSession, edges) -> DataFrame:
    """``(src, dst)`` edges from pairs, a mapping src -> [dst...] or a DataFrame."""
    if isinstance(edges, DataFrame):
        return edges.select(F.col("src").cast("string"), F.col("dst").cast("string"))
    if isinstance(edges, Mapping):
        pairs = [(s, d) for s, ds in edges.items() for d in ds]
    else:
        pairs = [tuple(p) for p in edges]
    return local_frame(spark, pairs, EDGES_SCHEMA)
