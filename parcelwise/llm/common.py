"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

EQUAL_ROWS = 10_000   # equal rows that lie in one place


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast a value whose classes the executors need not have installed; read it with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def row_key(doc_id: Column, *columns: Column) -> list[Column]:
    """k1, k2: two non-null columns that identify a row by its id and the given columns, nulls included."""
    nulls = [c.isNull() for c in (doc_id, *columns)]
    return [F.coalesce(doc_id.cast("long"), F.lit(-1)).alias("k1"), F.xxhash64(*nulls, *columns).alias("k2")]


def text_key(docs: DataFrame) -> list[Column]:
    """The key of a row by doc_id and text."""
    return row_key(F.col("doc_id"), F.col("text"))


def whole_row_key(docs: DataFrame) -> list[Column]:
    """The key of a row by all its columns (maps as JSON): rows with equal keys are the same row."""
    return row_key(F.col("doc_id"), *[F.to_json(F.struct(docs[f.name]), {"ignoreNullFields": "false"}) if "map<" in f.dataType.simpleString()
                                      else docs[f.name] for f in docs.schema])


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names as given, with underscores put before those that ``docs`` has."""
    out = []
    for name in names:
        while name.lower() in {c.lower() for c in docs.columns}:
            name = f"_{name}"
        out.append(name)
    return out


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(k1, k2, rows) of the keys that more than ``EQUAL_ROWS`` of ``rows`` (k1, k2) have."""
    return materialize(rows.groupBy("k1", "k2").agg(F.count("*").alias("rows")).where(F.col("rows") > EQUAL_ROWS), "repeated")


def split_repeats(docs: DataFrame, key: list[Column], many: DataFrame, names: list[str], keys: DataFrame | None = None):
    """``docs`` in two: the rows whose key is not in ``many`` (k1, k2, rows), and the others, dealt out anew.

    ``names`` are those of the key's two columns, of a row's number from 0 among its equals and of their number; the latter two only the second
    part has.  It is None where ``many`` has no rows.  Rows with equal keys must be equal: those of ``many`` become one row
    with a count, partly so before the shuffle, and then ``rows`` rows again, ``EQUAL_ROWS`` of them in a place, so a
    row that a third of a table repeats fills no task.  ``keys`` (with the key's two columns under their names) is joined to both.
    """
    k1, k2, i, n = names
    keyed = docs.withColumns({k1: key[0], k2: key[1]})
    joined = lambda df: df if keys is None else df.join(keys, [k1, k2])
    if many.isEmpty():
        return joined(keyed), None
    many = many.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("rows").alias(n))
    (row, place) = free_names(keyed.withColumn(n, F.lit(0)).withColumn(i, F.lit(0)), "row", "place")
    one = joined(keyed.join(many, [k1, k2]).groupBy(k1, k2).agg(F.first(F.struct(*docs.columns)).alias(row), F.first(n).alias(n)))
    others = [c for c in one.columns if c != row]
    places = one.withColumn(place, F.explode(F.expr(f"sequence(0L, (`{n}` - 1) div {EQUAL_ROWS})")))
    dealt = places.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), k1, k2, place)
    last = F.least((F.col(place) + 1) * EQUAL_ROWS, F.col(n)) - 1
    hot = dealt.withColumn(i, F.explode(F.sequence(F.col(place) * EQUAL_ROWS, last)))
    return joined(keyed.join(many, [k1, k2], "left_anti")), hot.select(f"{row}.*", *others, i)


def keep_rows(docs: DataFrame, keys: DataFrame, times: str, key: list[Column], many: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``keys`` (k1, k2, ``times``): ``times`` rows of each key, shared out evenly over its equal rows.

    ``times`` null keeps every row of the key as it is.  ``keys`` has one row per key; ``key`` tells all rows apart that are not
    equal, and ``many`` are the ``repeated_keys`` of ``docs``.
    """
    k1, k2, i, n, wanted = free_names(docs, "k1", "k2", "i", "rows", "times")
    keys = keys.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col(times).cast("long").alias(wanted))
    rest, hot = split_repeats(docs, key, many, [k1, k2, i, n], keys)
    same = Window.partitionBy(k1, k2)
    marked = rest.withColumns({i: F.row_number().over(same.orderBy(k1)) - 1, n: F.count("*").over(same)})
    if hot is not None:
        marked = marked.unionByName(hot)
    share = F.expr(f"`{wanted}` div `{n}`") + (F.col(i) < F.col(wanted) % F.col(n)).cast("long")
    copies = F.coalesce(share, F.lit(1)).cast("int")
    return marked.withColumn(wanted, F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)
