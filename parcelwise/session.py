"""Session helpers: the shared scratch folder, local relations and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app_name: str = "parcelwise",
                  checkpoint_dir: str | None = None, driver_memory: str = "4g") -> SparkSession:
    """Session for tests, the bench and the examples.

    AQE (coalesce + skew join + rebalance splitting) is on; the UI stays off.
    ``checkpoint_dir`` is the folder that driver and executors share.  On a cluster, get the
    session from the platform instead and keep its ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder if checkpoint_dir is None else SparkSession.builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = (builder.master(master).appName(app_name)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             # Delete reliable checkpoint files once their RDDs are garbage-collected.
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.driver.memory", driver_memory)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Used for checkpoints and for scratch tables.  The setting is read from
    the session; only a session whose tasks run in the driver's own process
    gets a fresh temp folder without one.  Elsewhere its absence is an error: a
    machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="parcelwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the shared folder."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}parcelwise-{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for local tests that inspect files)."""
    return path[len("file:"):] if path.startswith("file:") else path


def local_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Rows the driver owns (specs, selections, manifests: one per table or partition) as a local relation.

    Spark knows its size, so joins with it are broadcast or evaluated without a job; nothing is recomputed.
    """
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in schema]
    kinds = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds), schema)


def checkpointed(df: DataFrame) -> DataFrame:
    """A frame whose size follows the data, written as a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by ``scratch_path``, whatever file system holds it."""
    if "/parcelwise-" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
