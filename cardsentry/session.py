"""Session helpers: building a session for local runs, the shared folder and
the intermediates written there.

No join carries a broadcast hint on data that grows: the sides are stored
tables or intermediates, so Spark knows their bytes and broadcasts below
``spark.sql.autoBroadcastJoinThreshold``; beyond it the join is a sort-merge
join that AQE splits where a key is hot."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folder of the intermediates inside the shared folder.
SCRATCH = "cardsentry"
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "cardsentry") -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session (tests, bench) may leave it unset and gets a private
    folder under the system temp dir; on a cluster that folder would be local
    to one machine, so an unset setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    # Unset: the context may still have one (setCheckpointDir); else make a
    # private one.  (The conf itself cannot be changed on a running session.)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cardsentry-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder inside the shared folder."""
    return f"{shared_dir(spark)}/{SCRATCH}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into a fresh folder of the shared folder
    and read it back: cuts the lineage with a single computation (an eager
    ``checkpoint()`` without a cache computes the plan twice), survives lost
    executors, and gives the planner real file-size statistics."""
    path = scratch_path(df.sparkSession, name)
    if (owned := _scope.get()) is not None:
        owned.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediates of :func:`materialize` inside it at its end.
    For jobs that have stored their results by then."""
    token = _scope.set([])
    try:
        yield
    finally:
        owned = _scope.get()
        _scope.reset(token)
        for path in owned:
            delete_path(spark, path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path in any store Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder below the shared folder.  Call it when no
    DataFrame that reads from them is needed any more."""
    delete_path(spark, f"{shared_dir(spark)}/{SCRATCH}")
