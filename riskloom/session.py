"""Spark session and shared-storage helpers.

All operators take an existing ``SparkSession``; this module only offers a
builder with settings that suit the library (AQE on, UTC, no UI) and the
checkpoint folder used to cut lineage in iterative jobs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riskloom", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder would not
    survive the loss of an executor, so we refuse to invent one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/...)")
    path = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for sink round trips."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + f"/riskloom-out/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Used once per pipeline for the derived loan table, which every fit action
    re-reads: later passes scan a columnar copy (pruned to the columns they
    need) instead of recomputing the joins over the source tables, and the
    copy survives executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_shared: dict[tuple, str] = {}  # tables written by ``materialize_once``


def _file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system: local, HDFS or an object store alike."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def source_version(spark: SparkSession, path: str) -> tuple:
    """Path, bytes, files and last change of a file or folder.

    A Spark write into a folder changes the folder's time of change, as it
    makes and removes its working folder there.
    """
    p, fs = _file_system(spark, path)
    s = fs.getContentSummary(p)
    return path, s.getLength(), s.getFileCount(), fs.getFileStatus(p).getModificationTime()


def materialize_once(spark: SparkSession, name: str, sources: Sequence[str],
                     build: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` that an application does once per version of its sources.

    ``sources`` are all files or folders that ``build`` reads.  A changed
    source, another application or a removed table makes a new table.
    """
    key = (spark.sparkContext.applicationId, ensure_checkpoint_dir(spark), name,
           *[source_version(spark, s) for s in sources])
    path = _shared.get(key)
    if path is not None:
        p, fs = _file_system(spark, path + "/_SUCCESS")
        if fs.exists(p):
            return spark.read.parquet(path)
    path = scratch_path(spark, name)
    build().write.parquet(path)
    _shared[key] = path
    return spark.read.parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Remove every table that this session wrote in the shared folder.

    For the end of a job: frames that read such tables fail afterwards.
    """
    p, fs = _file_system(spark, ensure_checkpoint_dir(spark).rstrip("/") + "/riskloom-out")
    fs.delete(p, True)
    _shared.clear()


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so pandas/duckdb helpers in tests can read it."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "cut_lineage",
           "materialize", "materialize_once", "release_scratch", "source_version", "local_path", "DEFAULT_CONF"]
