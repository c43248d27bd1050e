"""Catalogue tables that are bucketed and partitioned, and replaced safely.

A table ``name`` is a view over its current version, a bucketed and partitioned
parquet table of its own (``name_v_<hex>``) under ``location``.  A replacement
writes the next version completely and then points the view at it, one change
in the catalogue: readers see the old rows or the new ones, and a write that
fails leaves the old version as it was.  Spark inlines the view, so buckets and
partitions of the version below serve joins and pruning.

Two tables bucketed by the join key into the same number of buckets are joined,
and aggregated by that key, without an exchange.  Rows are dealt out by bucket
before they are written, so a bucket is one file a partition and not one a
task.  All rows of a key are one bucket: bucket by keys of few rows each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _file_system, source_version

BUCKETS = 64  # of a table, unless the caller says more
BUCKET_BYTES = 256 << 20  # source bytes for a bucket, as much as suits a task


def bucket_count(spark: SparkSession, paths: Sequence[str], bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """Buckets for tables made of these files or folders: a power of two, so that tables of unlike sizes still match."""
    total = sum(source_version(spark, p)[1] for p in paths)
    return max(least, 1 << max(-(-total // bucket_bytes) - 1, 0).bit_length())


def _version(spark: SparkSession, name: str) -> str | None:
    """The table that the view ``name`` shows, or None if there is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    version = {r["key"]: r["value"] for r in rows}.get("riskloom.version")
    if version is None:
        raise ValueError(f"{name} is not a table of this module")
    return version


def _drop(spark: SparkSession, version: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def _path(spark: SparkSession, version: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def replace_table(df: DataFrame, name: str, location: str, bucket_by: str, buckets: int = BUCKETS,
                  partition_by: Sequence[str] = (), keep_old: bool = False) -> DataFrame:
    """Make ``name`` hold exactly the rows of ``df`` and return it.

    ``df`` may read ``name`` itself.  The old version is removed after the
    change, unless ``keep_old`` (for readers that are still on it).
    """
    spark = df.sparkSession
    old = _version(spark, name)
    version = f"{name}_v_{uuid.uuid4().hex[:12]}"
    path = f"{location.rstrip('/')}/{version}"
    writer = (df.repartition(buckets, F.col(bucket_by)).write.format("parquet").option("path", path)
              .bucketBy(buckets, bucket_by).sortBy(bucket_by))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        _drop(spark, version, path)
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('riskloom.version' = '{version}') "
              f"AS SELECT * FROM {version}")
    if old is not None and not keep_old:
        _drop(spark, old, _path(spark, old))
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str) -> DataFrame:
    """Replace the partitions that ``df`` has rows of; all others keep their files.

    Spark stages the new files and moves them when every task has ended, so a
    job that fails replaces nothing; a reader in the moment of the moves may see
    some partitions new and some old (``replace_table`` has no such moment).
    ``df`` may not read ``name``: write what it needs first.
    """
    spark = df.sparkSession
    version = _version(spark, name)
    if version is None:
        raise ValueError(f"there is no table {name}")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {version}").collect()}
    key = F.col(about["Bucket Columns"].strip("[]`"))
    rows = df.select(*spark.table(version).columns).repartition(int(about["Num Buckets"]), key)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(version, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(version)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove the table and its files; nothing happens if it does not exist."""
    version = _version(spark, name)
    if version is not None:
        spark.sql(f"DROP VIEW {name}")
        _drop(spark, version, _path(spark, version))


__all__ = ["BUCKETS", "BUCKET_BYTES", "bucket_count", "drop_table", "replace_partitions", "replace_table"]
