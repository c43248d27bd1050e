"""File sources and sinks: delimited text, partitioned parquet, nested JSON.

Paths are whatever the caller gives; the registered queries write under the
shared checkpoint folder (``session.scratch_path``), never a machine-local
temporary folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> str:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ";", header: bool = True) -> DataFrame:
    """Delimited scan; pass a schema in production (inference costs a full pass)."""
    r = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def read_dictionary(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Variable dictionary (feature, description): names trimmed, empty ones left out, the least text of repeated ones."""
    raw = read_csv(spark, path, "feature string, description string", sep)
    named = raw.select(F.trim("feature").alias("feature"), "description").where("feature <> ''")
    return named.groupBy("feature").agg(F.min("description").alias("description"))


def describe(table: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``table`` (one row or more a feature) with descriptions; NULL where the dictionary has none."""
    return table.join(dictionary.select("feature", "description"), "feature", "left")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a parquet table (the DROP + CREATE TABLE AS of the warehouse)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
