"""Table scans and the ``loan`` stand-in view built from the star-schema tables.

One loan per order: the order total is the amount, the customer balance the
"income", line items give counts, averages and returns, and a deterministic
target depends on the features (see FIXTURES.md section 4).  The view is
written with the DataFrame API so Catalyst prunes columns at the parquet scan
and AQE picks the join strategy from runtime sizes (no forced broadcast: the
customer table grows with the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import dbl, nearest_whole


LOAN_TABLES = ("orders", "customer", "lineitem")  # what ``loan_view`` reads


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def line_summary(lineitem: DataFrame) -> DataFrame:
    """Per-order line statistics; averages from integer sums for exact parity."""
    n = F.count(F.lit(1))
    return lineitem.groupBy("l_orderkey").agg(
        n.cast("bigint").alias("n_lines"),
        (F.floor(F.sum(F.col("l_quantity").cast("bigint")).cast("double") * dbl(10000) / n)
         / dbl(10000)).alias("avg_qty"),
        F.max("l_discount").alias("max_disc"),
        (F.floor(F.sum(nearest_whole(F.col("l_tax") * dbl(100))).cast("double")
                 * dbl(100) / n) / dbl(10000)).alias("avg_tax"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("bigint")
        .alias("n_returns"),
    )


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``loan`` table: loan_id, vintage, features and target ``y``."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment")
    li = line_summary(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"))

    # orders x lines first: both sides are keyed by order key, so the
    # aggregate's shuffle partitioning is reused by the join.
    b = (orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
         .join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
         .select(
             F.col("o_orderkey").alias("loan_id"),
             F.concat(F.year("o_orderdate").cast("string"),
                      F.when(F.month("o_orderdate") <= 6, "H1").otherwise("H2"))
             .alias("vintage"),
             F.col("o_totalprice").alias("loan_amount"),
             F.when(F.col("c_acctbal") < -800, F.lit(None).cast("double"))
             .otherwise(F.col("c_acctbal")).alias("acctbal"),
             F.col("c_mktsegment").alias("segment"),
             F.col("o_orderpriority").alias("priority"),
             "n_lines", "avg_qty", "max_disc", "avg_tax",
             F.coalesce(F.col("n_returns"), F.lit(0).cast("bigint")).alias("n_returns"),
             (((F.col("o_orderkey") * 7919 + 104729) % 10007).cast("double") / dbl(10007))
             .alias("u"),
         ))
    lg = (dbl(-3.2) + dbl(0.55) * F.col("n_returns")
          + dbl(6) * F.coalesce(F.col("max_disc"), dbl(0.05))
          - dbl(0.00015) * F.coalesce(F.col("acctbal"), dbl(0))
          + dbl(0.000002) * F.col("loan_amount")
          + F.when(F.col("priority") == "1-URGENT", dbl(0.5))
          .when(F.col("priority") == "5-LOW", dbl(-0.4)).otherwise(dbl(0))
          + F.when(F.col("vintage") >= "2000H1", dbl(0.3)).otherwise(dbl(0)))
    return b.select(
        "loan_id", "vintage", "loan_amount", "acctbal", "segment", "priority", "n_lines",
        "avg_qty", "max_disc", "avg_tax", "n_returns",
        F.when(F.col("u") < dbl(1) / (dbl(1) + F.exp(-lg)), 1).otherwise(0).alias("y"))


# The same view as SQL text (runs unchanged in Spark SQL and DuckDB); the
# oracles in ``plans.oracle`` are built on it.
LOAN_SQL = """
WITH li AS (
  SELECT l_orderkey,
         CAST(count(*) AS bigint) AS n_lines,
         floor(CAST(sum(CAST(l_quantity AS bigint)) AS double) * 10000 / count(*)) / CAST(10000 AS double) AS avg_qty,
         max(l_discount) AS max_disc,
         floor(CAST(sum(CAST(round(l_tax * 100) AS bigint)) AS double) * 100 / count(*)) / CAST(10000 AS double) AS avg_tax,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS bigint) AS n_returns
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey AS loan_id,
         concat(CAST(year(o_orderdate) AS varchar(4)),
                CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END) AS vintage,
         o_totalprice AS loan_amount,
         CASE WHEN c_acctbal < -800 THEN NULL ELSE c_acctbal END AS acctbal,
         c_mktsegment AS segment, o_orderpriority AS priority,
         li.n_lines, li.avg_qty, li.max_disc, li.avg_tax,
         coalesce(li.n_returns, 0) AS n_returns,
         CAST((o.o_orderkey * 7919 + 104729) % 10007 AS double) / CAST(10007 AS double) AS u
  FROM orders o JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
z AS (
  SELECT *, CAST(-3.2 AS double) + CAST(0.55 AS double) * n_returns
         + CAST(6 AS double) * coalesce(max_disc, CAST(0.05 AS double))
         - CAST(0.00015 AS double) * coalesce(acctbal, CAST(0 AS double))
         + CAST(0.000002 AS double) * loan_amount
         + CASE WHEN priority = '1-URGENT' THEN CAST(0.5 AS double)
                WHEN priority = '5-LOW' THEN CAST(-0.4 AS double) ELSE CAST(0 AS double) END
         + CASE WHEN vintage >= '2000H1' THEN CAST(0.3 AS double) ELSE CAST(0 AS double) END AS lg
  FROM b)
SELECT loan_id, vintage, loan_amount, acctbal, segment, priority, n_lines, avg_qty, max_disc,
       avg_tax, n_returns,
       CASE WHEN u < CAST(1 AS double) / (CAST(1 AS double) + exp(-lg)) THEN 1 ELSE 0 END AS y
FROM z
"""
