"""Catalogue tables: replacement, partitions, joins without an exchange, failed writes."""

import glob

import pytest
from pyspark.sql import functions as F

from riskloom.sources import catalogue as C


@pytest.fixture
def loans(spark, tmp_path):
    df = spark.range(500).select("id", (F.col("id") % 5).cast("string").alias("part"), (F.col("id") * 2).alias("v"))
    yield C.replace_table(df, "cat_loans", str(tmp_path), "id", 4, ["part"]), str(tmp_path)
    C.drop_table(spark, "cat_loans")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _total(spark):
    return spark.table("cat_loans").agg(F.count("*"), F.sum("v")).first()[:]


def test_rows_and_one_file_a_bucket_and_partition(spark, loans):
    table, path = loans
    assert _total(spark) == (500, 249500)
    assert sorted(table.columns) == ["id", "part", "v"]
    assert len(glob.glob(f"{path}/*/part=*/*.parquet")) <= 4 * 5


def test_join_and_aggregate_by_the_bucket_key_need_no_exchange(spark, loans):
    _, path = loans
    lines = spark.range(2000).select((F.col("id") % 500).alias("id"), F.lit(1).alias("x"))
    C.replace_table(lines, "cat_lines", path, "id", 4)
    try:
        sums = spark.table("cat_lines").groupBy("id").agg(F.sum("x").alias("n"))
        both = spark.table("cat_loans").hint("merge").join(sums, "id")
        assert "Exchange" not in _plan(both)
        assert both.agg(F.count("*"), F.sum("n")).first()[:] == (500, 2000)
    finally:
        C.drop_table(spark, "cat_lines")


def test_partitions_are_pruned(spark, loans):
    one = spark.table("cat_loans").where("part = '3'")
    assert "PartitionFilters: [isnotnull(part" in _plan(one)
    assert len(one.inputFiles()) <= 4 and one.count() == 100


def test_replacement_may_read_the_table(spark, loans):
    _, path = loans
    C.replace_table(spark.table("cat_loans").where("part < '2'"), "cat_loans", path, "id", 4, ["part"])
    assert spark.table("cat_loans").count() == 200
    assert len(glob.glob(f"{path}/cat_loans_v_*")) == 1  # the old version is gone


def test_a_failed_write_leaves_the_old_rows(spark, loans):
    _, path = loans
    bad = spark.range(10).select("id", F.lit("0").alias("part"),
                                 F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="broken"):
        C.replace_table(bad, "cat_loans", path, "id", 4, ["part"])
    assert _total(spark) == (500, 249500)
    with pytest.raises(Exception, match="broken"):
        C.replace_partitions(bad, "cat_loans")
    assert _total(spark) == (500, 249500)
    assert len(glob.glob(f"{path}/cat_loans_v_*")) == 1


def test_only_the_given_partitions_are_replaced(spark, loans):
    new = spark.createDataFrame([(3, "3", 7), (8, "3", 9), (900, "9", 1)], "id long, part string, v long")
    got = C.replace_partitions(new.select("v", "part", "id"), "cat_loans")
    counts = {r["part"]: r["n"] for r in got.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert counts == {"0": 100, "1": 100, "2": 100, "3": 2, "4": 100, "9": 1}
    assert got.where("part = '3'").agg(F.sum("v")).first()[0] == 16
    assert "Exchange" not in _plan(got.groupBy("id").count())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_empty_null_and_foreign_names(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, part string, v long")
    assert C.replace_table(empty, "cat_empty", str(tmp_path), "id", 4, ["part"]).count() == 0
    rows = spark.createDataFrame([(None, None, 1), (2, "a", None)], "id long, part string, v long")
    back = C.replace_table(rows, "cat_empty", str(tmp_path), "id", 4, ["part"])
    assert sorted(map(str, (tuple(r) for r in back.select("id", "part", "v").collect()))) == ["(2, 'a', None)", "(None, None, 1)"]
    C.drop_table(spark, "cat_empty")
    C.drop_table(spark, "cat_empty")
    assert not spark.catalog.tableExists("cat_empty")
    with pytest.raises(ValueError):
        C.replace_partitions(rows, "cat_empty")
    spark.sql("CREATE OR REPLACE VIEW cat_foreign AS SELECT 1 AS id")
    with pytest.raises(ValueError):
        C.replace_table(rows, "cat_foreign", str(tmp_path), "id", 4)
    spark.sql("DROP VIEW cat_foreign")


def test_bucket_count(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 1000)
    path = str(tmp_path / "f")
    assert C.bucket_count(spark, [path]) == 8
    assert C.bucket_count(spark, [path], bucket_bytes=10) == 128
    assert C.bucket_count(spark, [path, path], bucket_bytes=125) == 16


def test_key_joins_without_exchange(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    plan = _plan(E.queries()["bucketed_join"](spark, SF_SMALL).hint("merge"))
    assert "Exchange hashpartitioning" not in plan and "PartitionFilters: [vintage" in plan
