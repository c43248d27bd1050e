"""Preparation operators against pandas on small frames (edge cases of SURVEY section 5)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.functions.expr import GRADE_EDGES, GRADE_LABELS, annuity, grade_label
from riskloom.operators import prep as P


def _frame(spark):
    pdf = pd.DataFrame({
        "g": ["a", "a", "a", "b", "b", "c", "c"],
        "x": [1.0, None, 3.0, 10.0, None, None, None],  # group c all NULL
        "period": [2010, 1956, None, 2011, 1956, 2012, None],
        "k": [1, 2, 3, 4, 5, 6, 7],
    })
    return pdf, spark.createDataFrame(pdf.astype({"period": "Int64"}))


def test_group_median_keeps_all_null_group(spark):
    pdf, df = _frame(spark)
    out = P.impute_median(df, ["x"], ["g"]).toPandas().set_index("k")
    assert out.loc[2, "x"] == 2.0 and out.loc[5, "x"] == 10.0
    assert pd.isna(out.loc[6, "x"]) and pd.isna(out.loc[7, "x"])


def test_global_median(spark):
    pdf, df = _frame(spark)
    out = P.impute_median(df, ["x"]).toPandas().set_index("k")
    assert out.loc[2, "x"] == float(np.median([1.0, 3.0, 10.0]))


def test_drop_period_keeps_nulls(spark):
    pdf, df = _frame(spark)
    out = P.drop_period(df, "period", 1956).toPandas()
    assert sorted(out.k) == [1, 3, 4, 6, 7]


def test_missing_counts_only_positive(spark):
    pdf, df = _frame(spark)
    out = {r.column_name: r.n_missing for r in P.missing_counts(df, ["x", "k"]).collect()}
    assert out == {"x": 4}


def test_standardize_sample_and_population(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 4.0, 7.0], "c": [5.0] * 4})
    df = spark.createDataFrame(pdf)
    s = P.standardize(df, ["a", "c"]).toPandas()
    assert np.allclose(s.a, (pdf.a - pdf.a.mean()) / pdf.a.std())
    assert np.allclose(s.c, 0.0)  # zero deviation -> divide by 1
    p = P.standardize(df, ["a"], population=True).toPandas()
    assert np.allclose(p.a, (pdf.a - pdf.a.mean()) / pdf.a.std(ddof=0))


def test_drop_unusable_columns(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0], "b": [1.0, float("inf")], "c": [None, 1.0]})
    df = spark.createDataFrame(pdf)
    assert P.drop_unusable_columns(df, ["a", "b", "c"]).columns == ["a"]


def test_annuity_and_zero_rate(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1000.0, 1200.0], "r": [12.0, 0.0],
                                             "n": [12, 12]}))
    out = df.select(annuity(df.a, df.r, df.n).alias("pay")).toPandas().pay
    r = 0.01
    assert abs(out[0] - 1000 * r / (1 - (1 + r) ** -12)) < 1e-9
    assert out[1] == 100.0


def test_grade_is_searchsorted_right(spark):
    ps = [0.0, 0.005, 0.0049, 0.12, 0.5, 1.0, 1.5]
    df = spark.createDataFrame(pd.DataFrame({"p": ps}))
    got = [r.g for r in df.select(grade_label(df.p).alias("g")).collect()]
    exp = [GRADE_LABELS[min(int(np.searchsorted(GRADE_EDGES, p, side="right")), 8)] for p in ps]
    assert got == exp


def test_group_median_of_many_groups(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("g"),
        F.when(F.col("id") >= 20_000, F.col("id").cast("double")).alias("x"))
    got = P.impute_median(df, ["x"], ["g"])
    assert got.columns == ["g", "x"] and got.count() == 60_000
    first = got.where("x = g + 30000").count()
    assert first == 20_000


def test_median_of_tiny_values_is_not_rounded(spark):
    df = spark.createDataFrame([(1, 4e-8), (2, 5e-8), (3, None)], "k int, x double")
    got = {r.k: r.x for r in P.impute_median(df, ["x"]).collect()}
    assert abs(got[3] - 4.5e-8) < 1e-15


def test_annuity_without_a_term_and_folds_of_large_keys(spark):
    from pyspark.sql import functions as F
    from riskloom.functions.expr import annuity
    from riskloom.operators.selection import stratified_folds
    df = spark.createDataFrame([(1, 100.0, 0.0, 0), (2, 100.0, 12.0, 0), (3, 100.0, 0.0, 10)],
                               "k int, a double, r double, n int")
    got = {r.k: r.p for r in df.select("k", annuity(F.col("a"), F.col("r"), F.col("n")).alias("p")).collect()}
    assert got == {1: None, 2: None, 3: 10.0}
    big = spark.range(2**62, 2**62 + 100).select(F.col("id").alias("key"), (F.col("id") % 2).alias("y"))
    per = stratified_folds(big, "y", "key").groupBy("fold", "y").count().collect()
    assert len(per) == 10 and all(r["count"] == 10 for r in per)
