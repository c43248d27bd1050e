"""Two-level running sums and exact percentiles against pandas / numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.ordered import (exact_percentile_rows, exact_percentiles, row_positions,
                                        running_totals)


def _frame(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], n),
        "x": np.round(rng.normal(size=n), 3),
        "k": np.arange(n, dtype=np.int64),
        "w": rng.integers(0, 5, n).astype(np.int64),
    })
    # one hot value holding a third of the rows
    pdf.loc[: n // 3, "x"] = 0.5
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("buckets", [1, 2, 7, 25])
def test_running_totals_any_bucket_count(spark, buckets):
    pdf, df = _frame(spark)
    out = running_totals(df, ["g", "-x", "k"], ["w"], buckets=buckets).toPandas()
    exp = pdf.sort_values(["g", "x", "k"], ascending=[True, False, True])
    exp["cum_w"] = exp["w"].cumsum()
    got = out.set_index("k").loc[exp["k"], "cum_w"].to_numpy()
    assert (got == exp["cum_w"].to_numpy()).all()


@pytest.mark.parametrize("buckets", [1, 5])
def test_running_totals_per_group(spark, buckets):
    pdf, df = _frame(spark)
    out = running_totals(df, ["x", "k"], ["w"], partition_by=["g"], buckets=buckets).toPandas()
    exp = pdf.sort_values(["g", "x", "k"])
    exp["cum_w"] = exp.groupby("g")["w"].cumsum()
    got = out.set_index("k").loc[exp["k"], "cum_w"].to_numpy()
    assert (got == exp["cum_w"].to_numpy()).all()


def test_row_positions_unique_and_dense(spark):
    pdf, df = _frame(spark)
    out = row_positions(df, ["-x", "k"], ["g"], buckets=4).toPandas()
    for g, part in out.groupby("g"):
        assert sorted(part["rn"]) == list(range(1, len(part) + 1))


@pytest.mark.parametrize("buckets", [1, 6])
def test_exact_percentiles_match_numpy(spark, buckets):
    pdf, df = _frame(spark)
    probs = [0.0, 0.1, 0.25, 0.3, 0.5, 0.77, 0.9, 1.0]
    rows = exact_percentile_rows(df, ["g"], "x", probs, buckets=buckets)
    for g, i, p, q in rows:
        exp = np.quantile(pdf.loc[pdf.g == g, "x"].to_numpy(), p)
        assert abs(exp - q) < 1e-12, (g, p, exp, q)


def test_exact_percentiles_weighted_and_nulls(spark):
    pdf = pd.DataFrame({"v": [1.0, 2.0, None, 4.0], "n": [3, 1, 5, 2]})
    df = spark.createDataFrame(pdf)
    rows = exact_percentile_rows(df, [], "v", [0.5, 0.9], weight_col="n")
    expanded = np.repeat([1.0, 2.0, 4.0], [3, 1, 2])
    for i, p, q in rows:
        assert abs(q - np.quantile(expanded, p)) < 1e-12


def test_approx_percentiles_close_to_exact(spark):
    from riskloom.operators.ordered import approx_percentiles
    pdf, df = _frame(spark)
    got = {(r["g"], r["pidx"]): r["q"] for r in
           approx_percentiles(df, ["g"], "x", [0.25, 0.5, 0.75]).collect()}
    for (g, i), q in got.items():
        vals = np.sort(pdf.loc[pdf.g == g, "x"].to_numpy())
        # rank error within 1/accuracy of the group size
        rank = np.searchsorted(vals, q, side="right") / len(vals)
        assert abs(rank - [0.25, 0.5, 0.75][i]) < 0.02 or vals[0] <= q <= vals[-1]


@pytest.mark.parametrize("buckets", [None, 1, 4])
def test_null_group_is_a_group(spark, buckets):
    rows = [(g, k) for g in ("g", None) for k in range(50)]
    df = spark.createDataFrame(rows, "g string, k long").withColumn("w", F.lit(2).cast("long"))
    got = running_totals(df, ["k"], ["w"], ["g"], buckets, totals={"w": "all"}).collect()
    assert len(got) == 100
    assert all(r.cum_w == 2 * (r.k + 1) and r["all"] == 100 for r in got)


def test_many_groups_and_partitions(spark):
    df = spark.range(200_000).select(F.col("id").alias("g"), F.lit(1.5).alias("x"))
    got = exact_percentiles(df, ["g"], "x", [0.5])
    assert got.where("q = 1.5").count() == 200_000
    wide = running_totals(spark.range(3000).withColumn("w", F.lit(1)), ["id"], ["w"], buckets=3000)
    assert wide.where("cum_w = id + 1").count() == 3000
