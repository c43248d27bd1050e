"""WoE / IV encoder against a numpy restatement of the binning rules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import woe as W


def _data(spark, n=2000, seed=11):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=n), 2)
    d = rng.integers(0, 4, n).astype(float)  # discrete (4 values)
    c = rng.choice(["A", "B", "C"], n)
    z = -1 + 0.8 * x + 0.3 * d + (c == "B") * 0.5
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-z))).astype(np.int64)
    const = np.ones(n)
    pdf = pd.DataFrame({"x": x, "d": d, "c": c, "const": const, "y": y})
    return pdf, spark.createDataFrame(pdf)


def _np_woe(x, y, edges):
    b = np.array([np.sum(np.array(edges) <= v) for v in x])
    P, N = max(y.sum(), 1), max((1 - y).sum(), 1)
    woes, iv = [], 0.0
    for k in range(len(edges) + 1):
        pos = y[b == k].sum()
        neg = (b == k).sum() - pos
        sp, sn = (pos + 0.5) / (P + 0.5), (neg + 0.5) / (N + 0.5)
        w = np.log(sn / sp)
        woes.append(w)
        iv += (sn - sp) * w
    return woes, iv


def test_numeric_edges_and_woe(spark):
    pdf, df = _data(spark)
    enc = W.fit_encoder(df, ["x", "d", "const"], ["c"], "y")
    fb = enc.bins["x"]
    qs = np.unique(np.quantile(pdf.x, np.linspace(0, 1, 11)))
    assert fb.kind == "numeric"
    assert np.allclose(fb.edges, np.round(qs[1:-1], 9))
    woes, iv = _np_woe(pdf.x.to_numpy(), pdf.y.to_numpy(), fb.edges)
    assert np.allclose(fb.woe, np.round(woes, 9), atol=1e-9)
    assert abs(fb.iv - iv) < 1e-9


def test_discrete_and_categorical(spark):
    pdf, df = _data(spark)
    enc = W.fit_encoder(df, ["x", "d"], ["c"], "y")
    assert enc.bins["d"].kind == "discrete_numeric" and enc.bins["d"].values == [0, 1, 2, 3]
    assert enc.bins["c"].kind == "categorical" and enc.bins["c"].values == ["A", "B", "C"]
    assert all(fb.iv >= 0 for fb in enc.bins.values())


def test_constant_column_iv_zero(spark):
    pdf, df = _data(spark)
    enc = W.fit_encoder(df, ["const"], [], "y")
    assert abs(enc.bins["const"].iv) < 1e-12


def test_transform_unseen_goes_to_bin_zero(spark):
    pdf, df = _data(spark)
    enc = W.fit_encoder(df, ["d"], ["c"], "y")
    new = spark.createDataFrame(pd.DataFrame({"d": [7.0, 2.0], "c": ["Z", "B"]}))
    out = W.transform(new, enc, ["d", "c"]).toPandas()
    assert out.woe_d.tolist() == [enc.bins["d"].woe[0], enc.bins["d"].woe[2]]
    assert out.woe_c.tolist() == [enc.bins["c"].woe[0], enc.bins["c"].woe[1]]


def test_floor_convention_right_closed(spark):
    pdf, df = _data(spark)
    enc = W.fit_encoder(df, ["x"], [], "y", convention="floor", closed="right", discrete_max=0)
    fb = enc.bins["x"]
    x, y = pdf.x.to_numpy(), pdf.y.to_numpy()
    b = np.searchsorted(np.array(fb.edges), x, side="left")
    P, N = y.sum(), (1 - y).sum()
    iv = 0.0
    for k in range(len(fb.edges) + 1):
        m = b == k
        de = max(y[m].sum() / P, 1e-6)
        dn = max((m.sum() - y[m].sum()) / N, 1e-6)
        if m.any():
            iv += (de - dn) * np.log(de / dn)
        assert abs(fb.woe[k] - round(np.log(de / dn), 9)) < 1e-9
    assert abs(fb.iv - iv) < 1e-9


def test_null_of_a_feature_with_few_values_is_bin_zero(spark):
    from riskloom.operators import woe as W
    rows = [(float(k % 3) if k % 4 else None, int(k % 5 == 0)) for k in range(120)]
    df = spark.createDataFrame(rows, "x double, y int")
    enc = W.fit_encoder(df, ["x"], [], "y")
    assert enc.bins["x"].values == [0.0, 1.0, 2.0]
    got = W.transform(df, enc, ["x"], keep=["x"]).distinct().collect()
    by = {r.x: r.woe_x for r in got}
    assert by[None] == by[0.0] and len(by) == 4


def test_many_levels_and_a_null_level(spark):
    from pyspark.sql import functions as F
    df = spark.range(40_000).select(
        F.when(F.col("id") % 20_000 > 0, F.concat(F.lit("l"), F.col("id") % 20_000)).alias("c"),
        (F.col("id") % 3 == 0).cast("int").alias("y"))
    enc = W.fit_encoder(df, [], ["c"], "y")
    got = W.transform(df.union(spark.createDataFrame([("new", 0)], "c string, y int")), enc, ["c"], keep=["c"])
    by = {r.c: r.woe_c for r in got.distinct().collect()}
    fb = enc.bins["c"]
    assert len(fb.values) == 20_000 and len(by) == 20_001
    assert all(by[v] == w for v, w in zip(fb.values, fb.woe)) and by["new"] == fb.woe[0]


def test_only_zero_shares_are_replaced(spark):
    # one of 2,000,000 bads in a bin: below the floor, but not zero
    counts = spark.createDataFrame([("x", "numeric", 0, None, 0.0, 1.0, 1_000_001, 1),
                                    ("x", "numeric", 1, None, 1.0, 2.0, 2_999_999, 1_999_999),
                                    ("x", "numeric", 2, None, 2.0, 3.0, 10, 0)],
                                   W.TABLE_SCHEMA.split(", n_neg")[0])
    def woe(floored):
        got = W._woe_columns(counts, W._class_totals(counts), "floor", floored, None).collect()
        return {r.bin: r.woe for r in got}
    neg = 2_000_010
    every, zeros = woe("all"), woe("zeros")
    assert abs(zeros[0] - np.log(1 / 2_000_000 / (1_000_000 / neg))) < 1e-9
    assert abs(every[0] - np.log(1e-6 / (1_000_000 / neg))) < 1e-9
    assert every[2] == zeros[2] and every[1] == zeros[1]


def test_tiny_values_keep_their_edges(spark):
    df = spark.range(1000).select((F.col("id") * 1e-12).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    enc = W.fit_encoder(df, ["x"], [], "y")
    assert len(enc.bins["x"].edges) == 9
    assert np.allclose(enc.bins["x"].edges, np.quantile(np.arange(1000) * 1e-12, np.arange(1, 10) / 10), rtol=1e-9, atol=0)


def test_woe_is_that_of_the_bin(spark):
    xs = [None, float("nan"), -9.0, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 99.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for closed in ("left", "right"):
        for fb in (W.FeatureBins("x", "numeric", edges=[0.0, 1.0, 2.0], woe=[0.1, 0.2, 0.3, 0.4]),
                   W.FeatureBins("x", "numeric", woe=[0.7]),
                   W.FeatureBins("x", "discrete_numeric", values=[0.0, 1.0, 3.0], woe=[0.5, 0.6, 0.7])):
            for r in df.select("x", W.bin_column(fb, df.x, closed).alias("b"), W.woe_column(fb, df.x, closed).alias("w")).collect():
                assert r.w == fb.woe[r.b], (closed, fb, r)
