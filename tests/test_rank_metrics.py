"""Exact rank metrics against brute-force numpy restatements."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.rank_metrics import (cap_curve, cumulative, decile_table,
                                             rank_summary, roc_curve, threshold_sweep)


def _scores(spark, n=1200, seed=5):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.round(np.clip(0.3 * y + rng.uniform(0, 0.7, n), 0, 1), 2)  # many ties
    pdf = pd.DataFrame({"id": np.arange(n, dtype=np.int64), "grp": rng.choice(["u", "v"], n),
                        "p": p, "y": y.astype(np.int64)})
    return pdf, spark.createDataFrame(pdf)


def _auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
        len(pos) * len(neg))


def _ks_ap(y, p):
    order = np.argsort(-p, kind="stable")
    ys, ps = y[order], p[order]
    th = np.unique(ps)[::-1]
    P, N = y.sum(), (1 - y).sum()
    ks, ap, prev_r = 0.0, 0.0, 0.0
    for t in th:
        tp = ((p >= t) & (y == 1)).sum()
        fp = ((p >= t) & (y == 0)).sum()
        ks = max(ks, tp / P - fp / N)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ks, ap


def test_summary_matches_bruteforce(spark):
    pdf, df = _scores(spark)
    got = rank_summary(cumulative(df, ["grp"], "p", "y"), ["grp"]).toPandas().set_index("grp")
    for g, part in pdf.groupby("grp"):
        y, p = part.y.to_numpy(), part.p.to_numpy()
        ks, ap = _ks_ap(y, p)
        assert abs(got.loc[g, "auc"] - _auc(y, p)) < 1e-12
        assert abs(got.loc[g, "gini"] - (2 * _auc(y, p) - 1)) < 1e-12
        assert abs(got.loc[g, "ks"] - ks) < 1e-12
        assert abs(got.loc[g, "ap"] - ap) < 1e-12


def test_auc_invariant_to_monotone_transform(spark):
    pdf, df = _scores(spark)
    a = rank_summary(cumulative(df, [], "p", "y"), []).first()["auc"]
    b = rank_summary(cumulative(df.withColumn("p", df.p * 2), [], "p", "y"), []).first()["auc"]
    assert abs(a - b) < 1e-15


def test_one_class_gives_null(spark):
    pdf, df = _scores(spark)
    only = df.where("y = 1")
    r = rank_summary(cumulative(only, [], "p", "y"), []).first()
    assert r["auc"] is None and r["ks"] is None


def test_decile_table_matches_qcut(spark):
    pdf, df = _scores(spark, n=1001)
    got = decile_table(df, [], "p", "y", "id").toPandas().sort_values("decile")
    s = pdf.sort_values(["p", "id"], ascending=[False, True]).reset_index(drop=True)
    r = np.arange(len(s))
    dec = np.maximum(1, np.ceil(10 * r / (len(s) - 1)).astype(int))
    exp = s.assign(decile=dec).groupby("decile").agg(n=("y", "size"), defaults=("y", "sum"))
    assert got["n"].tolist() == exp["n"].tolist()
    assert got["defaults"].tolist() == exp["defaults"].tolist()
    assert got["cum_defaults"].iloc[-1] == pdf.y.sum()


def test_cap_curve_ends_at_one(spark):
    pdf, df = _scores(spark)
    got = cap_curve(df, ["grp"], "p", "y", "id").toPandas()
    for g, part in got.groupby("grp"):
        last = part.sort_values("rn").iloc[-1]
        assert abs(last["cum_pop"] - 1) < 1e-12 and abs(last["cum_capture"] - 1) < 1e-12


def test_threshold_sweep_matches_loop(spark):
    pdf, df = _scores(spark)
    got = threshold_sweep(df, [], "p", "y").toPandas().sort_values("k")
    ts = np.linspace(0, 1, 200)
    y, p = pdf.y.to_numpy(), pdf.p.to_numpy()
    tp = np.array([((p >= t) & (y == 1)).sum() for t in ts])
    fp = np.array([((p >= t) & (y == 0)).sum() for t in ts])
    assert (got["tp"].to_numpy() == tp).all() and (got["fp"].to_numpy() == fp).all()
    best = np.argmax(tp / y.sum() - fp / (1 - y).sum())
    assert got.loc[got.is_ks_best, "k"].tolist() == [best]


def test_calibration_curve_per_group_and_null_group(spark):
    from riskloom.operators import calibration as C
    pdf, df = _scores(spark)
    df = df.withColumn("grp", F.when(F.col("grp") != pdf.grp.iloc[0], F.col("grp")))
    got = C.calibration_curve(df, ["grp"], "p", "y").toPandas()
    pdf = pdf.assign(grp=pdf.grp.where(pdf.grp != pdf.grp.iloc[0], None))
    for g, rows in pdf.groupby("grp", dropna=False):
        edges = np.round(np.quantile(rows.p, np.arange(1, 10) / 10), 12)
        bins = (edges[None, :] < rows.p.to_numpy()[:, None]).sum(1)
        part = got[got.grp.isna() if pd.isna(g) else got.grp == g].set_index("bin")
        for b in set(bins):
            assert part.n[b] == (bins == b).sum()
            assert np.isclose(part.mean_pred[b], rows.p[bins == b].mean())
            assert np.isclose(part.frac_pos[b], rows.y[bins == b].mean())


def test_null_group_and_group_without_bads_are_kept(spark):
    from riskloom.operators import rank_metrics as R
    rows = [(g, k / 10, int(g != "b" and k % 3 == 0), k + 10 * i)
            for i, g in enumerate(("a", None, "b")) for k in range(10)]
    df = spark.createDataFrame(rows, "g string, p double, y int, id long")
    groups = {"a", None, "b"}
    got = R.rank_summary(R.cumulative(df, ["g"], "p", "y"), ["g"]).collect()
    assert {r.g for r in got} == groups
    assert {r.g: r.auc for r in got}["a"] == {r.g: r.auc for r in got}[None]
    cap = R.cap_curve(df, ["g"], "p", "y", "id").collect()
    assert len(cap) == 30 and all(r.perfect is None for r in cap if r.g == "b")
    assert {r.g for r in R.decile_table(df, ["g"], "p", "y", "id").collect()} == groups
    sweep = R.threshold_sweep(df, ["g"], "p", "y", 11)
    by = {g: sorted(str(r.asDict() | {"g": 0}) for r in sweep.collect() if r.g == g) for g in groups}
    assert by["a"] == by[None]


def _roc(y, p):
    """Points of the curve without those between two equal steps, origin first."""
    th = np.unique(p)[::-1]
    pos = np.array([((p == t) & (y == 1)).sum() for t in th])
    neg = np.array([((p == t) & (y == 0)).sum() for t in th])
    keep = [i for i in range(len(th)) if i in (0, len(th) - 1) or (pos[i], neg[i]) != (pos[i + 1], neg[i + 1])]
    tp, fp = np.cumsum(pos), np.cumsum(neg)
    return [(None, 0.0, 0.0)] + [(th[i], fp[i] / neg.sum(), tp[i] / pos.sum()) for i in keep]


@pytest.mark.parametrize("ties", [True, False])
def test_roc_curve(spark, ties):
    pdf, df = _scores(spark)
    if not ties:  # distinct scores: long runs of one class become a single step
        pdf["p"] = (pdf["id"] * 7919 % 10007) / 10007
        df = spark.createDataFrame(pdf)
    got = roc_curve(df, ["grp"], "p", "y").collect()
    for g, d in pdf.groupby("grp"):
        want = _roc(d.y.values, d.p.values)
        rows = sorted((r for r in got if r.grp == g), key=lambda r: -(2.0 if r.threshold is None else r.threshold))
        assert [r.threshold for r in rows] == [w[0] for w in want]
        assert np.allclose([(r.fpr, r.tpr) for r in rows], [w[1:] for w in want])
        full = _auc(d.y.values, d.p.values)
        assert np.isclose(np.trapezoid([r.tpr for r in rows], [r.fpr for r in rows]), full)
    one = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 1)], "p double, y int")
    assert [tuple(r) for r in roc_curve(one, [], "p", "y").collect()] == [(None, 0.0, 0.0), (0.5, 1.0, 1.0)]
    assert roc_curve(one.limit(0), [], "p", "y").count() == 0
