"""Model jobs against numpy restatements (Newton logistic, inverse correlation)."""

import numpy as np
import pytest
import pandas as pd

from riskloom.operators import models as M
from riskloom.operators.calibration import newton_offset
from riskloom.operators.selection import correlation_matrix, vif_elimination, vif_from_corr


def _data(spark, n=1500, seed=2):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = 0.6 * x1 + rng.normal(size=n)
    x3 = rng.normal(size=n)
    z = -0.5 + 1.2 * x1 - 0.7 * x2 + 0.2 * x3
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-z))).astype(np.int64)
    pdf = pd.DataFrame({"id": np.arange(n, dtype=np.int64), "x1": x1, "x2": x2, "x3": x3,
                        "y": y, "fold": (np.arange(n) % 5).astype(np.int32)})
    return pdf, spark.createDataFrame(pdf)


def _newton(X, y, C=1.0, iters=50):
    X1 = np.column_stack([np.ones(len(X)), X])
    w = np.zeros(X1.shape[1])
    reg = np.ones(len(w)) / C
    reg[0] = 0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X1 @ w))
        g = X1.T @ (p - y) + reg * w
        H = (X1 * (p * (1 - p))[:, None]).T @ X1 + np.diag(reg)
        w = w - np.linalg.solve(H, g)
    return w


def test_l2_logistic_matches_newton(spark):
    pdf, df = _data(spark)
    m = M.logistic(df, ["x1", "x2", "x3"], "y", C=1.0)
    w = _newton(pdf[["x1", "x2", "x3"]].to_numpy(), pdf.y.to_numpy())
    got = np.array([m.intercept, *m.coefficients.toArray()])
    assert np.allclose(got, w, atol=1e-5)


@pytest.mark.parametrize("C", [0.02, 0.1, 1.0])
def test_l1_with_penalised_intercept_is_at_its_optimum(spark, C):
    pdf, df = _data(spark)
    names = ["x1", "x2", "x3"]
    m = M.logistic(df, names, "y", C=C, penalty="l1", penalise_intercept=True)
    table = dict(M.coefficients(m, names))
    w = np.array([table["(intercept)"], *[table[n] for n in names]])
    x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy()])
    p = 1 / (1 + np.exp(-x @ w))
    slope = C * (x.T @ (p - pdf.y.to_numpy()))  # of the loss; the penalty's is the sign, or within 1 at zero
    on = w != 0
    assert np.allclose(slope[on], -np.sign(w[on]), atol=1e-3)
    assert (np.abs(slope[~on]) <= 1 + 1e-3).all()
    got = M.predict_proba(m, df, names, names).toPandas()
    z = table["(intercept)"] + got[names].to_numpy() @ w[1:]
    assert np.allclose(got.p, 1 / (1 + np.exp(-z)), atol=1e-12)


def test_penalised_intercept_can_be_zero(spark):
    _, df = _data(spark)
    m = M.logistic(df, ["x1"], "y", C=1e-6, penalty="l1", penalise_intercept=True)
    assert M.coefficients(m, ["x1"]) == [("(intercept)", 0.0), ("x1", 0.0)]
    free = M.logistic(df, ["x1"], "y", C=1e-6, penalty="l1")
    assert dict(M.coefficients(free, ["x1"]))["(intercept)"] != 0


def test_batched_newton_fits_match_numpy(spark):
    pdf, df = _data(spark)
    models = M._fit_all(df, ["x1", "x2", "x3"], {"x2": ["x1", "x2"]}, 5, 1.0)
    for f in range(5):
        tr = pdf[pdf.fold != f]
        w = _newton(tr[["x1", "x2"]].to_numpy(), tr.y.to_numpy())
        assert np.allclose(models[("x2", f)][1], w, atol=1e-8)


def test_forward_first_step_is_best_single_feature(spark):
    pdf, df = _data(spark)
    steps = M.forward_logistic(df, ["x1", "x2", "x3"], max_features=2, n_folds=5)
    assert [s[0] for s in steps] == [1, 2]
    assert steps[0][1] == "x1"


def test_vif_is_inverse_correlation_diagonal(spark):
    pdf, df = _data(spark)
    corr = correlation_matrix(df, ["x1", "x2", "x3"])
    assert np.allclose(corr, np.corrcoef(pdf[["x1", "x2", "x3"]].to_numpy().T), atol=1e-12)
    v = vif_from_corr(corr)
    assert np.allclose(v, np.diag(np.linalg.inv(corr)))


def test_vif_elimination_drops_collinear(spark):
    pdf, df = _data(spark)
    df2 = df.withColumn("x4", df.x1 * 2 + df.x3 * 0.001)
    kept, removed = vif_elimination(df2, ["x1", "x2", "x3", "x4"], 10.0)
    assert len(removed) >= 1 and len(kept) == 4 - len(removed)


def test_newton_offset_hits_target(spark):
    pdf, df = _data(spark)
    scored = df.selectExpr("1 / (1 + exp(-(x1 - 1))) AS p", "y")
    c = newton_offset(scored, "p", "y", steps=8)
    p = 1 / (1 + np.exp(-(pdf.x1.to_numpy() - 1)))
    z = np.log(p / (1 - p)) + c
    assert abs(np.mean(1 / (1 + np.exp(-z))) - pdf.y.mean()) < 1e-12


def test_newton_offset_far_targets(spark):
    for p, target in ((0.018, 0.5), (0.98, 0.1), (0.5, 0.999)):
        df = spark.createDataFrame([(p, 0), (p, 1)], "p double, y int")
        c = newton_offset(df, "p", "y", target=target)
        want = np.log(target / (1 - target)) - np.log(p / (1 - p))
        assert abs(c - want) < 1e-9
    df = spark.createDataFrame([(0.5, 0)], "p double, y int")
    assert newton_offset(df, "p", "y", target=1 - 1e-9) == 10.0


def test_vif_drops_the_last_dependent_column(spark):
    rng = np.random.default_rng(3)
    z, a = rng.normal(size=(2, 200))
    rows = [(float(x), float(y), float(y), 1.0) for x, y in zip(z, a)]
    df = spark.createDataFrame(rows, "z double, a double, b double, flat double")
    assert vif_elimination(df, ["z", "a", "b", "flat"])[0] == ["z", "a", "flat"]
    v = vif_from_corr(correlation_matrix(df, ["z", "a", "b", "flat"]))
    assert np.isinf(v[2]) and np.isfinite(v[[0, 1, 3]]).all() and v[3] == 1


def test_fitted_scorecard_end_to_end(spark):
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from riskloom.operators import woe as W
    from riskloom.plans import models_q as MQ
    from riskloom.plans import scorecard as S
    fit = MQ.FittedScorecard(spark, SF_SMALL)
    loans = fit.loans.toPandas()
    train = loans[loans.cohort == "TRAIN"]
    assert abs(train.p_cal.mean() - train.y.mean()) < 1e-7
    # first-order conditions of the L2 fit over all TRAIN rows
    prep = S.prepared_loans(spark, SF_SMALL)
    wide = W.transform(prep, fit.enc, fit.kept, keep=["loan_id", "cohort", "y"]).where(
        F.col("cohort") == "TRAIN").toPandas().merge(train[["loan_id", "p"]], on="loan_id")
    x = wide[[f"woe_{f}" for f in fit.kept]].to_numpy()
    slope = x.T @ (wide.p - wide.y).to_numpy() + fit.model.coefficients.toArray()
    assert abs((wide.p - wide.y).sum()) < 0.05 and np.abs(slope).max() < 0.05
    counts = loans.groupby(["cohort", "grade"]).size().to_dict()
    for r in fit.grades().collect():
        assert r.n == counts.get((r.split, r.grade), 0)
    assert set(fit.kept) | set(fit.dropped) == set(fit.enc.bins)


def test_solver_passes_read_written_rows(spark):
    from riskloom.plans import models_q as MQ
    wide, cols, feats, enc = MQ._woe_design(spark, "/root/testdata/sf0.001")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "CASE" not in plan and wide.columns == ["loan_id", "cohort", "y", *cols]


def test_newton_sums_leave_a_task_once():
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.normal(size=60), "b": rng.normal(size=60), "y": rng.integers(0, 2, 60), "fold": np.arange(60) % 2})
    spec = {("a", f): (["b", "a"], [0.1, 0.2, 0.3]) for f in range(2)}
    got = list(M._partial_sums(spec, ["a", "b"])(iter([pdf[:20], pdf[20:21], pdf[21:]])))
    assert len(got) == 1 and len(got[0]) == 2 * (3 + 9)
    for f in range(2):
        r = pdf[pdf.fold != f]
        x = np.column_stack([np.ones(len(r)), r.b, r.a])
        p = 1 / (1 + np.exp(-x @ np.array([0.1, 0.2, 0.3])))
        want = np.concatenate([x.T @ (p - r.y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
        assert np.allclose(got[0][got[0].fold == f].v, want)


def _jobs(spark, run):
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    try:
        got = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_logistic_needs_few_passes_and_reaches_its_optimum(spark, penalty):
    pdf, df = _data(spark)
    names = ["x1", "x2", "x3"]
    m, jobs = _jobs(spark, lambda: M.logistic(df, names, "y", 0.1, penalty, penalise_intercept=True))
    assert jobs <= 12
    w = np.array([m.intercept, *m.coefficients.toArray()])
    x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy()])
    slope = 0.1 * (x.T @ (1 / (1 + np.exp(-x @ w)) - pdf.y.to_numpy()))
    on = w != 0
    assert np.abs(slope + (w if penalty == "l2" else np.sign(w)))[on].max() < 1e-8 and (np.abs(slope[~on]) <= 1).all()


def test_equal_columns_share_their_weight(spark):
    _, df = _data(spark)
    df = df.withColumn("again", df.x1).withColumn("flat", df.x1 * 0)
    for penalty in ("l1", "l2"):
        m = M.logistic(df, ["x1", "x3", "again", "flat"], "y", 0.1, penalty, penalise_intercept=penalty == "l1")
        a, _, b, flat = m.coefficients.toArray()
        assert a > 0.1 and abs(a - b) < 1e-9 and abs(flat) < 1e-12


def test_logistic_of_one_class_of_large_values_and_of_bad_rows(spark):
    _, df = _data(spark, 200)
    one = M.logistic(df.where("y = 1"), ["x1"])
    assert one.intercept == float("inf") and one.coefficients.toArray().tolist() == [0.0]
    assert {r.p for r in M.predict_proba(one, df, ["x1"], ["id"]).collect()} == {1.0}
    parted = spark.createDataFrame([(float(i), int(i > 0)) for i in range(-50, 51) if i], "x double, y int")
    m = M.logistic(parted, ["x"], C=1e4)  # full Newton steps overshoot here
    assert np.isfinite(m.coefficients[0]) and m.coefficients[0] > 1
    for bad in (df.selectExpr("if(id = 7, null, x1) x1", "y"), df.where("false")):
        with pytest.raises(ValueError):
            M.logistic(bad, ["x1"])


def test_scores_of_a_logistic_model_are_one_expression(spark):
    pdf, df = _data(spark, 300)
    m = M.logistic(df, ["x1", "x2"])
    out = M.predict_proba(m, df, ["x1", "x2"], ["id"])
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
    z = m.intercept + pdf[["x1", "x2"]].to_numpy() @ m.coefficients.toArray()
    got = out.toPandas().set_index("id").p.loc[pdf.id].to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-z)), atol=1e-14)
