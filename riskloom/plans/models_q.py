"""Model-fitting query keys (registered into ``queries.REGISTRY``, no SQL oracle).

First pipeline: L2 / L1 logistic on the WoE of IV-selected features, fitted
on TRAIN.  Second pipeline: IV screen (floor convention), VIF removal, scaled
features, stratified folds, greedy forward search, boosted trees.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import IV_THRESHOLD, round_double
from ..operators import boosting as B
from ..operators import models as M
from ..operators import prep as P
from ..operators import rank_metrics as RM
from ..operators import woe as W
from ..operators.calibration import calibration_curve, grade_table, newton_offset, prob_losses
from ..operators.selection import stratified_folds, vif_elimination
from ..operators.stability import psi_grades
from ..session import materialize, scratch_path
from ..sources.files import read_csv, read_json, write_csv, write_json
from . import scorecard as S
from .queries import (FOLD_SEED, METRIC_FIELDS, METRICS_SCHEMA, N_FOLDS, iv_table_frame, register,
                      rounded)

# What the searches and fits must use for comparable results.
L1_C = 0.1
VIF_THRESHOLD = 10.0
MAX_FEATURES = 10
ALPHA = 0.5
# tree settings of the second pipeline (search / final)
TREE_SEARCH = {"max_iter": 100, "max_depth": 4, "step": 0.05, "subsample": 0.8,
               "col_sample": "0.8"}
TREE_FINAL = {**TREE_SEARCH, "max_iter": 300}
POS_WEIGHTS = [1, 5, 10, 20, 40, 60]
TUNE_FOLDS = 3


def _woe_design(spark: SparkSession, sf: str):
    prep = S.written_loans(spark, sf)
    enc = S.fit_scorecard_encoder(prep)
    feats = [f for f, fb in sorted(enc.bins.items(), key=lambda kv: -kv[1].iv)
             if fb.iv >= IV_THRESHOLD]
    # written: the solver's passes and the scoring read it
    wide = materialize(W.transform(prep, enc, feats, keep=["loan_id", "cohort", "y"]), "woe")
    cols = [f"woe_{f}" for f in feats]
    return wide, cols, feats, enc


def _fit(spark, sf, penalty="l2", C=1.0):
    wide, cols, feats, enc = _woe_design(spark, sf)
    train = wide.where(F.col("cohort") == "TRAIN")
    model = M.logistic(train, cols, "y", C=C, penalty=penalty, penalise_intercept=penalty == "l1")
    return model, wide, cols, feats, enc


def _coef_frame(spark, model, feats):
    return spark.createDataFrame(M.coefficients(model, feats), "feature string, coef double")


@register("logit_l2")
def q_logit_l2(spark, sf):
    """L2 logistic, C = 1, on TRAIN WoE (coefficients and intercept)."""
    model, wide, cols, feats, enc = _fit(spark, sf)
    return rounded(_coef_frame(spark, model, feats), ["coef"])


@register("logit_l1")
def q_logit_l1(spark, sf):
    """L1 logistic, C = 0.1 (the shrinkage stress test); the intercept is penalised too."""
    model, wide, cols, feats, enc = _fit(spark, sf, "l1", L1_C)
    return rounded(_coef_frame(spark, model, feats), ["coef"])


@register("l1_zeroed")
def q_l1_zeroed(spark, sf):
    """Features the L1 fit sets to exactly zero (may be none)."""
    model, wide, cols, feats, enc = _fit(spark, sf, "l1", L1_C)
    return _coef_frame(spark, model, feats).where(
        (F.col("feature") != "(intercept)") & (F.col("coef") == 0)).select("feature")


@register("score_model")
def q_score_model(spark, sf):
    """Class-1 probability of the L2 model for every loan."""
    model, wide, cols, feats, enc = _fit(spark, sf)
    out = M.predict_proba(model, wide, cols, ["loan_id", "cohort", "y"])
    return rounded(out, ["p"])


def _coef_table(spark, model, feats, enc):
    coefs = _coef_frame(spark, model, feats).where(F.col("feature") != "(intercept)")
    iv = enc.iv_frame().select("feature", "iv")
    w = Window.orderBy(F.abs("coef").desc(), "feature")  # one row a feature
    return rounded(coefs.join(iv, "feature").select(
        "feature", F.col("coef").alias("coef_woe"), "iv", F.abs("coef").alias("abs_coef"),
        F.row_number().over(w).cast("bigint").alias("abs_rank")), ["coef_woe", "iv", "abs_coef"])


@register("coef_table")
def q_coef_table(spark, sf):
    """Model weights beside IV, with their rank by absolute weight."""
    model, wide, cols, feats, enc = _fit(spark, sf)
    return _coef_table(spark, model, feats, enc)


# ---------------------------------------------------------------------------
# The fitted scorecard: logistic -> offset frozen on TRAIN -> grades -> tables
# ---------------------------------------------------------------------------

SPLITS = ["TRAIN", "VAL", "OOT"]
TEST_SPLITS = SPLITS[1:]


class FittedScorecard:
    """Model, calibrated and graded loans (``written``: for tables that scan them more than once)."""

    def __init__(self, spark: SparkSession, sf: str, written: bool = False):
        self.spark = spark
        self.model, wide, cols, self.kept, self.enc = _fit(spark, sf)
        self.dropped = sorted(set(self.enc.bins) - set(self.kept))
        scored = M.predict_proba(self.model, wide, cols, ["loan_id", "cohort", "y"])
        scored = scored.withColumn("p", round_double(F.col("p"), S.SCORE_DECIMALS))
        if written:
            scored = materialize(scored, "scored")
        self.offset = round(newton_offset(scored.where(F.col("cohort") == "TRAIN"), "p", "y"), S.SCORE_DECIMALS)
        self.loans = S.graded(S.calibrated(scored, self.offset))
        self.test = self.loans.where(F.col("cohort").isin(TEST_SPLITS))

    def grades(self):
        t = grade_table(self.spark, self.loans, "cohort", "grade", "p_cal", "y", SPLITS)
        return rounded(t.drop("grade_ix"), ["obs_dr", "pred_pd", "population_pct"])

    def psi(self):
        return psi_grades(self.loans, "cohort", "grade", "TRAIN", TEST_SPLITS)


@register("model_grade_table")
def q_model_grade_table(spark, sf):
    """Grade table of the fitted, calibrated scorecard per split."""
    return FittedScorecard(spark, sf).grades()


@register("model_psi_grades")
def q_model_psi_grades(spark, sf):
    """PSI of the fitted scorecard's grades against TRAIN."""
    return rounded(FittedScorecard(spark, sf).psi(), ["psi"])


@register("model_metrics_json")
def q_model_metrics_json(spark, sf):
    """The fitted scorecard's record per split, as nested JSON written and read back.

    Discrimination, losses, PSI against TRAIN, offset, and the kept and
    dropped features with their counts.
    """
    fit = FittedScorecard(spark, sf, written=True)
    rank = RM.rank_summary(RM.cumulative(fit.loans, ["cohort"], "p_cal", "y"), ["cohort"])
    psi = fit.psi().select(F.col("actual_split").alias("cohort"), F.col("psi").alias("psi_vs_train"))
    names = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    nested = (rank.join(prob_losses(fit.loans, ["cohort"], "p_cal", "y"), "cohort").join(psi, "cohort", "left")
              .select("cohort", F.lit(fit.offset).alias("calib_offset"), F.struct(*METRIC_FIELDS).alias("metrics"),
                      F.struct(names(fit.kept).alias("kept"), names(fit.dropped).alias("dropped"),
                               F.lit(len(fit.kept)).cast("bigint").alias("n_kept"),
                               F.lit(len(fit.dropped)).cast("bigint").alias("n_dropped")).alias("features")))
    path = write_json(nested, scratch_path(spark, "model_metrics_json"))
    back = read_json(spark, path, METRICS_SCHEMA + ", features struct<kept: array<string>, "
                     "dropped: array<string>, n_kept: bigint, n_dropped: bigint>")
    return rounded(back.select("cohort", "calib_offset", "metrics.*", "features.*"), METRIC_FIELDS)


@register("model_result_files")
def q_model_result_files(spark, sf):
    """IV, coefficient and grade files (';'-separated), written and read back: file, key, name, value."""
    fit = FittedScorecard(spark, sf)
    files = {"iv": (iv_table_frame(fit.enc), ["feature"]),
             "coefficients": (_coef_table(spark, fit.model, fit.kept, fit.enc), ["feature"]),
             "grades": (fit.grades(), ["split", "grade"])}
    out = None
    for name, (df, keys) in files.items():
        path = write_csv(df, scratch_path(spark, f"result_{name}"))
        back = read_csv(spark, path, df.schema)
        values = [c for c in df.columns if c not in keys]
        long = back.select(F.lit(name).alias("file"), F.concat_ws("/", *keys).alias("key"),
                           *[F.col(c).cast("string").alias(c) for c in values]).unpivot(
            ["file", "key"], values, "name", "value")
        out = long if out is None else out.unionByName(long)
    return out


@register("model_decile_table")
def q_model_decile_table(spark, sf):
    """Gain table of the fitted scorecard on the test splits."""
    t = RM.decile_table(FittedScorecard(spark, sf, written=True).test, ["cohort"], "p_cal", "y", "loan_id")
    return rounded(t.withColumn("cum_defaults", F.col("cum_defaults").cast("bigint")),
                   ["default_rate", "cum_capture_rate"])


@register("model_cap_curve")
def q_model_cap_curve(spark, sf):
    """CAP of the fitted scorecard on the test splits."""
    t = RM.cap_curve(FittedScorecard(spark, sf, written=True).test, ["cohort"], "p_cal", "y", "loan_id")
    return rounded(t.withColumn("rn", F.col("rn").cast("bigint")),
                   ["cum_pop", "cum_capture", "perfect", "random_line"])


@register("model_calibration_curve")
def q_model_calibration_curve(spark, sf):
    """Reliability of the fitted scorecard on the test splits."""
    t = calibration_curve(FittedScorecard(spark, sf, written=True).test, ["cohort"], "p_cal", "y")
    return rounded(t.withColumn("bin", F.col("bin").cast("int")), ["mean_pred", "frac_pos"])


@register("model_threshold_sweep")
def q_model_threshold_sweep(spark, sf):
    """Threshold sweep of the fitted scorecard on the test splits."""
    t = RM.threshold_sweep(FittedScorecard(spark, sf).test, ["cohort"], "p_cal", "y")
    return rounded(t.withColumn("k", F.col("k").cast("int")), ["threshold", "tpr", "fpr"])


# ---------------------------------------------------------------------------
# Second pipeline
# ---------------------------------------------------------------------------

def second_pipeline_pool(spark: SparkSession, sf: str):
    """IV screen (floor convention, deciles, >= 0.02) then VIF removal on TRAIN."""
    prep = S.written_loans(spark, sf)
    train = S.train_rows(prep)
    enc = S.fit_scorecard_encoder(prep, convention="floor", closed="right", numeric=S.NUMERIC,
                                  categorical=[], discrete_max=0, floored="zeros")
    ranked = sorted(enc.bins.values(), key=lambda fb: (-fb.iv, fb.feature))
    selected = [fb.feature for fb in ranked if fb.iv >= IV_THRESHOLD]
    kept, removed = vif_elimination(train, selected, VIF_THRESHOLD)
    return prep, train, selected, kept, removed


@register("vif_select")
def q_vif_select(spark, sf):
    """Iterative removal of the highest VIF above 10 (one correlation job)."""
    prep, train, selected, kept, removed = second_pipeline_pool(spark, sf)
    rows = [(f, "kept", None, None) for f in kept] + [
        (f, "removed", step, v) for step, f, v in removed]
    out = spark.createDataFrame(rows, "feature string, status string, step int, vif double")
    return rounded(out, ["vif"])


def _scaled_folds(spark, sf):
    prep, train, selected, kept, removed = second_pipeline_pool(spark, sf)
    scaled = P.standardize(train.select("loan_id", "y", *kept), kept, population=True)
    folds = stratified_folds(scaled, "y", "loan_id", N_FOLDS, FOLD_SEED)
    return folds, kept, prep


@register("forward_logit")
def q_forward_logit(spark, sf):
    """Greedy forward search (10 steps, 5 folds, 0.5 Gini + 0.5 Brier skill)."""
    data, pool, _ = _scaled_folds(spark, sf)
    steps = M.forward_logistic(data, pool, MAX_FEATURES, N_FOLDS, 1.0, ALPHA)
    out = spark.createDataFrame(steps, "step int, feature string, cv_score double")
    return rounded(out, ["cv_score"])


# ---------------------------------------------------------------------------
# Boosted trees (second pipeline).  The registered keys fit on the VIF pool;
# the tree forward search that the reference runs first is its own key.
# ---------------------------------------------------------------------------

def _tree_data(spark, sf):
    prep, train, selected, kept, removed = second_pipeline_pool(spark, sf)
    tr = stratified_folds(train.select("loan_id", "y", *kept), "y", "loan_id", N_FOLDS,
                          FOLD_SEED)
    test = prep.where(F.col("cohort") != "TRAIN").select("loan_id", "y", *kept)
    return tr, test, kept, prep


def forward_gbt_query(spark, sf):
    """Greedy forward search with boosted trees (100 rounds, depth 4, 5 folds).

    Not registered: a step is a chain of 400 passes, and the search takes a
    step per feature.  ``operators.models.forward_gbt`` is tested instead.
    """
    tr, test, pool, _ = _tree_data(spark, sf)
    steps = M.forward_gbt(tr, pool, MAX_FEATURES, N_FOLDS, ALPHA)
    return rounded(spark.createDataFrame(steps, "step int, feature string, cv_score double"),
                   ["cv_score"])


@register("tune_pos_weight")
def q_tune_pos_weight(spark, sf):
    """Class-1 weight search {1, 5, 10, 20, 40, 60}: 3-fold CV score, train/test Gini."""
    tr, test, pool, _ = _tree_data(spark, sf)
    folds3 = stratified_folds(tr.drop("fold"), "y", "loan_id", TUNE_FOLDS, FOLD_SEED)
    rows = M.tune_pos_weight(folds3, test, pool, POS_WEIGHTS, TUNE_FOLDS, ALPHA)
    out = spark.createDataFrame(rows, "weight double, cv_score double, gini_train double, "
                                      "gini_test double")
    best = max(rows, key=lambda r: r[1])[0] if rows else None
    return rounded(out.withColumn("is_best", F.col("weight") == F.lit(best)),
                   ["cv_score", "gini_train", "gini_test"])


def _final_gbt(spark, sf, params=TREE_FINAL):
    tr, test, pool, prep = _tree_data(spark, sf)
    model = M.gbt(tr, pool, **params)
    return model, tr, test, pool, prep


@register("gbt_scores")
def q_gbt_scores(spark, sf):
    """Boosted trees, 300 rounds, depth 4, rate 0.05, row and column sampling 0.8."""
    model, tr, test, pool, prep = _final_gbt(spark, sf)
    out = M.predict_proba(model, prep, pool, ["loan_id", "cohort", "y"])
    return rounded(out, ["p"])


@register("gbt_importance")
def q_gbt_importance(spark, sf):
    """Feature importance of the final boosted model."""
    model, tr, test, pool, prep = _final_gbt(spark, sf)
    imp = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(pool, imp)]
    return rounded(spark.createDataFrame(rows, "feature string, importance double"),
                   ["importance"])


def _model_records(prep, train, pool) -> list[M.ModelRecord]:
    """The four model families: features and encoder of each, as data."""
    scaled = P.standardize(train.select("loan_id", "y", *pool), pool, population=True)
    folds = stratified_folds(scaled, "y", "loan_id", N_FOLDS, FOLD_SEED)
    chosen = tuple(f for _, f, _ in M.forward_logistic(folds, pool, MAX_FEATURES, N_FOLDS, 1.0, ALPHA))
    enc = S.fit_scorecard_encoder(prep, convention="floor", closed="right", numeric=list(chosen),
                                  categorical=[], discrete_max=0)
    return [M.ModelRecord("logit, L2, on WoE", chosen, enc, "l2"), M.ModelRecord("logit, L1, on WoE", chosen, enc, "l1"),
            # second-order trees on binned columns, and Spark ML's first-order ones
            M.ModelRecord("Boosted trees A", tuple(pool), None, "second_order"),
            M.ModelRecord("Boosted trees B", tuple(pool), None, "first_order")]


def _scores_of(record: M.ModelRecord, prep, train):
    """model, split, p, y of one record: fitted on TRAIN, applied to all loans."""
    split = F.when(F.col("cohort") == "TRAIN", "train").otherwise("test").alias("split")
    keep, features = ["cohort", "y"], list(record.features)
    rows, cols = prep.select("loan_id", *keep, *features), features
    if record.encoder is not None:
        rows = W.transform(prep, record.encoder, features, keep=keep)
        cols = [f"woe_{f}" for f in features]
    if record.kind == "second_order":
        forest = B.grow(train.select("loan_id", "y", *features).withColumn("fold", F.lit(0)), features,
                        [B.Spec(record.name, tuple(range(len(features))))], B.Settings(rounds=TREE_FINAL["max_iter"]),
                        "loan_id")
        scored = B.score(rows, forest, keep)
    else:
        known = rows.where(F.col("cohort") == "TRAIN") if record.encoder is not None else train
        model = (M.gbt(known, cols, **TREE_FINAL) if record.kind == "first_order"
                 else M.logistic(known, cols, "y", L1_C if record.kind == "l1" else 1.0, record.kind,
                                  penalise_intercept=record.kind == "l1"))
        scored = M.predict_proba(model, rows, cols, keep)
    return scored.select(F.lit(record.name).alias("model"), split, "p", "y")


@register("model_comparison")
def q_model_comparison(spark, sf):
    """Gini / Brier train, test and gaps, KS test, log-loss: four models; best by test Gini."""
    prep, train, selected, pool, removed = second_pipeline_pool(spark, sf)
    needed = [*pool, "loan_id", "cohort", "y", "vintage"]
    prep = materialize(prep.select(*needed), "model_loans")
    train = S.train_rows(prep)
    records = _model_records(prep, train, pool)
    with ThreadPoolExecutor(max_workers=len(records)) as ex:  # independent fits side by side
        parts = list(ex.map(lambda r: _scores_of(r, prep, train), records))
    scored = materialize(reduce(DataFrame.unionByName, parts), "model_scores")
    out = M.evaluate(scored, [r.name for r in records])
    return rounded(out, ["gini_train", "gini_test", "gini_gap", "brier_train", "brier_test", "brier_gap", "ks_test",
                         "log_loss"])
