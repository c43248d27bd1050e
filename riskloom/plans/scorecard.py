"""The scorecard pipeline on the ``loan`` stand-in, as composable DataFrames.

Stages mirror the reference's first pipeline: flags before imputation,
per-vintage median imputation, derived ratios, cohorts, WoE/IV fitted on
TRAIN, a scorecard score, calibration of the intercept to the TRAIN default
rate, and a master-scale grade.  Continuous derived features are rounded to
6 decimals (a fixed grid) so bins are identical in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import annuity, clip_lower, dbl, grade_label, logit, round_double, sigmoid
from ..operators import woe as W
from ..operators.calibration import newton_offset
from ..operators.prep import cohort_column, impute_constant, impute_median, missing_flags
from ..session import materialize_once
from ..sources.tables import LOAN_TABLES, loan_view, table_path

# Stand-in configuration (FIXTURES.md section 4).
TRAIN_VINTAGES = ["1995H1", "1995H2", "1996H1", "1996H2", "1997H1", "1997H2", "1998H1",
                  "1998H2"]
VAL_VINTAGES = ["1999H1", "1999H2"]
OOT_FROM = "2000H1"
FLAGS = {"acctbal_missing": "acctbal", "lines_missing": "avg_qty"}
MEDIAN_IMPUTED = ["acctbal", "avg_qty", "avg_tax"]
CONSTANT_IMPUTED = {"n_lines": 0, "max_disc": 0.0}
NUMERIC = ["loan_amount", "acctbal", "n_lines", "avg_qty", "max_disc", "avg_tax", "n_returns",
           "loan_to_income", "payment_to_income", "log_loan_amount", "acctbal_missing",
           "lines_missing"]
CONTINUOUS = ["loan_amount", "acctbal", "avg_qty", "max_disc", "avg_tax", "loan_to_income",
              "payment_to_income"]
CATEGORICAL = ["segment", "priority"]
# Literal scorecard weights on WoE columns (WoE high = safe, so negative),
# used where a fitted model would make downstream checks depend on a solver.
SCORE_INTERCEPT = -1.75
SCORE_WEIGHTS = {"n_returns": -0.9, "acctbal": -0.8, "n_lines": -0.6, "max_disc": -0.7,
                 "loan_amount": -0.6, "priority": -0.5, "segment": -0.4}
SCORE_DECIMALS = 9
EDGE_DECIMALS = WOE_DECIMALS = 9
MEDIAN_DECIMALS = 6
CALIBRATION_STEPS = 8
BAD_PERIOD = 1996


# the variable dictionary of the stand-in
DICTIONARY = {
    "loan_amount": "Total price of the order", "acctbal": "Account balance of the customer",
    "n_lines": "Lines of the order", "avg_qty": "Mean quantity of a line", "max_disc": "Largest discount of a line",
    "avg_tax": "Mean tax of a line", "n_returns": "Returned lines", "loan_to_income": "Amount over balance",
    "payment_to_income": "Yearly annuity over balance", "segment": "Market segment of the customer",
    "priority": "Priority of the order"}


def derive(df: DataFrame) -> DataFrame:
    """Term, rate, annuity payment, ratios and logs (after imputation)."""
    inc = clip_lower(F.col("acctbal"), 1.0)
    d = df.withColumns({
        "term": F.when(F.col("n_lines") > 4, F.lit(60)).otherwise(F.lit(36)),
        "rate_pct": dbl(8) + dbl(100) * F.col("avg_tax"),
    })
    d = d.withColumn("payment", annuity(F.col("loan_amount"), F.col("rate_pct"), F.col("term")))
    d = d.withColumn("payment", round_double(F.col("payment"), 6)).withColumns({
        "loan_to_income": F.col("loan_amount") / inc,
        "payment_to_income": F.col("payment") * dbl(12) / inc,
        "log_loan_amount": F.log1p(F.col("loan_amount")),
    })
    return d.withColumns({c: round_double(F.col(c), 6) for c in ("loan_to_income", "payment_to_income", "log_loan_amount")})


def with_cohort(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "cohort": cohort_column(F.col("vintage"), TRAIN_VINTAGES, VAL_VINTAGES, OOT_FROM),
        "period": F.substring("vintage", 1, 4).cast("int"),
    })


def prepared_loans(spark: SparkSession, sf_dir: str, exact: bool = True,
                   materialized: bool = True) -> DataFrame:
    """Flags, per-vintage median imputation and derived features.

    The loan table is written to the shared folder (``materialized``), once per
    application and version of the source tables, so the median, edge, WoE and
    calibration actions that follow re-read it instead of re-joining the source
    tables each time.
    """
    if materialized:
        loan = materialize_once(spark, "loan", [table_path(sf_dir, t) for t in LOAN_TABLES],
                                lambda: loan_view(spark, sf_dir))
    else:
        loan = loan_view(spark, sf_dir)
    df = with_cohort(loan)
    df = missing_flags(df, FLAGS)
    df = impute_median(df, MEDIAN_IMPUTED, ["vintage"], exact=exact, decimals=MEDIAN_DECIMALS)
    df = impute_constant(df, CONSTANT_IMPUTED)
    return derive(df)


def written_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prepared_loans``, written once per application and version of the source tables.

    For fits that scan them many times: medians are joined and features derived once.
    """
    return materialize_once(spark, "prepared", [table_path(sf_dir, t) for t in LOAN_TABLES],
                            lambda: prepared_loans(spark, sf_dir))


def train_rows(prepared: DataFrame) -> DataFrame:
    # on vintage, not the derived cohort, so the predicate reaches the scan
    return prepared.where(F.col("vintage").isin(TRAIN_VINTAGES))


def fit_scorecard_encoder(prepared: DataFrame, convention: str = "smoothed",
                          closed: str = "left", numeric=None, categorical=None,
                          discrete_max: int = 8, floored: str = "all") -> W.Encoder:
    return W.fit_encoder(train_rows(prepared), numeric or NUMERIC,
                         CATEGORICAL if categorical is None else categorical, "y",
                         convention=convention, closed=closed, discrete_max=discrete_max, floored=floored,
                         edge_decimals=EDGE_DECIMALS, woe_decimals=WOE_DECIMALS)


def fixed_score(prepared: DataFrame, enc: W.Encoder, keep=("loan_id", "cohort", "y")) -> DataFrame:
    """p = sigmoid(b0 + sum w_j * woe_j) with literal weights, 9 decimals."""
    wide = W.transform(prepared, enc, list(SCORE_WEIGHTS), "_rl_woe_", keep)
    z = dbl(SCORE_INTERCEPT)
    for f, w in SCORE_WEIGHTS.items():
        z = z + dbl(w) * F.col(f"_rl_woe_{f}")
    scored = wide.select(*keep, sigmoid(z).alias("p"))
    return scored.withColumn("p", round_double(F.col("p"), SCORE_DECIMALS))


def calibrated(scored: DataFrame, offset: float) -> DataFrame:
    return scored.withColumn("p_cal", sigmoid(logit(F.col("p")) + dbl(offset))).withColumn(
        "p_cal", round_double(F.col("p_cal"), SCORE_DECIMALS))


def graded(scored_cal: DataFrame) -> DataFrame:
    return scored_cal.withColumn("grade", grade_label(F.col("p_cal")))


def fitted(spark: SparkSession, sf_dir: str):
    """(prepared, encoder, scored, offset) for a table set.

    The encoder and offset are small driver-side values fitted by actions; the
    DataFrames stay lazy, so every query still reads the whole tables.
    """
    prep = prepared_loans(spark, sf_dir)
    enc = fit_scorecard_encoder(prep)
    scored = fixed_score(prep, enc)
    train = fixed_score(train_rows(prep), enc)
    offset = newton_offset(train, "p", "y", steps=CALIBRATION_STEPS)
    return prep, enc, scored, round(offset, SCORE_DECIMALS)


def scoring_pipeline(enc: W.Encoder, offset: float):
    """The fixed scorecard as a ``PipelineModel``: WoE, score, calibration and grade of prepared loans."""
    from pyspark.ml import PipelineModel

    from ..operators.saved import ScoreStage, WoeStage
    weights = {f"_rl_woe_{f}": w for f, w in SCORE_WEIGHTS.items()}
    return PipelineModel([WoeStage(enc, list(SCORE_WEIGHTS), "_rl_woe_"),
                          ScoreStage(weights, SCORE_INTERCEPT, offset, decimals=SCORE_DECIMALS)])


def scored_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep, enc, scored, offset = fitted(spark, sf_dir)
    return graded(calibrated(scored, offset))
