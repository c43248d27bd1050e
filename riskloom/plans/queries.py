"""Registered queries: one Spark DataFrame builder per operator key, plus the
matching oracle SQL where the operator is SQL-expressible.

Every query reads the whole given tables (through the ``loan`` stand-in view
or directly) and returns a lazy DataFrame; fitted state (edges, WoE, offset)
comes from actions on those tables inside the call.  Floating outputs are
rounded to 6 decimals and counts are bigint in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.expr import iv_strength, r6, IV_THRESHOLD
from ..operators import prep as P
from ..operators import woe as W
from ..sources.tables import loan_view
from . import oracle as O
from . import scorecard as S

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in cols})


# ---------------------------------------------------------------------------
# Step 1: view, cohorts, basics
# ---------------------------------------------------------------------------

LOAN_COLS = "loan_id, vintage, loan_amount, acctbal, segment, priority, n_lines, avg_qty, " \
            "max_disc, avg_tax, n_returns, y"


@register("loan_view", lambda: O.base(prep=False) + f"\nSELECT {LOAN_COLS} FROM loan")
def q_loan_view(spark, sf):
    return loan_view(spark, sf)


@register("cohort_split", lambda: O.base(prep=False) + f"""
SELECT loan_id, vintage, {O.cohort_case()} AS cohort, y FROM loan""")
def q_cohort_split(spark, sf):
    return S.with_cohort(loan_view(spark, sf)).select("loan_id", "vintage", "cohort", "y")


@register("default_rate_by_vintage", lambda: O.base(prep=False) + """
SELECT coalesce(vintage, 'ALL') AS vintage, count(*) AS n, CAST(sum(y) AS BIGINT) AS defaults,
       round(avg(y), 6) AS default_rate
FROM loan GROUP BY ROLLUP (vintage)""")
def q_default_rate_by_vintage(spark, sf):
    t = loan_view(spark, sf).rollup("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("defaults"),
        F.avg("y").alias("default_rate"))
    return rounded(t.withColumn("vintage", F.coalesce("vintage", F.lit("ALL"))), ["default_rate"])


@register("vintage_counts", lambda: O.base(prep=False) + """
SELECT vintage, count(*) AS n, (SELECT count(DISTINCT vintage) FROM loan) AS n_vintages
FROM loan GROUP BY vintage""")
def q_vintage_counts(spark, sf):
    counts = loan_view(spark, sf).groupBy("vintage").agg(F.count(F.lit(1)).alias("n"))
    # the number of vintages is the row count of the (small) per-vintage table
    return counts.withColumn("n_vintages", F.count(F.lit(1)).over(Window.partitionBy()))


@register("project_features", lambda: O.base(prep=False) + """
SELECT loan_amount, acctbal, segment, priority, n_lines, avg_qty, max_disc, avg_tax, n_returns
FROM loan""")
def q_project_features(spark, sf):
    df = loan_view(spark, sf)
    return df.drop("loan_id", "vintage", "y")


@register("drop_bad_period", lambda: O.base() + f"""
SELECT loan_id, period FROM prep WHERE period IS DISTINCT FROM {S.BAD_PERIOD}""")
def q_drop_bad_period(spark, sf):
    df = S.with_cohort(loan_view(spark, sf))
    return P.drop_period(df, "period", S.BAD_PERIOD).select("loan_id", "period")


@register("missing_flags", lambda: O.base() + """
SELECT loan_id, acctbal_missing, lines_missing FROM prep""")
def q_missing_flags(spark, sf):
    return P.missing_flags(loan_view(spark, sf), S.FLAGS).select(
        "loan_id", *S.FLAGS.keys())


MISSING_SCAN = ["loan_amount", "acctbal", "segment", "priority", "n_lines", "avg_qty", "max_disc",
                "avg_tax", "n_returns"]


@register("missing_counts", lambda: O.base(prep=False) + "\nSELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM loan"
    for c in MISSING_SCAN) + ") WHERE n_missing > 0")
def q_missing_counts(spark, sf):
    return P.missing_counts(loan_view(spark, sf), MISSING_SCAN)


@register("impute_constant", lambda: O.base() + """
SELECT loan_id, n_lines, max_disc FROM prep""")
def q_impute_constant(spark, sf):
    return P.impute_constant(loan_view(spark, sf), S.CONSTANT_IMPUTED).select(
        "loan_id", "n_lines", "max_disc")


# ---------------------------------------------------------------------------
# Step 2: bins, WoE, IV
# ---------------------------------------------------------------------------

def _enc(spark, sf, **kw):
    return S.fit_scorecard_encoder(S.prepared_loans(spark, sf), **kw)


@register("quantile_edges", lambda: O.base(*O.edge_ctes(S.NUMERIC)) + """
SELECT feature, CAST(unnest(range(0, len(edges))) AS BIGINT) AS edge_ix,
       round(unnest(edges), 6) AS edge
FROM ed WHERE type = 'numeric'""")
def q_quantile_edges(spark, sf):
    enc = _enc(spark, sf, categorical=[])
    rows = [(f, i, e) for f, fb in enc.bins.items() if fb.kind == "numeric"
            for i, e in enumerate(fb.edges)]
    # edges are the fitted state (<= 9 per feature) collected by the fit
    out = spark.createDataFrame(rows, "feature string, edge_ix bigint, edge double")
    return rounded(out, ["edge"])


@register("bin_counts", lambda: O.base(*O.scorecard_woe_ctes()) + """
SELECT feature, type, bin, n, n_pos FROM wb""")
def q_bin_counts(spark, sf):
    enc = _enc(spark, sf)
    return enc.table.select("feature", "type", F.col("bin").cast("bigint").alias("bin"), "n",
                            "n_pos")


@register("woe_bins", lambda: O.base(*O.scorecard_woe_ctes()) + """
SELECT feature, type, bin, n, n_pos, n_neg, round(woe, 6) AS woe, round(iv_part, 6) AS iv_part
FROM wb""")
def q_woe_bins(spark, sf):
    enc = _enc(spark, sf)
    t = enc.table.select("feature", "type", F.col("bin").cast("bigint").alias("bin"), "n",
                         "n_pos", "n_neg", "woe", "iv_part")
    return rounded(t, ["woe", "iv_part"])


def _floor_ctes():
    p = "f_"
    edges = O.edge_ctes(S.CONTINUOUS, prefix=p, discrete_max=0)
    return [*edges,
            f"""{p}tb AS (SELECT t.feature, t.y, len(list_filter(e.edges, lambda x: x < t.value)) AS bin
                FROM {p}tl t JOIN {p}ed e ON t.feature = e.feature)""",
            f"""{p}cn AS (SELECT feature, bin, count(*) AS n, sum(y) AS n_pos FROM {p}tb
                GROUP BY feature, bin)""",
            f"""{p}sp AS (SELECT feature, unnest(range(0, len(edges) + 1)) AS bin FROM {p}ed)""",
            f"""{p}ca AS (SELECT sp.feature, CAST(sp.bin AS BIGINT) AS bin, coalesce(cn.n, 0) AS n,
                coalesce(cn.n_pos, 0) AS n_pos FROM {p}sp sp LEFT JOIN {p}cn cn
                ON sp.feature = cn.feature AND sp.bin = cn.bin)""",
            f"""{p}tt AS (SELECT feature, sum(n_pos) AS P, sum(n - n_pos) AS N FROM {p}ca
                GROUP BY feature)""",
            f"""{p}sh AS (SELECT a.*, a.n - a.n_pos AS n_neg, t.P, t.N,
                greatest(CASE WHEN t.P > 0 THEN a.n_pos / t.P END, CAST(1e-6 AS double)) AS s_pos,
                greatest(CASE WHEN t.N > 0 THEN (a.n - a.n_pos) / t.N END, CAST(1e-6 AS double)) AS s_neg
                FROM {p}ca a JOIN {p}tt t ON a.feature = t.feature)""",
            f"""{p}wb AS (SELECT feature, bin, n, n_pos, n_neg,
                CASE WHEN P = 0 OR N = 0 THEN CAST(0 AS double) ELSE round(ln(s_pos / s_neg), 9) END AS woe,
                CASE WHEN P = 0 OR N = 0 OR n = 0 THEN CAST(0 AS double)
                     ELSE (s_pos - s_neg) * ln(s_pos / s_neg) END AS iv_part FROM {p}sh)"""]


@register("woe_bins_floor", lambda: O.base(*_floor_ctes()) + """
SELECT feature, bin, n, n_pos, n_neg, round(woe, 6) AS woe, round(iv_part, 6) AS iv_part,
       round(sum(iv_part) OVER (PARTITION BY feature), 6) AS iv
FROM f_wb""")
def q_woe_bins_floor(spark, sf):
    enc = S.fit_scorecard_encoder(S.prepared_loans(spark, sf), convention="floor",
                                  closed="right", numeric=S.CONTINUOUS, categorical=[],
                                  discrete_max=0)
    w = Window.partitionBy("feature")
    t = enc.table.select("feature", F.col("bin").cast("bigint").alias("bin"), "n", "n_pos",
                         "n_neg", "woe", "iv_part", F.sum("iv_part").over(w).alias("iv"))
    return rounded(t, ["woe", "iv_part", "iv"])


@register("woe_discrete", lambda: O.base(*O.scorecard_woe_ctes(), """
dv AS (SELECT feature, bin, min(value) AS value FROM tb WHERE type = 'discrete_numeric'
       GROUP BY feature, bin)""") + """
SELECT wb.feature, wb.bin, dv.value, wb.n, wb.n_pos, round(wb.woe, 6) AS woe
FROM wb JOIN dv ON wb.feature = dv.feature AND wb.bin = dv.bin""")
def q_woe_discrete(spark, sf):
    enc = _enc(spark, sf, categorical=[])
    t = enc.table.where(F.col("type") == "discrete_numeric").select(
        "feature", F.col("bin").cast("bigint").alias("bin"), F.col("lo").alias("value"), "n",
        "n_pos", "woe")
    return rounded(t, ["woe"])


@register("woe_categorical", lambda: O.base(*O.scorecard_woe_ctes(), """
cl AS (SELECT feature, level, dense_rank() OVER (PARTITION BY feature ORDER BY level) - 1 AS bin
       FROM (SELECT DISTINCT feature, level FROM tc))""") + """
SELECT wb.feature, wb.bin, cl.level, wb.n, wb.n_pos, round(wb.woe, 6) AS woe
FROM wb JOIN cl ON wb.feature = cl.feature AND wb.bin = cl.bin WHERE wb.type = 'categorical'""")
def q_woe_categorical(spark, sf):
    enc = _enc(spark, sf, numeric=["n_returns"])
    t = enc.table.where(F.col("type") == "categorical").select(
        "feature", F.col("bin").cast("bigint").alias("bin"), "level", "n", "n_pos", "woe")
    return rounded(t, ["woe"])


def iv_table_frame(enc: W.Encoder) -> DataFrame:
    iv = enc.iv_frame()
    w = Window.orderBy(F.round("iv", 9).desc(), "feature")
    return iv.select(
        "feature", "type", r6(F.col("iv")).alias("iv"),
        F.row_number().over(w).cast("bigint").alias("iv_rank"),
        (F.col("iv") >= IV_THRESHOLD).cast("int").alias("selected"),
        iv_strength(F.col("iv")).alias("strength"))


IV_SQL_TAIL = f"""
SELECT feature, type, round(iv, 6) AS iv,
       CAST(row_number() OVER (ORDER BY round(iv, 9) DESC, feature) AS BIGINT) AS iv_rank,
       CAST(iv >= {IV_THRESHOLD} AS INTEGER) AS selected,
       CASE WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium'
            WHEN iv < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength
FROM (SELECT feature, type, sum(iv_part) AS iv FROM wb GROUP BY feature, type)"""


@register("iv_table", lambda: O.base(*O.scorecard_woe_ctes()) + IV_SQL_TAIL)
def q_iv_table(spark, sf):
    """Flagship: IV of every feature on TRAIN, ranked, screened at 0.02."""
    # the ranking window runs over one row per feature (a handful)
    return iv_table_frame(_enc(spark, sf))


@register("iv_dictionary", lambda: O.base(*O.scorecard_woe_ctes(), "iv AS (" + IV_SQL_TAIL + ")") + """
SELECT iv.feature, iv.type, iv.iv, iv.iv_rank, v.description FROM iv LEFT JOIN (VALUES """ + ", ".join(
    f"({O.q(f)}, {O.q(d)})" for f, d in S.DICTIONARY.items()) + """) AS v(feature, description)
ON iv.feature = v.feature""")
def q_iv_dictionary(spark, sf):
    """IV table with the texts of a variable dictionary read from a delimited file."""
    from ..session import scratch_path
    from ..sources.files import describe, read_dictionary, write_csv
    path = write_csv(spark.createDataFrame(list(S.DICTIONARY.items()), "feature string, description string"),
                     scratch_path(spark, "dictionary"))
    iv = iv_table_frame(_enc(spark, sf)).select("feature", "type", "iv", "iv_rank")
    return describe(iv, read_dictionary(spark, path))


# ---------------------------------------------------------------------------
# Step 3: preparation
# ---------------------------------------------------------------------------

@register("impute_group_median", lambda: O.base() + """
SELECT loan_id, vintage, round(acctbal, 6) AS acctbal, round(avg_qty, 6) AS avg_qty,
       round(avg_tax, 6) AS avg_tax FROM prep""")
def q_impute_group_median(spark, sf):
    df = P.impute_median(loan_view(spark, sf), S.MEDIAN_IMPUTED, ["vintage"],
                         decimals=S.MEDIAN_DECIMALS)
    return rounded(df.select("loan_id", "vintage", *S.MEDIAN_IMPUTED), S.MEDIAN_IMPUTED)


GLOBAL_IMPUTED = ["acctbal", "n_lines", "avg_qty", "max_disc", "avg_tax"]


@register("impute_global_median", lambda: O.base(prep=False) + """
, gm AS (SELECT """ + ", ".join(f"round(quantile_cont({c}, 0.5), 6) AS m_{c}" for c in GLOBAL_IMPUTED)
    + """ FROM loan)
SELECT loan_id, """ + ", ".join(f"round(coalesce(CAST({c} AS double), m_{c}), 6) AS {c}"
                                for c in GLOBAL_IMPUTED) + " FROM loan, gm")
def q_impute_global_median(spark, sf):
    """Second pipeline: one median per column over all rows, before the split."""
    loan = loan_view(spark, sf)
    cols = [c for c in GLOBAL_IMPUTED]
    df = P.impute_median(loan, cols, decimals=S.MEDIAN_DECIMALS)
    return rounded(df.select("loan_id", *cols), cols)


@register("ratios", lambda: O.base() + """
SELECT loan_id, loan_to_income, payment_to_income FROM prep""")
def q_ratios(spark, sf):
    return S.prepared_loans(spark, sf).select("loan_id", "loan_to_income", "payment_to_income")


@register("annuity_payment", lambda: O.base() + """
SELECT loan_id, term, round(rate_pct, 6) AS rate_pct, payment FROM prep""")
def q_annuity_payment(spark, sf):
    return rounded(S.prepared_loans(spark, sf).select("loan_id", "term", "rate_pct", "payment"),
                   ["rate_pct"])


@register("log_features", lambda: O.base() + """
SELECT loan_id, log_loan_amount FROM prep""")
def q_log_features(spark, sf):
    return S.prepared_loans(spark, sf).select("loan_id", "log_loan_amount")


LOGIT_SHIFT = 0.5


@register("logit_shift", lambda: O.base(*O.scored_ctes()) + f"""
SELECT loan_id, p, round(z, 6) AS logit_p,
       round(CAST(1 AS double) / (CAST(1 AS double) + exp(-(z + {O.d(LOGIT_SHIFT)}))), 6) AS p_shift
FROM lz""")
def q_logit_shift(spark, sf):
    from ..functions.expr import logit, sigmoid, dbl
    prep = S.prepared_loans(spark, sf)
    enc = S.fit_scorecard_encoder(prep)
    sc = S.fixed_score(prep, enc)
    z = logit(F.col("p"))
    return sc.select("loan_id", "p", r6(z).alias("logit_p"),
                     r6(sigmoid(z + dbl(LOGIT_SHIFT))).alias("p_shift"))


STD_COLS = ["loan_amount", "acctbal", "avg_qty"]


@register("standardize", lambda: O.base("st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_samp({c}) = 0 OR stddev_samp({c}) IS NULL THEN 1 "
    f"ELSE stddev_samp({c}) END AS s_{c}" for c in STD_COLS) + " FROM prep)") + """
SELECT loan_id, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS z_{c}" for c in STD_COLS)
    + " FROM prep, st")
def q_standardize(spark, sf):
    prep = S.prepared_loans(spark, sf)
    z = P.standardize(prep, STD_COLS)
    return z.select("loan_id", *[r6(F.col(c)).alias(f"z_{c}") for c in STD_COLS])


@register("standardize_pop", lambda: O.base("st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1 "
    f"ELSE stddev_pop({c}) END AS s_{c}" for c in STD_COLS) + " FROM prep WHERE cohort = 'TRAIN')") + """
SELECT loan_id, """ + ", ".join(f"round(coalesce(({c} - m_{c}) / s_{c}, 0), 6) AS z_{c}"
                                for c in STD_COLS) + " FROM prep, st WHERE cohort = 'TRAIN'")
def q_standardize_pop(spark, sf):
    """Second pipeline scaler: population deviation on TRAIN, NULL/inf -> 0."""
    tr = S.train_rows(S.prepared_loans(spark, sf))
    z = P.standardize(tr, STD_COLS, population=True)
    return z.select("loan_id", *[r6(F.col(c)).alias(f"z_{c}") for c in STD_COLS])


RAW_NUMERIC = ["loan_amount", "acctbal", "n_lines", "avg_qty", "max_disc", "avg_tax", "n_returns"]


@register("drop_unusable_columns", lambda: O.base(prep=False, *[
    "lg AS (" + O.union_long(RAW_NUMERIC, "CAST({c} AS double)", "TRUE", "loan",
                             "loan_id") + ")"]) + """
SELECT loan_id, feature AS column_name, value FROM lg WHERE feature IN
  (SELECT feature FROM lg GROUP BY feature HAVING count(*) = count(value))""")
def q_drop_unusable_columns(spark, sf):
    loan = loan_view(spark, sf)
    clean = P.drop_unusable_columns(loan.select("loan_id", *RAW_NUMERIC), RAW_NUMERIC)
    kept = [c for c in RAW_NUMERIC if c in clean.columns]
    return clean.select("loan_id", *[F.col(c).cast("double") for c in kept]).unpivot(
        ["loan_id"], kept, "column_name", "value")


# ---------------------------------------------------------------------------
# Step 4: encode, score, grade, stability
# ---------------------------------------------------------------------------

def _selected(enc: W.Encoder) -> list[str]:
    return [f for f, fb in enc.bins.items() if fb.iv >= IV_THRESHOLD]


@register("woe_transform", lambda: O.base(*O.scorecard_woe_ctes(), *O.all_rows_woe_ctes(
    S.NUMERIC + S.CATEGORICAL, S.CATEGORICAL)) + """
SELECT loan_id, feature, round(woe, 6) AS woe FROM aw WHERE feature IN
  (SELECT feature FROM wb GROUP BY feature HAVING sum(iv_part) >= 0.02)""")
def q_woe_transform(spark, sf):
    """Every loan (all cohorts) encoded on the IV-selected features (long form)."""
    prep = S.prepared_loans(spark, sf)
    enc = S.fit_scorecard_encoder(prep)
    feats = _selected(enc)
    wide = W.transform(prep, enc, feats, keep=["loan_id"])
    return wide.unpivot(["loan_id"], [f"woe_{f}" for f in feats], "feature", "woe").select(
        "loan_id", F.expr("substring(feature, 5)").alias("feature"), r6(F.col("woe")).alias("woe"))


@register("woe_transform_right", lambda: O.base(*_floor_ctes(), f"""
f_al AS ({O.union_long(S.CONTINUOUS, 'CAST({c} AS double)', "cohort <> 'TRAIN'", extra_cols='loan_id')})""") + """
SELECT a.loan_id, a.feature, round(w.woe, 6) AS woe FROM f_al a JOIN f_ed e ON a.feature = e.feature
JOIN f_wb w ON w.feature = a.feature AND w.bin = least(len(list_filter(e.edges, lambda x: x < a.value)), len(e.edges))""")
def q_woe_transform_right(spark, sf):
    """Second pipeline: right-closed bins fitted on TRAIN applied to VAL/OOT."""
    prep = S.prepared_loans(spark, sf)
    enc = S.fit_scorecard_encoder(prep, convention="floor", closed="right",
                                  numeric=S.CONTINUOUS, categorical=[], discrete_max=0)
    test = prep.where(F.col("cohort") != "TRAIN")
    wide = W.transform(test, enc, S.CONTINUOUS, keep=["loan_id"])
    return wide.unpivot(["loan_id"], [f"woe_{f}" for f in S.CONTINUOUS], "feature", "woe").select(
        "loan_id", F.expr("substring(feature, 5)").alias("feature"), r6(F.col("woe")).alias("woe"))


@register("score_fixed", lambda: O.base(*O.scored_ctes()) + """
SELECT loan_id, cohort, y, p FROM sc""")
def q_score_fixed(spark, sf):
    prep = S.prepared_loans(spark, sf)
    return S.fixed_score(prep, S.fit_scorecard_encoder(prep))


@register("assign_grade", lambda: O.base(*O.scored_ctes()) + """
SELECT loan_id, cohort, p_cal, grade FROM gr""")
def q_assign_grade(spark, sf):
    return S.scored_calibrated(spark, sf).select("loan_id", "cohort", "p_cal", "grade")


@register("saved_scorecard", lambda: O.base(*O.scored_ctes()) + """
SELECT loan_id, cohort, p, p_cal, grade FROM gr""")
def q_saved_scorecard(spark, sf):
    """Scores of a pipeline that was saved and loaded again."""
    from pyspark.ml import PipelineModel

    from ..session import scratch_path
    prep, enc, _, offset = S.fitted(spark, sf)
    path = scratch_path(spark, "scorecard")
    S.scoring_pipeline(enc, offset).write().save(path)
    return PipelineModel.load(path).transform(prep).select("loan_id", "cohort", "p", "p_cal", "grade")


@register("grade_table", lambda: O.base(*O.scored_ctes(), """
spine AS (SELECT s AS split, g AS grade FROM (SELECT unnest(['TRAIN', 'VAL', 'OOT']) AS s),
          (SELECT unnest(""" + "[" + ", ".join(O.q(x) for x in __import__(
    "riskloom.functions.expr", fromlist=["GRADE_LABELS"]).GRADE_LABELS) + """]) AS g))""",
    """gt AS (SELECT spine.split, spine.grade, count(gr.loan_id) AS n,
          CAST(coalesce(sum(gr.y), 0) AS BIGINT) AS defaults,
          coalesce(avg(CAST(gr.y AS double)), 0) AS obs_dr, coalesce(avg(gr.p_cal), 0) AS pred_pd
          FROM spine LEFT JOIN gr ON gr.cohort = spine.split AND gr.grade = spine.grade
          GROUP BY spine.split, spine.grade)""") + """
SELECT split, grade, n, defaults, round(obs_dr, 6) AS obs_dr, round(pred_pd, 6) AS pred_pd,
       round(n / sum(n) OVER (PARTITION BY split), 6) AS population_pct FROM gt""")
def q_grade_table(spark, sf):
    from ..operators.calibration import grade_table
    g = S.scored_calibrated(spark, sf)
    t = grade_table(spark, g, "cohort", "grade", "p_cal", "y", ["TRAIN", "VAL", "OOT"])
    return rounded(t.drop("grade_ix"), ["obs_dr", "pred_pd", "population_pct"])


@register("psi_grades", lambda: O.base(*O.scored_ctes(), """
gsh AS (SELECT cohort, grade, count(*) / sum(count(*)) OVER (PARTITION BY cohort) AS share
       FROM gr GROUP BY cohort, grade)""") + """
SELECT 'TRAIN' AS expected_split, a.cohort AS actual_split,
       round(sum((a.share - e.share) * ln(a.share / e.share)), 6) AS psi
FROM gsh e JOIN gsh a ON e.grade = a.grade WHERE e.cohort = 'TRAIN' AND a.cohort IN ('VAL', 'OOT')
GROUP BY a.cohort""")
def q_psi_grades(spark, sf):
    from ..operators.stability import psi_grades
    g = S.scored_calibrated(spark, sf)
    return rounded(psi_grades(g, "cohort", "grade", "TRAIN", ["VAL", "OOT"]), ["psi"])


def _psi_feature_sql():
    p = "g_"
    feats = S.CONTINUOUS
    return O.base(*O.edge_ctes(feats, prefix=p, discrete_max=0), f"""
{p}al AS ({O.union_long(feats, 'CAST({c} AS double)', "cohort IN ('TRAIN', 'VAL', 'OOT')", extra_cols='cohort')})""",
                  f"""{p}bn AS (SELECT a.cohort, a.feature,
        len(list_filter(e.edges, lambda x: x < a.value)) AS bin FROM {p}al a JOIN {p}ed e
        ON a.feature = e.feature
        WHERE a.value > e.mn - CAST(1e-9 AS double) AND a.value <= e.mx + CAST(1e-9 AS double))""",
                  f"""{p}sh AS (SELECT cohort, feature, bin,
        count(*) / sum(count(*)) OVER (PARTITION BY cohort, feature) AS share
        FROM {p}bn GROUP BY cohort, feature, bin)""",
                  f"""{p}sp AS (SELECT o.s AS actual_split, feature, unnest(range(0, len(edges) + 1)) AS bin
        FROM {p}ed, (SELECT unnest(['VAL', 'OOT']) AS s) o)""") + f"""
SELECT 'TRAIN' AS expected_split, sp.actual_split, sp.feature,
       round(sum((greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) - greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))
           * ln(greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) / greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))), 6) AS psi,
       CASE WHEN sum((greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) - greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))
           * ln(greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) / greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))) < 0.1 THEN 'stable'
            WHEN sum((greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) - greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))
           * ln(greatest(coalesce(a.share, 0), CAST(1e-6 AS double)) / greatest(coalesce(e.share, 0), CAST(1e-6 AS double)))) < 0.25 THEN 'moderate'
            ELSE 'shift' END AS verdict
FROM {p}sp sp LEFT JOIN {p}sh e ON e.cohort = 'TRAIN' AND e.feature = sp.feature AND e.bin = sp.bin
LEFT JOIN {p}sh a ON a.cohort = sp.actual_split AND a.feature = sp.feature AND a.bin = sp.bin
GROUP BY sp.actual_split, sp.feature"""


@register("psi_features", _psi_feature_sql)
def q_psi_features(spark, sf):
    from ..operators.stability import psi_features
    prep = S.prepared_loans(spark, sf)
    t = psi_features(prep, S.CONTINUOUS, "cohort", "TRAIN", ["VAL", "OOT"],
                     edge_decimals=S.EDGE_DECIMALS)
    return rounded(t, ["psi"])


@register("psi_rank", lambda: f"""
SELECT actual_split, feature, psi, verdict,
       row_number() OVER (PARTITION BY actual_split ORDER BY psi DESC, feature) AS psi_rank
FROM ({_psi_feature_sql()})""")
def q_psi_rank(spark, sf):
    """Features by PSI per split, largest first (one row a feature and split)."""
    w = Window.partitionBy("actual_split").orderBy(F.col("psi").desc(), "feature")
    return q_psi_features(spark, sf).select("actual_split", "feature", "psi", "verdict",
                                            F.row_number().over(w).cast("bigint").alias("psi_rank"))


# ---------------------------------------------------------------------------
# Step 5: rank metrics, losses, curves (on the calibrated score per cohort)
# ---------------------------------------------------------------------------

def _cal(spark, sf):
    return S.scored_calibrated(spark, sf)


RANK_CTES = ["""sd AS (SELECT cohort, p_cal AS score, sum(y) AS pos, sum(1 - y) AS neg
      FROM gr GROUP BY cohort, p_cal)""",
             """cu AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
      sum(pos) OVER (PARTITION BY cohort) AS P, sum(neg) OVER (PARTITION BY cohort) AS N
      FROM sd WINDOW w AS (PARTITION BY cohort ORDER BY score DESC
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
             """rs AS (SELECT cohort,
      sum(CAST(neg AS double) * (CAST(tp - pos AS double) + CAST(pos AS double) / 2))
          / (CAST(max(P) AS double) * CAST(max(N) AS double)) AS auc,
      greatest(max(tp / P - fp / N), 0) AS ks,
      greatest(max(abs(tp / P - fp / N)), 0) AS ks_two_sided,
      sum(CAST(pos AS double) * CAST(tp AS double) / CAST(tp + fp AS double)) / max(P) AS ap
      FROM cu GROUP BY cohort)"""]


def _rank(spark, sf):
    from ..operators.rank_metrics import cumulative, rank_summary
    return rank_summary(cumulative(_cal(spark, sf), ["cohort"], "p_cal", "y"), ["cohort"])


@register("auc_gini", lambda: O.base(*O.scored_ctes(), *RANK_CTES) + """
SELECT cohort, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini FROM rs""")
def q_auc_gini(spark, sf):
    return rounded(_rank(spark, sf).select("cohort", "auc", "gini"), ["auc", "gini"])


@register("ks", lambda: O.base(*O.scored_ctes(), *RANK_CTES) + """
SELECT cohort, round(ks, 6) AS ks FROM rs""")
def q_ks(spark, sf):
    return rounded(_rank(spark, sf).select("cohort", "ks"), ["ks"])


@register("ks_two_sided", lambda: O.base(*O.scored_ctes(), *RANK_CTES) + """
SELECT cohort, round(ks_two_sided, 6) AS ks_two_sided FROM rs""")
def q_ks_two_sided(spark, sf):
    return rounded(_rank(spark, sf).select("cohort", "ks_two_sided"), ["ks_two_sided"])


@register("average_precision", lambda: O.base(*O.scored_ctes(), *RANK_CTES) + """
SELECT cohort, round(ap, 6) AS ap FROM rs""")
def q_average_precision(spark, sf):
    return rounded(_rank(spark, sf).select("cohort", "ap"), ["ap"])


LOSS_CTE = """ls AS (SELECT cohort,
      avg(-(y * ln(least(greatest(p_cal, CAST(1e-15 AS double)), CAST(0.999999999999999 AS double)))
            + (1 - y) * ln(CAST(1 AS double) - least(greatest(p_cal, CAST(1e-15 AS double)), CAST(0.999999999999999 AS double))))) AS log_loss,
      avg((p_cal - y) * (p_cal - y)) AS brier, avg(CAST(y AS double)) AS base_rate FROM gr GROUP BY cohort)"""


@register("prob_losses", lambda: O.base(*O.scored_ctes(), LOSS_CTE) + """
SELECT cohort, round(log_loss, 6) AS log_loss, round(brier, 6) AS brier,
       round(1 - brier / greatest(base_rate * (1 - base_rate), CAST(1e-9 AS double)), 6) AS brier_skill
FROM ls""")
def q_prob_losses(spark, sf):
    from ..operators.calibration import prob_losses
    t = prob_losses(_cal(spark, sf), ["cohort"], "p_cal", "y")
    return rounded(t.select("cohort", "log_loss", "brier", "brier_skill"),
                   ["log_loss", "brier", "brier_skill"])


@register("combined_score", lambda: O.base(*O.scored_ctes(), *RANK_CTES, LOSS_CTE) + """
SELECT rs.cohort, round(2 * auc - 1, 6) AS gini,
       round(1 - brier / greatest(base_rate * (1 - base_rate), CAST(1e-9 AS double)), 6) AS brier_skill,
       round(0.5 * (2 * auc - 1) + 0.5 * (1 - brier / greatest(base_rate * (1 - base_rate), CAST(1e-9 AS double))), 6) AS combined
FROM rs JOIN ls ON rs.cohort = ls.cohort""")
def q_combined_score(spark, sf):
    """0.5 Gini + 0.5 Brier skill (the selection criterion of the second pipeline)."""
    from ..operators.calibration import prob_losses
    from ..functions.expr import dbl
    cal = _cal(spark, sf)
    from ..operators.rank_metrics import cumulative, rank_summary
    rk = rank_summary(cumulative(cal, ["cohort"], "p_cal", "y"), ["cohort"])
    ls = prob_losses(cal, ["cohort"], "p_cal", "y")
    t = rk.join(ls, "cohort").select(
        "cohort", "gini", "brier_skill",
        (dbl(0.5) * F.col("gini") + dbl(0.5) * F.col("brier_skill")).alias("combined"))
    return rounded(t, ["gini", "brier_skill", "combined"])


@register("calibration_curve", lambda: O.base(*O.scored_ctes(), """
qe AS (SELECT cohort, list_transform(quantile_cont(p_cal, """ + O.deciles_list() + """), lambda x: round(x, 12)) AS qs
       FROM gr GROUP BY cohort)""") + """
SELECT gr.cohort, CAST(len(list_filter(qe.qs, lambda e: e < gr.p_cal)) AS INTEGER) AS bin,
       count(*) AS n, round(avg(p_cal), 6) AS mean_pred, round(avg(CAST(y AS double)), 6) AS frac_pos
FROM gr JOIN qe ON gr.cohort = qe.cohort GROUP BY 1, 2""")
def q_calibration_curve(spark, sf):
    from ..operators.calibration import calibration_curve
    t = calibration_curve(_cal(spark, sf), ["cohort"], "p_cal", "y", edge_decimals=12)
    return rounded(t.withColumn("bin", F.col("bin").cast("int")), ["mean_pred", "frac_pos"])


@register("roc_points", lambda: O.base(*O.scored_ctes(), *RANK_CTES) + """
SELECT cohort, score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM cu""")
def q_roc_points(spark, sf):
    from ..operators.rank_metrics import cumulative, roc_points
    t = roc_points(cumulative(_cal(spark, sf), ["cohort"], "p_cal", "y"), ["cohort"])
    return rounded(t, ["fpr", "tpr"])


@register("roc_curve", lambda: O.base(*O.scored_ctes(), *RANK_CTES, """
rt AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
      row_number() OVER w AS rn FROM cu WINDOW w AS (PARTITION BY cohort ORDER BY score DESC))""") + """
SELECT cohort, score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM rt
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL
SELECT cohort, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM rt WHERE rn = 1""")
def q_roc_curve(spark, sf):
    from ..operators.rank_metrics import roc_curve
    return rounded(roc_curve(_cal(spark, sf), ["cohort"], "p_cal", "y"), ["fpr", "tpr"])


@register("score_histogram", lambda: O.base(*O.scored_ctes(), """
hr AS (SELECT cohort, y AS cls, min(p_cal) AS lo, max(p_cal) AS hi, count(*) AS n FROM gr GROUP BY 1, 2)""",
    """hb AS (SELECT gr.cohort, hr.cls, hr.lo, hr.hi, gr.p_cal,
      least(floor((gr.p_cal - hr.lo) * (CAST(40 AS double) / (hr.hi - hr.lo))), 39) AS i0
      FROM gr JOIN hr ON gr.cohort = hr.cohort AND gr.y = hr.cls WHERE hr.hi > hr.lo)""",
    """hb1 AS (SELECT *, CASE WHEN p_cal < i0 * ((hi - lo) / CAST(40 AS double)) + lo THEN i0 - 1 ELSE i0 END AS i1 FROM hb)""",
    """hb2 AS (SELECT cohort, cls, CASE WHEN i1 <> 39 AND p_cal >= (i1 + 1) * ((hi - lo) / CAST(40 AS double)) + lo
      THEN i1 + 1 ELSE i1 END AS bin FROM hb1)""",
    """hc AS (SELECT cohort, cls, bin, count(*) AS c FROM hb2 GROUP BY 1, 2, 3)""",
    """hs AS (SELECT cohort, cls, lo, hi, n, unnest(range(0, 40)) AS bin FROM hr)""") + """
SELECT hs.cohort, hs.cls, CAST(hs.bin AS INTEGER) AS bin,
       round(hs.bin * CASE WHEN hs.hi = hs.lo THEN 1 ELSE (hs.hi - hs.lo) / CAST(40 AS double) END + hs.lo, 6) AS bin_lo,
       CAST(CASE WHEN hs.hi = hs.lo THEN (CASE WHEN hs.bin = 0 THEN hs.n ELSE 0 END) ELSE coalesce(hc.c, 0) END AS BIGINT) AS count,
       round(CASE WHEN hs.hi = hs.lo THEN (CASE WHEN hs.bin = 0 THEN hs.n ELSE 0 END) / hs.n
             ELSE coalesce(hc.c, 0) / (hs.n * ((hs.hi - hs.lo) / CAST(40 AS double))) END, 6) AS density
FROM hs LEFT JOIN hc ON hs.cohort = hc.cohort AND hs.cls = hc.cls AND hs.bin = hc.bin""")
def q_score_histogram(spark, sf):
    from ..operators.rank_metrics import score_histogram
    t = score_histogram(_cal(spark, sf), ["cohort"], "p_cal", "y")
    return rounded(t, ["bin_lo", "density"])


def _sweep_sql():
    step = repr(1.0 / 199)
    grid = f"CASE WHEN k >= 199 THEN CAST(1 AS double) ELSE CAST(k AS double) * CAST({step} AS double) END"
    return O.base(*O.scored_ctes(), f"""
ks0 AS (SELECT cohort, y, p_cal, CAST(least(greatest(floor(p_cal * CAST(199 AS double)), 0), 199) AS BIGINT) AS k FROM gr)""",
                  f"""ks1 AS (SELECT cohort, y, p_cal, CASE WHEN k < 199 AND (CASE WHEN k + 1 >= 199 THEN CAST(1 AS double)
      ELSE CAST(k + 1 AS double) * CAST({step} AS double) END) <= p_cal THEN k + 1 ELSE k END AS k FROM ks0)""",
                  f"""ks2 AS (SELECT cohort, y, CASE WHEN ({grid}) > p_cal THEN k - 1 ELSE k END AS k FROM ks1)""",
                  """kb AS (SELECT cohort, k, sum(y) AS pos, sum(1 - y) AS neg FROM ks2 GROUP BY 1, 2)""",
                  """kspine AS (SELECT c.cohort, CAST(unnest(range(0, 200)) AS BIGINT) AS k FROM (SELECT DISTINCT cohort FROM kb) c)""",
                  """kt AS (SELECT s.cohort, s.k, coalesce(kb.pos, 0) AS pos, coalesce(kb.neg, 0) AS neg
      FROM kspine s LEFT JOIN kb ON s.cohort = kb.cohort AND s.k = kb.k)""",
                  """kc AS (SELECT cohort, k, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
      sum(pos) OVER (PARTITION BY cohort) AS P, sum(neg) OVER (PARTITION BY cohort) AS N
      FROM kt WINDOW w AS (PARTITION BY cohort ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
                  """kr AS (SELECT cohort, CAST(k AS INTEGER) AS k, CASE WHEN k = 199 THEN CAST(1 AS double) ELSE CAST(k AS double) * CAST(""" + step + """ AS double) END AS threshold,
      CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(P - tp AS BIGINT) AS fn, CAST(N - fp AS BIGINT) AS tn,
      CASE WHEN P > 0 THEN tp / P ELSE 0 END AS tpr, CASE WHEN N > 0 THEN fp / N ELSE 0 END AS fpr FROM kc)""") + """
SELECT cohort, k, round(threshold, 6) AS threshold, tp, fp, fn, tn, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr,
       row_number() OVER (PARTITION BY cohort ORDER BY tpr - fpr DESC, k) = 1 AS is_ks_best FROM kr"""


@register("threshold_sweep", _sweep_sql)
def q_threshold_sweep(spark, sf):
    from ..operators.rank_metrics import threshold_sweep
    t = threshold_sweep(_cal(spark, sf), ["cohort"], "p_cal", "y")
    return rounded(t.withColumn("k", F.col("k").cast("int")), ["threshold", "tpr", "fpr"])


@register("decile_table", lambda: O.base(*O.scored_ctes(), """
rk AS (SELECT cohort, y, row_number() OVER (PARTITION BY cohort ORDER BY p_cal DESC, loan_id) AS rn,
       count(*) OVER (PARTITION BY cohort) AS n FROM gr)""",
    """dc AS (SELECT cohort, CAST(CASE WHEN rn = 1 THEN 1 ELSE ((rn - 1) * 10 + n - 2) // (n - 1) END AS INTEGER) AS decile,
       count(*) AS n, CAST(sum(y) AS BIGINT) AS defaults FROM rk GROUP BY 1, 2)""") + """
SELECT cohort, decile, n, defaults, round(defaults / n, 6) AS default_rate,
       CAST(sum(defaults) OVER (PARTITION BY cohort ORDER BY decile) AS BIGINT) AS cum_defaults,
       round(sum(defaults) OVER (PARTITION BY cohort ORDER BY decile) / sum(defaults) OVER (PARTITION BY cohort), 6) AS cum_capture_rate
FROM dc""")
def q_decile_table(spark, sf):
    from ..operators.rank_metrics import decile_table
    t = decile_table(_cal(spark, sf), ["cohort"], "p_cal", "y", "loan_id")
    return rounded(t.withColumn("cum_defaults", F.col("cum_defaults").cast("bigint")),
                   ["default_rate", "cum_capture_rate"])


@register("cap_curve", lambda: O.base(*O.scored_ctes(), """
cr AS (SELECT cohort, loan_id, row_number() OVER w AS rn, sum(y) OVER w AS cb,
       count(*) OVER (PARTITION BY cohort) AS n, sum(y) OVER (PARTITION BY cohort) AS b
       FROM gr WINDOW w AS (PARTITION BY cohort ORDER BY p_cal DESC, loan_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""") + """
SELECT cohort, loan_id, CAST(rn AS BIGINT) AS rn, round(rn / n, 6) AS cum_pop, round(cb / b, 6) AS cum_capture,
       round(least(CAST(1 AS double), rn / n * n / b), 6) AS perfect, round(rn / n, 6) AS random_line FROM cr""")
def q_cap_curve(spark, sf):
    from ..operators.rank_metrics import cap_curve
    t = cap_curve(_cal(spark, sf), ["cohort"], "p_cal", "y", "loan_id")
    return rounded(t.withColumn("rn", F.col("rn").cast("bigint")),
                   ["cum_pop", "cum_capture", "perfect", "random_line"])


# ---------------------------------------------------------------------------
# Step 6: calibration
# ---------------------------------------------------------------------------

@register("calibrate_offset", lambda: O.base(*O.scored_ctes()) + """
SELECT gr.cohort, round(avg(CAST(y AS double)), 6) AS base_rate, round(avg(p), 6) AS mean_p,
       round(avg(p_cal), 6) AS mean_p_cal, round(max(cal.c), 6) AS offset, round(max(cal.t), 6) AS target
FROM gr, cal GROUP BY gr.cohort""")
def q_calibrate_offset(spark, sf):
    """Offset c so the TRAIN mean calibrated PD equals the TRAIN default rate."""
    from ..functions.expr import dbl
    prep, enc, scored, offset = S.fitted(spark, sf)
    cal = S.calibrated(scored, offset)
    train_rate = F.avg(F.when(F.col("cohort") == "TRAIN", F.col("y").cast("double")))
    t = cal.groupBy("cohort").agg(F.avg(F.col("y").cast("double")).alias("base_rate"),
                                   F.avg("p").alias("mean_p"), F.avg("p_cal").alias("mean_p_cal"))
    tr = cal.where(F.col("cohort") == "TRAIN").agg(F.avg(F.col("y").cast("double"))).first()[0]
    t = t.withColumn("offset", dbl(offset)).withColumn("target", dbl(tr))
    return rounded(t, ["base_rate", "mean_p", "mean_p_cal", "offset", "target"])


# ---------------------------------------------------------------------------
# Step 7 (SQL-checkable part): folds and variance inflation
# ---------------------------------------------------------------------------

N_FOLDS = 5
FOLD_SEED = 42


@register("stratified_folds", lambda: O.base() + f"""
SELECT loan_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY (loan_id * 7919 + {FOLD_SEED}) % 10007, loan_id) - 1) % {N_FOLDS} AS INTEGER) AS fold
FROM prep WHERE cohort = 'TRAIN'""")
def q_stratified_folds(spark, sf):
    from ..operators.selection import stratified_folds
    tr = S.train_rows(S.prepared_loans(spark, sf))
    return stratified_folds(tr.select("loan_id", "y"), "y", "loan_id", N_FOLDS, FOLD_SEED)


VIF_FEATURES = ["loan_amount", "avg_qty", "qty_x_lines"]


def _vif_sql():
    return O.base("""vx AS (SELECT loan_amount AS a, avg_qty AS b, avg_qty * n_lines AS c FROM prep
        WHERE cohort = 'TRAIN')""", """vc AS (SELECT corr(a, b) AS r12, corr(a, c) AS r13, corr(b, c) AS r23 FROM vx)""",
                  """vd AS (SELECT *, 1 - r12 * r12 - r13 * r13 - r23 * r23 + 2 * r12 * r13 * r23 AS det FROM vc)""") + """
SELECT 'loan_amount' AS feature, round((1 - r23 * r23) / det, 6) AS vif FROM vd
UNION ALL SELECT 'avg_qty', round((1 - r13 * r13) / det, 6) FROM vd
UNION ALL SELECT 'qty_x_lines', round((1 - r12 * r12) / det, 6) FROM vd"""


@register("vif", _vif_sql)
def q_vif(spark, sf):
    """VIF = diagonal of the inverse correlation matrix (one correlation job)."""
    from ..operators.selection import vif_table
    tr = S.train_rows(S.prepared_loans(spark, sf)).withColumn(
        "qty_x_lines", F.col("avg_qty") * F.col("n_lines"))
    return rounded(vif_table(tr, VIF_FEATURES), ["vif"])


@register("vif_rank", lambda: f"""
SELECT feature, vif, row_number() OVER (ORDER BY vif DESC, feature) AS vif_rank FROM ({_vif_sql()})""")
def q_vif_rank(spark, sf):
    """Features by variance inflation, largest first (one row a feature)."""
    w = Window.orderBy(F.col("vif").desc(), "feature")
    return q_vif(spark, sf).withColumn("vif_rank", F.row_number().over(w).cast("bigint"))


# ---------------------------------------------------------------------------
# Step 9: sinks and sources (round trips through the shared folder)
# ---------------------------------------------------------------------------

LOAN_SCHEMA = ("loan_id bigint, vintage string, loan_amount double, acctbal double, "
               "segment string, priority string, n_lines bigint, avg_qty double, "
               "max_disc double, avg_tax double, n_returns bigint, y int")


@register("scan_csv", lambda: O.base(prep=False) + f"\nSELECT {LOAN_COLS} FROM loan")
def q_scan_csv(spark, sf):
    """Write the loans as ';'-separated text with a header, scan them back."""
    from ..session import scratch_path
    from ..sources.files import read_csv, write_csv
    path = write_csv(loan_view(spark, sf), scratch_path(spark, "loans_csv"))
    return read_csv(spark, path, LOAN_SCHEMA)


@register("write_read_table", lambda: O.base() + f"""
SELECT loan_id, vintage, round(acctbal, 6) AS acctbal, loan_to_income, y FROM prep
WHERE vintage IN {O.in_list(S.TRAIN_VINTAGES)}""")
def q_write_read_table(spark, sf):
    """Replace a vintage-partitioned table, read TRAIN back (partition pruning)."""
    from ..session import scratch_path
    from ..sources.files import read_table, write_table
    prep = S.prepared_loans(spark, sf).select("loan_id", "vintage", "acctbal",
                                               "loan_to_income", "y")
    path = write_table(prep, scratch_path(spark, "loans_pq"), ["vintage"])
    back = read_table(spark, path).where(F.col("vintage").isin(S.TRAIN_VINTAGES))
    return rounded(back.select("loan_id", "vintage", "acctbal", "loan_to_income", "y"),
                   ["acctbal"])


def _catalogue_loans(spark, sf):
    """A new table of loans in the shared folder, bucketed by loan and partitioned by vintage: name, location, buckets."""
    import uuid
    from ..session import scratch_path
    from ..sources.catalogue import bucket_count, replace_table
    from ..sources.tables import LOAN_TABLES, table_path
    name, location = f"loans_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalogue")
    buckets = bucket_count(spark, [table_path(sf, t) for t in LOAN_TABLES])
    loans = loan_view(spark, sf).select("loan_id", "vintage", "loan_amount", "y", F.lit(0).alias("revision"))
    replace_table(loans, name, location, "loan_id", buckets, ["vintage"])
    return name, location, buckets


@register("bucketed_join", lambda: O.base(prep=False) + f"""
SELECT loan_id, vintage, y, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n_items
FROM loan JOIN lineitem ON l_orderkey = loan_id
WHERE vintage IN {O.in_list(S.TRAIN_VINTAGES)} GROUP BY loan_id, vintage, y""")
def q_bucketed_join(spark, sf):
    """TRAIN loans with the sums of their lines, from two tables bucketed alike: no exchange, vintages pruned."""
    from ..sources.catalogue import replace_table
    from ..sources.tables import read_table as scan
    name, location, buckets = _catalogue_loans(spark, sf)
    lines = scan(spark, sf, "lineitem").select(F.col("l_orderkey").alias("loan_id"), "l_quantity")
    sums = replace_table(lines, f"{name}_lines", location, "loan_id", buckets).groupBy("loan_id").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n_items"))
    train = spark.table(name).where(F.col("vintage").isin(S.TRAIN_VINTAGES)).select("loan_id", "vintage", "y")
    return train.join(sums, "loan_id")


@register("replace_partitions", lambda: O.base(prep=False) + f"""
SELECT loan_id, vintage, y, CASE WHEN vintage IN {O.in_list(S.VAL_VINTAGES)} THEN 1 ELSE 0 END AS revision
FROM loan WHERE vintage NOT IN {O.in_list(S.VAL_VINTAGES)} OR y = 1""")
def q_replace_partitions(spark, sf):
    """The catalogue table after the VAL vintages were replaced by their defaults, the others untouched."""
    from ..sources.catalogue import replace_partitions
    name, _, _ = _catalogue_loans(spark, sf)
    revised = loan_view(spark, sf).where(F.col("vintage").isin(S.VAL_VINTAGES) & (F.col("y") == 1)).select(
        "loan_id", "vintage", "loan_amount", "y", F.lit(1).alias("revision"))
    return replace_partitions(revised, name).select("loan_id", "vintage", "y", "revision")


METRICS_SCHEMA = ("cohort string, calib_offset double, metrics struct<auc: double, "
                  "gini: double, ks: double, log_loss: double, brier: double, ap: double, "
                  "base_rate: double, psi_vs_train: double>")
METRIC_FIELDS = ["auc", "gini", "ks", "log_loss", "brier", "ap", "base_rate", "psi_vs_train"]


@register("metrics_json", lambda: O.base(*O.scored_ctes(), *RANK_CTES, LOSS_CTE, """
gsh AS (SELECT cohort, grade, count(*) / sum(count(*)) OVER (PARTITION BY cohort) AS share
       FROM gr GROUP BY cohort, grade)""", """
gp AS (SELECT a.cohort AS actual_split, sum((a.share - e.share) * ln(a.share / e.share)) AS psi
       FROM gsh e JOIN gsh a ON e.grade = a.grade
       WHERE e.cohort = 'TRAIN' AND a.cohort IN ('VAL', 'OOT') GROUP BY a.cohort)""") + """
SELECT rs.cohort, round(cal.c, 6) AS calib_offset, round(auc, 6) AS auc,
       round(2 * auc - 1, 6) AS gini, round(ks, 6) AS ks, round(log_loss, 6) AS log_loss,
       round(brier, 6) AS brier, round(ap, 6) AS ap, round(ls.base_rate, 6) AS base_rate,
       round(gp.psi, 6) AS psi_vs_train
FROM rs JOIN ls ON rs.cohort = ls.cohort LEFT JOIN gp ON gp.actual_split = rs.cohort, cal""")
def q_metrics_json(spark, sf):
    """Nested metrics per split (discrimination, losses, base rate, grade PSI
    against TRAIN) and the calibration offset, written as JSON and read back
    with its schema."""
    from ..functions.expr import dbl
    from ..operators.calibration import prob_losses
    from ..operators.rank_metrics import cumulative, rank_summary
    from ..operators.stability import psi_grades
    from ..session import scratch_path
    from ..sources.files import read_json, write_json
    prep, enc, scored, offset = S.fitted(spark, sf)
    cal = S.graded(S.calibrated(scored, offset))
    rk = rank_summary(cumulative(cal, ["cohort"], "p_cal", "y"), ["cohort"])
    ls = prob_losses(cal, ["cohort"], "p_cal", "y")
    ps = psi_grades(cal, "cohort", "grade", "TRAIN", ["VAL", "OOT"]).select(
        F.col("actual_split").alias("cohort"), F.col("psi").alias("psi_vs_train"))
    nested = rk.join(ls, "cohort").join(ps, "cohort", "left").select(
        "cohort", dbl(offset).alias("calib_offset"),
        F.struct(*METRIC_FIELDS).alias("metrics"))
    path = write_json(nested, scratch_path(spark, "metrics_json"))
    back = read_json(spark, path, METRICS_SCHEMA)
    return rounded(back.select("cohort", "calib_offset",
                               *[F.col(f"metrics.{c}").alias(c) for c in METRIC_FIELDS]),
                   ["calib_offset", *METRIC_FIELDS])
