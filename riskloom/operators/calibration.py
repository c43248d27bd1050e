"""Probability calibration, losses, grade tables and reliability curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import (GRADE_LABELS, PROB_EPS, clip_prob, dbl, join_null_safe, logit,
                              sigmoid)
from ..session import cut_lineage, materialize
from .ordered import exact_percentiles


def newton_offset(scored: DataFrame, p_col: str, y_col: str, steps: int = 100,
                  target: float | None = None, bound: float = 10.0, tol: float = 1e-15) -> float:
    """Offset c with mean(sigmoid(logit(p) + c)) = target (default: mean of y).

    Rows are collapsed once to distinct logits with weights; each step is one
    small aggregate of that table: f = mean(s) - target, f' = mean(s (1 - s)).
    The root is kept in a bracket inside [-bound, bound]; a Newton step that
    leaves the bracket is replaced by its middle, so the search converges from
    any start.  It stops when |f|, the step or the bracket is below ``tol``,
    returns the nearer bound if the target lies beyond it, and raises if
    ``steps`` (100 at least) do not do.
    """
    dist = cut_lineage(
        scored.select(logit(F.col(p_col)).alias("_z"), F.col(y_col).cast("bigint").alias("_y"))
        .groupBy("_z").agg(F.count(F.lit(1)).alias("_w"), F.sum("_y").alias("_yp")))
    r = dist.agg(F.sum("_yp").alias("a"), F.sum("_w").alias("b")).first()
    if not r["b"]:
        return 0.0
    if target is None:
        target = r["a"] / r["b"]

    def at(c: float) -> tuple[float, float]:
        s = sigmoid(F.col("_z") + dbl(c))
        r = dist.agg((F.sum(F.col("_w") * s) / F.sum("_w")).alias("m"),
                     (F.sum(F.col("_w") * s * (dbl(1) - s)) / F.sum("_w")).alias("d")).first()
        return r["m"] - target, r["d"]

    low, high, c = -bound, bound, 0.0
    steps = max(steps, 100)
    for _ in range(steps):
        f, d = at(c)
        if abs(f) <= tol:
            return c
        low, high = (low, c) if f > 0 else (c, high)
        step = c - f / d if d else low
        step = step if low < step < high else (low + high) / 2
        if abs(step - c) <= tol * max(1.0, abs(c)) or high - low <= tol:
            return step
        if bound - abs(step) <= 1e-9:  # the target lies beyond a bound
            return bound if step > 0 else -bound
        c = step
    raise RuntimeError(f"no offset found in {steps} steps")


def shift_logit(p, offset: float):
    return sigmoid(logit(p) + dbl(offset))


def prob_losses(df: DataFrame, group_cols: Sequence[str], p: str, y: str) -> DataFrame:
    """log-loss (p clipped), Brier, Brier skill 1 - Brier / max(m(1-m), 1e-9)."""
    pc = clip_prob(F.col(p), PROB_EPS)
    yy = F.col(y).cast("double")
    agg = df.groupBy(*group_cols).agg(
        F.avg(-(yy * F.ln(pc) + (dbl(1) - yy) * F.ln(dbl(1) - pc))).alias("log_loss"),
        F.avg((F.col(p) - yy) * (F.col(p) - yy)).alias("brier"),
        F.avg(yy).alias("base_rate"))
    naive = F.greatest(F.col("base_rate") * (dbl(1) - F.col("base_rate")), dbl(1e-9))
    return agg.withColumn("brier_skill", dbl(1) - F.col("brier") / naive)


def grade_table(spark: SparkSession, df: DataFrame, split_col: str, grade_col: str, p: str,
                y: str, splits: Sequence[str], labels: Sequence[str] = GRADE_LABELS) -> DataFrame:
    """n, defaults, observed rate, mean predicted, share per (split, grade).

    Empty grades are kept with zeros (left join from the label spine, which is
    a literal list of labels x splits, not data).
    """
    counts = df.groupBy(split_col, grade_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("defaults"),
        F.avg(F.col(y).cast("double")).alias("obs_dr"), F.avg(p).alias("pred_pd"))
    spine = spark.createDataFrame([(s, g, i) for s in splits for i, g in enumerate(labels)],
                                  f"{split_col} string, {grade_col} string, grade_ix int")
    t = spine.join(counts, [split_col, grade_col], "left").select(
        F.col(split_col).alias("split"), F.col(grade_col).alias("grade"), "grade_ix",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.coalesce("defaults", F.lit(0)).cast("bigint").alias("defaults"),
        F.coalesce("obs_dr", dbl(0)).alias("obs_dr"),
        F.coalesce("pred_pd", dbl(0)).alias("pred_pd"))
    w = Window.partitionBy("split")
    return t.withColumn("population_pct", F.col("n") / F.sum("n").over(w))


def calibration_curve(df: DataFrame, group_cols: Sequence[str], p: str, y: str,
                      n_bins: int = 10, edge_decimals: int | None = None) -> DataFrame:
    """Quantile reliability curve: edges = percentiles of p (not de-duplicated),
    bin = number of inner edges < p (right-closed), empty bins dropped.
    ``edge_decimals`` rounds the edges; by default they are not rounded."""
    probs = [i / n_bins for i in range(1, n_bins)]
    keys = list(group_cols) or ["_rl_g"]
    base = df if group_cols else df.withColumn("_rl_g", F.lit(0))
    q = F.col("q") if edge_decimals is None else F.round("q", edge_decimals)
    edges = exact_percentiles(base, keys, p, probs).groupBy(*keys).agg(F.collect_list(q).alias("_es"))
    # written, so that its size is known when the join is planned
    binned = join_null_safe(base, materialize(edges, "edges"), keys, "left")
    binned = binned.withColumn("bin", F.when(
        F.col(p).isNotNull(), F.size(F.filter("_es", lambda e: e < F.col(p)))))
    out = binned.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_pred"),
        F.avg(F.col(y).cast("double")).alias("frac_pos"))
    return out if group_cols else out.drop("_rl_g")
