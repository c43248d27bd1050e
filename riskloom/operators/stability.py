"""Population stability: over grades (first pipeline) and per feature on
training deciles (second pipeline).  Each is a handful of small aggregates;
all features are binned in the same pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import count_lt, dbl, psi_verdict
from . import woe as W

SHARE_FLOOR = 1e-6
EDGE_NUDGE = 1e-9


def psi_from_shares(df: DataFrame, keys: Sequence[str], expected: str, actual: str,
                    mode: str = "skip") -> DataFrame:
    """sum((a - e) ln(a / e)); ``skip`` drops bins with a zero share,
    ``floor`` floors both shares at 1e-6."""
    e, a = F.col(expected), F.col(actual)
    if mode == "skip":
        term = F.when((e > 0) & (a > 0), (a - e) * F.ln(a / e)).otherwise(dbl(0))
    else:
        ef = F.greatest(F.coalesce(e, dbl(0)), dbl(SHARE_FLOOR))
        af = F.greatest(F.coalesce(a, dbl(0)), dbl(SHARE_FLOOR))
        term = (af - ef) * F.ln(af / ef)
    return df.groupBy(*keys).agg(F.sum(term).alias("psi"))


def psi_grades(df: DataFrame, split_col: str, grade_col: str, base: str,
               others: Sequence[str]) -> DataFrame:
    """PSI of the grade distribution of each ``other`` split against ``base``."""
    # one scan: the counts are a row per split and grade, shares and the base's share come from windows over them
    cnt = df.groupBy(split_col, grade_col).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(split_col))
    known = cnt.withColumn("actual", share).where(F.col(split_col).isNotNull() & F.col(grade_col).isNotNull())
    expected = F.max(F.when(F.col(split_col) == base, F.col("actual"))).over(Window.partitionBy(grade_col))
    # grades absent from either side have share 0 and are skipped
    j = known.withColumn("expected", expected).where(
        F.col(split_col).isin(list(others)) & F.col("expected").isNotNull()).withColumn("actual_split", F.col(split_col))
    return psi_from_shares(j, ["actual_split"], "expected", "actual", "skip").select(
        F.lit(base).alias("expected_split"), "actual_split", "psi")


def psi_features(df: DataFrame, features: Sequence[str], split_col: str, base: str,
                 others: Sequence[str], n_bins: int = 10, out_of_range: str = "drop",
                 edge_decimals: int | None = None) -> DataFrame:
    """PSI per feature on the base split's decile edges (right-closed).

    Edges are the distinct deciles with min and max; the outer edges are
    widened by 1e-9 (so, as in the reference, nothing changes for values near
    1e8 and the lowest base row falls out).  Rows outside the edges are dropped
    (``drop``) or put in the edge bins (``clip``); shares are over kept rows;
    zero shares are floored at 1e-6.  ``edge_decimals`` rounds the deciles.
    """
    probs = [i / n_bins for i in range(1, n_bins)]
    base_rows = df.where(F.col(split_col) == base)
    found = W.NumericSketch(base_rows.withColumn("_z", F.lit(0)), features, "_z", probs)
    rng, inner = found.range, found.edges(edge_decimals)
    sel = df.where(F.col(split_col).isin([base, *others])).select(
        F.col(split_col).alias("_split"), *[F.col(f).cast("double").alias(f) for f in features])
    long = sel.unpivot(["_split"], list(features), "feature", "value")
    bin_expr = None
    keep_expr = None
    for f in features:
        mn, mx = rng.get(f, (None, None))
        if mn is None:
            continue
        lo, hi = mn - EDGE_NUDGE, mx + EDGE_NUDGE
        e = inner.get(f, [])
        is_f = F.col("feature") == f
        b = count_lt(F.col("value"), e)
        k = (F.col("value") > dbl(lo)) & (F.col("value") <= dbl(hi)) if out_of_range == "drop" \
            else F.col("value").isNotNull()
        bin_expr = F.when(is_f, b) if bin_expr is None else bin_expr.when(is_f, b)
        keep_expr = F.when(is_f, k) if keep_expr is None else keep_expr.when(is_f, k)
    binned = long.where(keep_expr).withColumn("bin", bin_expr)
    cnt = binned.groupBy("_split", "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    tot = binned.groupBy("_split", "feature").agg(F.count(F.lit(1)).alias("_t"))
    sh = cnt.join(tot, ["_split", "feature"]).withColumn("share", F.col("n") / F.col("_t"))
    spine = df.sparkSession.createDataFrame(
        [(o, f, b) for o in others for f in features if f in rng
         for b in range(len(inner.get(f, [])) + 1)], "actual_split string, feature string, bin int")
    bs = sh.where(F.col("_split") == base).select("feature", "bin", F.col("share").alias("expected"))
    os_ = sh.where(F.col("_split") != base).select(
        F.col("_split").alias("actual_split"), "feature", "bin", F.col("share").alias("actual"))
    j = spine.join(bs, ["feature", "bin"], "left").join(os_, ["actual_split", "feature", "bin"],
                                                        "left")
    res = psi_from_shares(j, ["actual_split", "feature"], "expected", "actual", "floor")
    return res.select(F.lit(base).alias("expected_split"), "actual_split", "feature", "psi",
                      psi_verdict(F.col("psi")).alias("verdict"))
