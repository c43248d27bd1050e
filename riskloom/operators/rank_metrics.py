"""Exact rank metrics (AUC, KS, AP, ROC, CAP, deciles, threshold sweep).

All come from one table: rows collapsed to distinct scores per group with
positive / negative counts, then two-level running sums in descending score
order (``ordered.running_totals``).  No metric sorts the whole table in one
task, and a score shared by a third of the rows is one row after the
collapse.  AUC counts ties as one half, as ``roc_auc_score`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dbl, join_null_safe
from ..session import materialize
from .ordered import row_positions, running_totals


def score_counts(df: DataFrame, group_cols: Sequence[str], p: str, y: str) -> DataFrame:
    yy = F.col(y).cast("bigint")
    return df.groupBy(*group_cols, F.col(p).alias("score")).agg(
        F.sum(yy).alias("pos"), F.sum(F.lit(1) - yy).alias("neg"))


def cumulative(df: DataFrame, group_cols: Sequence[str], p: str, y: str, following: bool = False) -> DataFrame:
    """Per distinct score (descending): pos, neg, tp, fp (inclusive), P, N.

    ``following`` adds next_pos and next_neg, the counts of the next lower score.
    """
    sc = score_counts(df, group_cols, p, y)
    keys = list(group_cols) or ["_rl_g"]
    if not group_cols:
        sc = sc.withColumn("_rl_g", F.lit(0))
    out = (running_totals(sc, ["-score"], ["pos", "neg"], keys, totals={"pos": "P", "neg": "N"},
                          following=["pos", "neg"] if following else [])
           .withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp"))
    return out if group_cols else out.drop("_rl_g")


def _ratio(a, b):
    return F.when(b > 0, a.cast("double") / b.cast("double"))


def rank_summary(cum: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """auc, gini, ks (one-sided, from 0), ks_two_sided, ap per group."""
    tpr = _ratio(F.col("tp"), F.col("P"))
    fpr = _ratio(F.col("fp"), F.col("N"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    agg = cum.groupBy(*group_cols).agg(
        F.sum(F.col("neg").cast("double") * ((F.col("tp") - F.col("pos")).cast("double")
                                             + F.col("pos").cast("double") / dbl(2))).alias("_a"),
        F.first("P").alias("P"), F.first("N").alias("N"),
        F.max(tpr - fpr).alias("_ks"), F.max(F.abs(tpr - fpr)).alias("_ks2"),
        F.sum(F.col("pos").cast("double") * F.col("tp").cast("double")
              / (F.col("tp") + F.col("fp")).cast("double")).alias("_ap"))
    auc = F.when(both, F.col("_a") / (F.col("P").cast("double") * F.col("N").cast("double")))
    return agg.select(
        *group_cols, auc.alias("auc"), (dbl(2) * auc - dbl(1)).alias("gini"),
        F.when(both, F.greatest(F.col("_ks"), dbl(0))).alias("ks"),
        F.when(both, F.greatest(F.col("_ks2"), dbl(0))).alias("ks_two_sided"),
        F.when(F.col("P") > 0, F.col("_ap") / F.col("P").cast("double")).alias("ap"))


def roc_points(cum: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; the origin is implied."""
    return cum.select(*group_cols, F.col("score").alias("threshold"),
                      _ratio(F.col("fp"), F.col("N")).alias("fpr"),
                      _ratio(F.col("tp"), F.col("P")).alias("tpr"))


def roc_curve(df: DataFrame, group_cols: Sequence[str], p: str, y: str) -> DataFrame:
    """ROC without points inside a straight run: (threshold, fpr, tpr) per group, with the origin.

    A point goes if the next step has the same counts of both classes as its
    own, so the curve is kept whole.  The first and the last point stay, and
    the origin comes before them with threshold NULL (above every score).
    Rates are NULL in a group without rows of the class.
    """
    cum = cumulative(df, group_cols, p, y, following=True)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    turn = (F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos"))
            | (F.col("next_neg") != F.col("neg")))

    def point(score, fp, tp):
        return F.struct(score.cast("double").alias("threshold"), _ratio(fp, F.col("N")).alias("fpr"),
                        _ratio(tp, F.col("P")).alias("tpr"))

    here = point(F.col("score"), F.col("fp"), F.col("tp"))
    zero = F.lit(0).cast("bigint")
    points = F.when(first, F.array(point(F.lit(None), zero, zero), here)).otherwise(F.array(here))
    return cum.where(first | turn).select(*group_cols, F.explode(points).alias("_pt")).select(*group_cols, "_pt.*")


def decile_table(df: DataFrame, group_cols: Sequence[str], p: str, y: str, key: str,
                 n_groups: int = 10) -> DataFrame:
    """Gain table by decile of row position after a descending sort on p.

    Position is exact (ties broken by ``key``) and computed in two levels;
    decile = ceil(10 (rn - 1) / (n - 1)), at least 1, in integer arithmetic
    (the qcut of 0..n-1).
    """
    keys = list(group_cols) or ["_rl_g"]
    base = df if group_cols else df.withColumn("_rl_g", F.lit(0))
    pos = row_positions(base.select(*keys, p, y, key), [f"-{p}", key], keys, count_as="_n")
    r0 = F.col("rn") - 1
    nm1 = F.col("_n") - 1
    dec = F.when(r0 == 0, F.lit(1)).otherwise(
        F.floor((r0 * n_groups + nm1 - 1) / nm1)).cast("int")
    t = pos.withColumn("decile", dec).groupBy(*keys, "decile").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("defaults"))
    # windows over the gain table itself: at most n_groups rows per group
    w = Window.partitionBy(*keys).orderBy("decile").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    wt = Window.partitionBy(*keys)
    out = (t.withColumn("default_rate", F.col("defaults") / F.col("n"))
           .withColumn("cum_defaults", F.sum("defaults").over(w))
           .withColumn("cum_capture_rate",
                       _ratio(F.col("cum_defaults"), F.sum("defaults").over(wt))))
    return out if group_cols else out.drop("_rl_g")


def cap_curve(df: DataFrame, group_cols: Sequence[str], p: str, y: str, key: str) -> DataFrame:
    """Cumulative accuracy profile per row by descending score (ties by key)."""
    keys = list(group_cols) or ["_rl_g"]
    base = df if group_cols else df.withColumn("_rl_g", F.lit(0))
    one = base.select(*keys, p, key, F.col(y).cast("bigint").alias("_y"))
    cum = running_totals(one.withColumn("_one", F.lit(1).cast("bigint")),
                         [f"-{p}", key], ["_one", "_y"], keys, totals={"_one": "_n", "_y": "_b"})
    pop = F.col("cum__one") / F.col("_n")
    return cum.select(*group_cols, key, F.col("cum__one").alias("rn"), pop.alias("cum_pop"),
                      _ratio(F.col("cum__y"), F.col("_b")).alias("cum_capture"),
                      F.when(F.col("_b") > 0, F.least(dbl(1), pop * F.col("_n") / F.col("_b")))
                      .alias("perfect"),
                      pop.alias("random_line"))


def threshold_index(p, n_points: int = 200):
    """Largest k with k/(n-1) <= p on the linspace(0, 1, n) grid, exactly.

    The grid value is k * (1/(n-1)) (last point exactly 1.0); floor(p*(n-1))
    alone is off by one on some grid points, so it is corrected both ways.
    """
    step = 1.0 / (n_points - 1)

    def grid(k):
        return F.when(k >= n_points - 1, dbl(1.0)).otherwise(k.cast("double") * dbl(step))
    k0 = F.least(F.greatest(F.floor(p * dbl(n_points - 1)), F.lit(0)), F.lit(n_points - 1))
    k1 = F.when((k0 < n_points - 1) & (grid(k0 + 1) <= p), k0 + 1).otherwise(k0)
    return F.when(grid(k1) > p, k1 - 1).otherwise(k1)


def threshold_sweep(df: DataFrame, group_cols: Sequence[str], p: str, y: str,
                    n_points: int = 200) -> DataFrame:
    """Confusion counts for p >= t at t = linspace(0, 1, n_points); best KS gap.

    Rows are bucketed by the largest threshold they pass, counted (one small
    aggregate), then a reverse running sum over the n_points-row spine.
    """
    yy = F.col(y).cast("bigint")
    b = df.groupBy(*group_cols, threshold_index(F.col(p), n_points).cast("int").alias("k")).agg(
        F.sum(yy).alias("_pos"), F.sum(F.lit(1) - yy).alias("_neg"))
    # the spine of a group is made from its counts (n_points at most), so that the rows are scanned once
    found = b.groupBy(*group_cols).agg(F.map_from_entries(F.collect_list(F.when(
        F.col("k").isNotNull(), F.struct("k", F.struct("_pos", "_neg"))))).alias("_at"))
    t = found.select(*group_cols, "_at", F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("k"))
    t = t.select(*group_cols, "k", *[F.coalesce(F.try_element_at("_at", F.col("k"))[c], F.lit(0).cast("bigint")).alias(c)
                                     for c in ("_pos", "_neg")])
    w = Window.partitionBy(*group_cols).orderBy(F.col("k").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    wt = Window.partitionBy(*group_cols)
    t = (t.withColumn("tp", F.sum("_pos").over(w)).withColumn("fp", F.sum("_neg").over(w))
         .withColumn("_P", F.sum("_pos").over(wt)).withColumn("_N", F.sum("_neg").over(wt)))
    step = 1.0 / (n_points - 1)
    out = t.select(
        *group_cols, "k",
        F.when(F.col("k") == n_points - 1, dbl(1.0)).otherwise(
            F.col("k").cast("double") * dbl(step)).alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        (F.col("_P") - F.col("tp")).cast("bigint").alias("fn"),
        (F.col("_N") - F.col("fp")).cast("bigint").alias("tn"),
        F.when(F.col("_P") > 0, F.col("tp") / F.col("_P")).otherwise(dbl(0)).alias("tpr"),
        F.when(F.col("_N") > 0, F.col("fp") / F.col("_N")).otherwise(dbl(0)).alias("fpr"))
    wb = Window.partitionBy(*group_cols).orderBy((F.col("tpr") - F.col("fpr")).desc(), "k")
    return out.withColumn("is_ks_best", (F.row_number().over(wb) == 1))


def score_histogram(df: DataFrame, group_cols: Sequence[str], p: str, y: str,
                    n_bins: int = 40) -> DataFrame:
    """Density histogram of p per class, each class over its own [min, max].

    Bin rule of numpy's uniform histogram: i = floor((p - lo) * n / (hi - lo)),
    corrected against the edges lo + i * (hi - lo) / n, maximum in the last bin.
    All bins are returned (empty ones with 0); density = count / (n * width).
    """
    keys = [*group_cols, "cls"]
    d = df.select(*group_cols, F.col(y).cast("int").alias("cls"), F.col(p).alias("_p"))
    rng = d.groupBy(*keys).agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"),
                               F.count(F.lit(1)).alias("_n"))
    rng = materialize(rng, "ranges")  # its size is then known when the join is planned
    span = F.col("hi") - F.col("lo")
    step = span / dbl(n_bins)

    def edge(i):
        return i.cast("double") * step + F.col("lo")
    i0 = F.floor((F.col("_p") - F.col("lo")) * (dbl(n_bins) / span))
    i0 = F.when(i0 >= n_bins, F.lit(n_bins - 1)).otherwise(i0)
    i1 = F.when(F.col("_p") < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((i1 != n_bins - 1) & (F.col("_p") >= edge(i1 + 1)), i1 + 1).otherwise(i1)
    bin_ = F.when(span == 0, F.lit(0)).otherwise(i2).cast("int")
    c = join_null_safe(d, rng, keys).groupBy(*keys, bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    spine = rng.select(*keys, "lo", "hi", "_n",
                       F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    full = join_null_safe(spine, c, [*keys, "bin"], "left")
    w = F.when(span == 0, dbl(1)).otherwise(step)
    return full.select(*keys, "bin", (F.col("bin").cast("double") * w + F.col("lo")).alias("bin_lo"),
                       F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
                       (F.coalesce("count", F.lit(0)) / (F.col("_n") * w)).alias("density"))
