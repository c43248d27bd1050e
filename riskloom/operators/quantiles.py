"""Exact quantiles of any number of groups by sketch and refinement.

1. One pass builds a KLL sketch per group, merged on the map side.  A sketch
   gives, for each wanted rank, two values that enclose it (a bracket).
2. A second pass counts the rows between the brackets, a row per gap, and
   keeps only the values inside them, a row per distinct value.
3. The wanted order statistics are read off running counts of that table.

Nothing is sorted or written but a share of the values that the sketch's error
sets (about 0.3 % of the rows per quantile).  A bracket that misses its rank is
seen in the counts: all brackets are widened and the second pass repeated, in
the last resort to the whole range, so results are always exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dbl, join_null_safe
from ..session import materialize
from .ordered import running_totals

SKETCH = 8192
RANK_ERROR = 2.296 / SKETCH ** 0.9021  # of one rank, as a share of the rows, with 99 % confidence
ERRORS = (2 * RANK_ERROR, 8 * RANK_ERROR, 1.0)  # half widths of the brackets, tried in turn
SMALL_GROUP = 8192  # all values of a group of so few are kept
WINDOW_ROWS = 1_000_000  # more kept values of one group are ordered across tasks


def sketch(df: DataFrame, keys: Sequence[str], value: str, **more: Column) -> DataFrame:
    """keys, _n and _sketch of the non-null values, and the aggregates ``more``; written."""
    got = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias("_sketch"),
        *[c.alias(n) for n, c in more.items()])
    return materialize(got, "sketches")


def _place(p: float) -> Column:
    return (F.col("_n") - 1).cast("double") * dbl(p)


def brackets(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float], error: float,
             whole: Column | None = None) -> DataFrame:
    """keys, _n and the brackets _lo<i>, _hi<i>; ``whole``: groups of which all values are kept."""
    all_of = F.col("_n") <= SMALL_GROUP
    all_of = all_of if whole is None else all_of | whole
    cols = []
    for i, p in enumerate(probs):
        low, high = p - error, p + error  # a sketch is asked for literal ranks; 1/n is far below the error

        def end(rank: float, beyond: float) -> Column:
            if not 0 < rank < 1:
                return dbl(beyond)
            return F.when(all_of, dbl(beyond)).otherwise(F.kll_sketch_get_quantile_double("_sketch", F.lit(rank)))

        # NaN is the largest double to Spark: nothing lies above it
        cols += [end(low, float("-inf")).alias(f"_lo{i}"), end(high, float("nan")).alias(f"_hi{i}")]
    return sketches.select(*keys, "_n", *cols)


def kept_values(df: DataFrame, keys: Sequence[str], value: str, bounds: DataFrame, m: int,
                sums: Mapping[str, Column] | None = None) -> DataFrame:
    """keys, _n, _step, _v, _c: counts of the values inside brackets and of the gaps (null _v); written.

    ``_step`` counts the lower ends at or below a value and the upper ends
    below it: it never falls as values rise, so (_step, _v) is their order.
    """
    sums = dict(sums or {})
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), *[c.alias(n) for n, c in sums.items()])
    near = join_null_safe(rows, bounds, keys)
    above = reduce(add, [(F.col(f"_lo{i}") <= F.col("_v")).cast("int") for i in range(m)])
    past = reduce(add, [(F.col(f"_hi{i}") < F.col("_v")).cast("int") for i in range(m)])
    near = near.select(*keys, "_n", (above + past).alias("_step"), F.when(above > past, F.col("_v")).alias("_v"), *sums)
    return materialize(near.groupBy(*keys, "_n", "_step", "_v").agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(n).alias(n) for n in sums]), "kept")


def pick(kept: DataFrame, keys: Sequence[str], probs: Sequence[float], window_rows: int = WINDOW_ROWS) -> DataFrame:
    """keys and _q<i>, the interpolated quantiles; null where a bracket missed."""
    most = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    if most <= window_rows:
        by = Window.partitionBy(*keys).orderBy("_step", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = kept.withColumn("_cum", F.sum("_c").over(by))
    else:
        cum = running_totals(kept, ["_step", "_v"], ["_c"], keys).withColumnRenamed("cum__c", "_cum")

    def at(k: Column) -> Column:  # the value at position k (from 0)
        return F.max(F.when((F.col("_cum") - F.col("_c") <= k) & (k < F.col("_cum")), F.col("_v")))

    found = cum.groupBy(*keys, "_n").agg(*[c for i, p in enumerate(probs) for c in (
        at(F.floor(_place(p))).alias(f"_a{i}"), at(F.ceil(_place(p))).alias(f"_b{i}"))])
    return found.select(*keys, *[
        (F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (_place(p) - F.floor(_place(p)))).alias(f"_q{i}")
        for i, p in enumerate(probs)])


def wide_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                     errors: Sequence[float] = ERRORS, window_rows: int = WINDOW_ROWS,
                     sketches: DataFrame | None = None) -> DataFrame:
    """keys and a column _q<i> per probability, of every group with a value; written."""
    sketches = sketch(df, keys, value) if sketches is None else sketches
    for error in errors:
        kept = kept_values(df, keys, value, brackets(sketches, keys, probs, error), len(probs))
        got = materialize(pick(kept, keys, probs, window_rows), "quantiles")
        missed = reduce(lambda a, b: a | b, [F.col(f"_q{i}").isNull() for i in range(len(probs))])
        if got.where(missed).isEmpty():
            break
    return got


def refined_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                        errors: Sequence[float] = ERRORS, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Exact interpolated percentiles per group: group_cols, pidx, prob, q (as numpy ``quantile``)."""
    keys = list(group_cols) or ["_rl_g"]
    rows = df if group_cols else df.withColumn("_rl_g", F.lit(0))
    rows = rows.select(*keys, F.col(value_col).cast("double").alias("_value"))
    wide = wide_percentiles(rows, keys, "_value", probs, errors, window_rows)
    found = [F.struct(F.lit(i).alias("pidx"), dbl(p).alias("prob"), F.col(f"_q{i}").alias("q"))
             for i, p in enumerate(probs)]
    return wide.select(*group_cols, F.explode(F.array(*found)).alias("_f")).select(*group_cols, "_f.*")
