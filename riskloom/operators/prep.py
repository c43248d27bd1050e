"""Row preparation: cohorts, missingness, imputation, scaling, clean-up.

Statistics are computed in one aggregate for all columns (small results,
collected or joined back); no per-column scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import dbl
from ..session import materialize
from .ordered import percentiles


def cohort_column(vintage: Column, train: Sequence[str], val: Sequence[str],
                  oot_from: str) -> Column:
    """One label column instead of three filtered copies of the table."""
    return (F.when(vintage.isin(list(train)), "TRAIN").when(vintage.isin(list(val)), "VAL")
            .when(vintage >= oot_from, "OOT"))


def drop_period(df: DataFrame, period_col: str, bad_value) -> DataFrame:
    """Remove one anomalous period, keeping NULL periods (NaN != v is true in pandas)."""
    return df.where(~F.col(period_col).eqNullSafe(F.lit(bad_value)))


def missing_flags(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """``{flag_name: source_col}`` -> int 0/1 flags, taken before imputation."""
    return df.withColumns({flag: F.col(src).isNull().cast("int") for flag, src in cols.items()})


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_missing) for columns with at least one NULL; one pass."""
    row = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    long = row.unpivot([], list(cols), "column_name", "n_missing")
    return long.where(F.col("n_missing") > 0)


def impute_constant(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in values.items()})


def _medians(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str],
             exact: bool, decimals: int | None) -> DataFrame:
    """group_cols and a column ``_med_<column>`` per column; one row per group."""
    long = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(group_cols), list(cols), "_feature", "_value")
    q = percentiles(long, [*group_cols, "_feature"], "_value", [0.5], exact)
    value = F.col("q") if decimals is None else F.round("q", decimals)
    return q.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("_feature") == c, value)).alias(f"_med_{c}") for c in cols])


def impute_median(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                  exact: bool = True, decimals: int | None = None) -> DataFrame:
    """Fill NULLs with the median of the column, per group (or overall).

    ``decimals`` rounds the medians, e.g. to compare two engines whose
    interpolation differs in the last bit; by default they are not rounded.

    Overall medians are one row and become literals.  Group medians stay a
    table, however many groups there are; it is written first, so that Spark
    knows its size when it plans the join.  A group whose values are all NULL
    keeps NULLs, like ``fillna(NaN)``, and so do rows without a group.
    """
    med = _medians(df, cols, group_cols, exact, decimals)
    if not group_cols:
        vals = med.first()
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(
            vals[f"_med_{c}"]).cast("double")) for c in cols})
    med = materialize(med.select(*[F.col(g).alias(f"_med_by_{g}") for g in group_cols],
                                 *[f"_med_{c}" for c in cols]), "medians")
    met = [df[g] == med[f"_med_by_{g}"] for g in group_cols]
    out = df.join(med, met, "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")) for c in cols})
    return out.select(*df.columns)


def _stats_row(df: DataFrame, cols: Sequence[str], sd_fn) -> dict:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), sd_fn(c).alias(f"s_{c}")]
    return df.agg(*aggs).first().asDict()


def standardize(df: DataFrame, cols: Sequence[str], population: bool = False) -> DataFrame:
    """(x - mean) / sd in one aggregate; sd = 0 -> 1.

    ``population=True`` uses the population deviation and maps NULL / inf to
    0 afterwards (the scaler of the second pipeline); otherwise the sample
    deviation (pandas ``std``).
    """
    sd_fn = F.stddev_pop if population else F.stddev_samp
    st = _stats_row(df, cols, sd_fn)
    out = {}
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        s = 1.0 if (s is None or s == 0) else s
        z = (F.col(c) - dbl(m if m is not None else 0.0)) / dbl(s)
        if population:
            z = F.when(z.isNull() | F.isnan(z) | (F.abs(z) == float("inf")), dbl(0)).otherwise(z)
        out[c] = z
    return df.withColumns(out)


def unusable_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns holding any NULL, NaN or infinity (counted in one aggregate)."""
    bad = df.agg(*[F.sum((F.col(c).isNull() | F.isnan(F.col(c))
                          | (F.abs(F.col(c)) == float("inf"))).cast("bigint")).alias(c)
                   for c in cols]).first().asDict()
    return [c for c in cols if (bad[c] or 0) > 0]


def drop_unusable_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*unusable_columns(df, cols))
