"""Order-dependent aggregates without a single-task global sort.

``Window.orderBy`` with no partition key moves a whole table into one task.
Every order-dependent quantity in the scorecard (running counts for ROC, KS,
AP, CAP, decile positions, exact quantiles) is instead computed in two levels,
at every size alike:

1. the rows are dealt out by range of (group, order key) with Spark's own
   range partitioner and written once in the shared folder together with the
   number of their partition, so that a retried stage cannot move rows;
2. running sums inside each partition, and partition totals (one row per group
   and partition) turned into offsets by a window on that small table; the
   offsets are joined back.

A hot order value (one score held by a third of the rows) is no problem when
callers aggregate to distinct values first or add a unique tie-breaker, which
they do.  The number of partitions is ``spark.sql.shuffle.partitions`` (fewer
if adaptive execution finds small ones): the knob a cluster operator already
sizes so that a partition fits in executor memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dbl, join_null_safe
from ..session import materialize

BUCKET = "_rl_bucket"


def _key_columns(order_by: Sequence[str]) -> list[Column]:
    """"x" ascending, "-x" descending (numeric), all mapped to ascending keys."""
    out = []
    for k in order_by:
        out.append(-F.col(k[1:]) if k.startswith("-") else F.col(k))
    return out


def running_totals(df: DataFrame, order_by: Sequence[str], sums: Sequence[str],
                   partition_by: Sequence[str] = (), buckets: int | None = None,
                   prefix: str = "cum_", totals: Mapping[str, str] | None = None,
                   following: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``order_by`` order per ``partition_by``.

    ``order_by`` lists column names, "-name" for descending.  It must be a
    total order within each partition group (aggregate to distinct values or
    add a unique tie-breaker), as for a ROWS window.  A NULL group is a group.
    ``totals`` maps columns of ``sums`` to names under which their sum over
    the whole group is added.  ``buckets`` fixes the number of partitions.
    ``following`` lists columns whose value in the next row of the group is
    added as "next_name" (NULL in the last row); across partitions it comes
    from the next partition's first row, found in the same small table as the
    offsets.
    """
    part = list(partition_by)
    keys = _key_columns(order_by)
    by = [F.col(c) for c in part] + keys
    dealt = df.repartitionByRange(buckets, *by) if buckets else df.repartitionByRange(*by)
    rows = materialize(dealt.withColumn(BUCKET, F.spark_partition_id()), "ordered")

    group = Window.partitionBy(*part)
    before = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    first = [F.min(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)],
                            F.struct(*following).alias("row"))).alias("_first")] if following else []
    sizes = rows.groupBy(*part, BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], *first)
    # written, so that its size is known when the join is planned
    offsets = materialize(sizes.select(
        *part, BUCKET,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(group).alias(t) for c, t in (totals or {}).items()],
        *[F.lead("_first").over(group.orderBy(BUCKET))["row"].alias("_edge") for _ in first]), "offsets")

    inside = Window.partitionBy(BUCKET, *part).orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    after = [F.lead(F.struct(*following)).over(Window.partitionBy(BUCKET, *part).orderBy(*keys)).alias("_after")
             ] if following else []
    inner = rows.select("*", *[F.sum(c).over(inside).alias(f"_i_{c}") for c in sums], *after)
    out = join_null_safe(inner, offsets, [*part, BUCKET])
    return out.select(*df.columns, *[
        (F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(f"{prefix}{c}") for c in sums],
        *(totals or {}).values(),
        *[F.coalesce("_after", "_edge")[c].alias(f"next_{c}") for c in following])


def row_positions(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
                  name: str = "rn", buckets: int | None = None,
                  count_as: str | None = None) -> DataFrame:
    """1-based row number in ``order_by`` order per group, computed in two levels.

    ``count_as`` names a further column with the rows of the group.
    """
    one = df.withColumn("_rl_one", F.lit(1).cast("bigint"))
    out = running_totals(one, order_by, ["_rl_one"], partition_by, buckets, prefix="_rl_cum",
                         totals={"_rl_one": count_as} if count_as else None)
    return out.withColumnRenamed("_rl_cum_rl_one", name).drop("_rl_one")


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      probs: Sequence[float], buckets: int | None = None,
                      weight_col: str | None = None, distinct: bool = False) -> DataFrame:
    """Exact linear-interpolated percentiles per group: group_cols, pidx, prob, q.

    Same definition as numpy ``quantile`` / DuckDB ``quantile_cont`` / Spark
    ``percentile``: with n non-null values sorted, h = (n - 1) * p and the
    result is v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h).

    Values are first collapsed to (group, value, count) (``weight_col`` when
    the input is already such a table; ``distinct=True``: it has one row per
    group and value), so a value repeated in a third of the rows is a single
    row.  The order statistics are the values whose running counts enclose the
    wanted positions; they are picked by one aggregate with map-side combine.
    Unlike ``percentile`` nothing keeps a whole group's value map in one task,
    and nothing is collected, however many groups there are.

    Rows without weights (and without a fixed number of partitions) go through
    ``quantiles.refined_percentiles``: sketches first, and no ordering of all values.
    """
    if weight_col is None and buckets is None:
        from .quantiles import refined_percentiles
        return refined_percentiles(df, group_cols, value_col, probs)
    groups = list(group_cols)
    keyed = groups or ["_rl_g"]
    base = df if groups else df.withColumn("_rl_g", F.lit(0))
    cnt = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    v = (base.select(*keyed, F.col(value_col).cast("double").alias("_v"),
                     *([weight_col] if weight_col else []))
         .where(F.col("_v").isNotNull()))
    if distinct and weight_col:
        v = v.select(*keyed, "_v", F.col(weight_col).cast("bigint").alias("_c"))
    else:
        v = v.groupBy(*keyed, "_v").agg(cnt.cast("bigint").alias("_c"))
    rt = running_totals(v, ["_v"], ["_c"], keyed, buckets, totals={"_c": "_n"})

    def at(k: Column) -> Column:  # the value at position k (from 0)
        return F.max(F.when((F.col("cum__c") - F.col("_c") <= k) & (k < F.col("cum__c")), F.col("_v")))

    place = [(F.col("_n") - 1).cast("double") * dbl(p) for p in probs]
    picked = rt.groupBy(*keyed).agg(
        F.max("_n").alias("_n"),
        *[at(F.floor(h)).alias(f"_lo{i}") for i, h in enumerate(place)],
        *[at(F.ceil(h)).alias(f"_hi{i}") for i, h in enumerate(place)])
    found = [F.struct(F.lit(i).alias("pidx"), dbl(p).alias("prob"), (
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (h - F.floor(h))).alias("q"))
        for i, (p, h) in enumerate(zip(probs, place))]
    return picked.select(*groups, F.explode(F.array(*found)).alias("_f")).select(*groups, "_f.*")


def exact_percentile_rows(df: DataFrame, group_cols: Sequence[str], value_col: str,
                          probs: Sequence[float], buckets: int | None = None,
                          weight_col: str | None = None, distinct: bool = False) -> list:
    """``exact_percentiles`` collected as tuples; for groups that are features of a fit."""
    return [tuple(r) for r in exact_percentiles(df, group_cols, value_col, probs, buckets,
                                                weight_col, distinct).collect()]


def approx_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                       probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """One-pass sketch variant (rank error within 1/accuracy); same output."""
    agg = df.groupBy(*group_cols).agg(F.percentile_approx(
        F.col(value_col).cast("double"), [float(p) for p in probs], accuracy).alias("_qs"))
    return agg.select(*group_cols, F.posexplode("_qs").alias("pidx", "q")).withColumn(
        "prob", F.element_at(F.array(*[dbl(p) for p in probs]), F.col("pidx") + 1))


def percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                probs: Sequence[float], exact: bool = True) -> DataFrame:
    if exact:
        return exact_percentiles(df, group_cols, value_col, probs)
    return approx_percentiles(df, group_cols, value_col, probs)
