"""Binning, weight of evidence and information value for all features at once.

The training rows are scanned twice whatever the number of numeric features:
unpivoted to (feature, value, y) for sketches, and as columns for the values near the
wanted quantiles (``quantiles``), all values of features that have few, and
the counts between, which together give the counts of the bins.  The fitted encoder is small (at most ``len(probs)+1``
bins per numeric feature, ``discrete_max`` values per discrete one) and is
applied as literal expressions: no join, stays in whole-stage codegen.
Categorical levels are the only part whose size depends on the data; their
table is joined, with a broadcast hint behind a check of its size.

Two conventions (parameters, defaults = first pipeline):
- ``smoothed``: WoE = ln(share_good / share_bad) with (n + 0.5) / (N + 0.5),
  every bin (also empty ones) counts in IV; bins left-closed.
- ``floor``: WoE = ln(share_bad / share_good) with shares floored at 1e-6,
  IV over non-empty bins; bins right-closed, lowest included; always deciles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import count_le, count_lt, dbl, round_half_up
from ..session import materialize
from . import quantiles as Q
from .ordered import row_positions

FEW_VALUES = 64  # by estimate; all values of such features are counted
BROADCAST_LEVELS_MAX = 100_000  # a larger table of levels is joined without a broadcast hint
SHARE_FLOOR = 1e-6
TABLE_SCHEMA = ("feature string, type string, bin int, level string, lo double, hi double, n bigint, "
                "n_pos bigint, n_neg bigint, woe double, iv_part double")
TABLE_COLUMNS = [c.split()[0] for c in TABLE_SCHEMA.split(", ")]


@dataclass
class FeatureBins:
    feature: str
    kind: str  # numeric | discrete_numeric
    edges: list[float] = field(default_factory=list)  # inner edges, numeric
    values: list = field(default_factory=list)  # sorted values, discrete
    woe: list[float] = field(default_factory=list)  # by bin index
    iv: float = 0.0

    @property
    def n_bins(self) -> int:
        if self.kind == "numeric":
            return len(self.edges) + 1
        return len(self.values)


@dataclass
class CategoryBins:
    """A categorical feature: its levels stay a table, whose size depends on the data."""

    feature: str
    table: DataFrame  # rows of ``Encoder.rows``
    n_bins: int
    first: float  # WoE of bin 0, for levels not seen
    iv: float = 0.0
    kind: str = "categorical"

    def _ordered(self, column: str) -> list:
        return [r[0] for r in sorted(self.table.select(column, "level").collect(), key=lambda r: (r[1] is not None, r[1]))]

    @property
    def values(self) -> list:
        """Levels in order of bin; read to the driver, to look at features of few levels."""
        return self._ordered("level")

    @property
    def woe(self) -> list[float]:
        """WoE in order of bin; as ``values``."""
        return self._ordered("woe")


@dataclass
class Encoder:
    bins: dict[str, FeatureBins | CategoryBins]
    rows: DataFrame  # feature, type, bin, level, lo, hi, n, n_pos, n_neg, woe, iv_part; levels have no bin
    convention: str
    closed: str

    @property
    def table(self) -> DataFrame:
        """``rows`` with the levels numbered in order, across tasks as they grow with the data."""
        level = F.col("type") == "categorical"
        if not any(fb.kind == "categorical" for fb in self.bins.values()):
            return self.rows
        ranked = row_positions(self.rows.where(level), ["level"], ["feature"]).withColumn(
            "bin", (F.col("rn") - 1).cast("int")).select(*TABLE_COLUMNS)
        return self.rows.where(~level).unionByName(ranked)

    def iv_frame(self) -> DataFrame:
        return self.rows.groupBy("feature", "type").agg(F.sum("iv_part").alias("iv"))


def numeric_long(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    cast = df.select(F.col(target).cast("bigint").alias("_y"),
                     *[F.col(c).cast("double").alias(c) for c in features])
    return cast.unpivot(["_y"], list(features), "feature", "value")


def level_counts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    cast = df.select(F.col(target).cast("bigint").alias("_y"),
                     *[F.col(c).cast("string").alias(c) for c in features])
    return cast.unpivot(["_y"], list(features), "feature", "level").groupBy(
        "feature", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("n_pos"))


def _near_values(wide: DataFrame, features: Sequence[str], ends: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """feature (its place), _step, _v, _c, n_pos as ``quantiles.kept_values`` has them, from columns; nulls have _step -1.

    ``ends`` holds the lower and upper ends of each feature's brackets.  A batch leaves a row per gap and
    distinct value inside a bracket; Spark adds them up.
    """
    lows = [np.sort(np.array(ends[f][0], float)) for f in features]
    highs = [np.sort(np.array(ends[f][1], float)) for f in features]  # NaN, last, is above every value

    def run(batches):
        for b in batches:
            label = b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(float)
            found = []
            for i, (low, high) in enumerate(zip(lows, highs)):
                col, y = b.column(i + 1), label
                if col.null_count:
                    known = col.is_valid().to_numpy(zero_copy_only=False)
                    found.append((i, [-1], [None], [col.null_count], [y[~known].sum()]))
                    col, y = col.drop_null(), y[known]
                v = col.to_numpy(zero_copy_only=False)
                above, past = np.searchsorted(low, v, "right"), np.searchsorted(high, v, "left")
                inside = above > past
                gaps = (above + past)[~inside]
                n, pos = np.bincount(gaps), np.bincount(gaps, y[~inside])
                met = np.flatnonzero(n)
                found.append((i, met, [None] * len(met), n[met], pos[met]))
                values, first, at = np.unique(v[inside], return_index=True, return_inverse=True)
                found.append((i, (above + past)[inside][first], values, np.bincount(at), np.bincount(at, y[inside])))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int32()),
                pa.concat_arrays([pa.array(f[1], pa.int32()) for f in found]),
                pa.concat_arrays([pa.array(f[2], pa.float64()) for f in found]),
                *[pa.concat_arrays([pa.array(np.asarray(f[c]).astype("int64")) for f in found]) for c in (3, 4)]],
                names=["place", "_step", "_v", "_c", "n_pos"])

    rows = wide.select("_y", *features).mapInArrow(run, "place int, _step int, _v double, _c bigint, n_pos bigint")
    return rows.groupBy("place", "_step", "_v").agg(F.sum("_c").alias("_c"), F.sum("n_pos").alias("n_pos"))


class NumericSketch:
    """Range, distinct values, quantiles and counts of numeric features, from two passes over the rows.

    The first pass sketches all features.  The second keeps the values near
    the wanted quantiles and all values of the features that have few, and
    counts the others between: that also gives the bins between quantiles.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], target: str, probs: Sequence[float]):
        value = F.col("value")
        self.probs = list(probs)
        long = numeric_long(df, features, target)
        wide = df.select(F.col(target).cast("bigint").alias("_y"), *[F.col(c).cast("double").alias(c) for c in features])
        sketches = Q.sketch(long, ["feature"], "value", mn=F.min(value), mx=F.max(value),
                            k=F.approx_count_distinct(value, 0.02))
        few = F.col("k") <= FEW_VALUES
        self.values, self.quantiles = {}, {}
        self._kept: dict[str, tuple] = {}  # by feature: kept rows, lower and upper ends of the brackets
        rows = {r["feature"]: r for r in sketches.select("feature", "mn", "mx", "k", few.alias("few")).collect()}
        self.range = {f: (r["mn"], r["mx"]) for f, r in rows.items()}
        left = set(rows)
        for error in Q.ERRORS:
            again = sorted(left)
            bounds = {r["feature"]: r for r in Q.brackets(
                sketches.where(F.col("feature").isin(again)), ["feature"], probs, error, few).collect()}
            m = range(len(self.probs))
            ends = {f: ([bounds[f][f"_lo{i}"] for i in m], [bounds[f][f"_hi{i}"] for i in m]) for f in again}
            at = F.col("place") + 1
            all_ = materialize(_near_values(wide, again, ends).select(
                F.element_at(F.array(*[F.lit(f) for f in again]), at).alias("feature"),
                F.element_at(F.array(*[F.lit(bounds[f]["_n"]).cast("bigint") for f in again]), at).alias("_n"),
                "_step", "_v", "_c", "n_pos"), "kept") if again else None
            if all_ is None:
                break
            kept = all_.where(F.col("_step") >= 0)
            for r in Q.pick(kept, ["feature"], probs).collect():
                found = [r[f"_q{i}"] for i in range(len(self.probs))]
                if None not in found:
                    self.quantiles[r["feature"]] = found
                    self._kept[r["feature"]] = (all_, *ends[r["feature"]])
                    left.discard(r["feature"])
            small = sorted(f for f in rows if rows[f]["few"] and f not in self.values)
            if small:  # a feature of few values has all of them here: FEW_VALUES and the estimate's error bound the rows
                for f in small:
                    self.values[f] = []
                for r in kept.where(F.col("feature").isin(small) & F.col("_v").isNotNull()).collect():
                    self.values[r["feature"]].append((r["_v"], r["_c"], r["n_pos"]))
            if not left:
                break

    def bin_counts(self, edges: dict[str, list[float]], closed: str, decimals: int | None) -> tuple[dict, list[str]]:
        """(feature, bin): (n, n_pos) of the bins between ``edges``, and the features for which the rows must be read.

        An edge lies in the bracket of its quantile, so every gap between brackets is in one bin.  If rounding
        moved one out of its bracket, the gap's rows may be in two.
        """
        known: dict[int, list[str]] = {}
        bins = {}
        for f, cuts in edges.items():
            if f not in self._kept:
                continue
            kept, low, high = self._kept[f]
            mn, mx = self.range[f]
            q = [x if decimals is None else round_half_up(x, decimals) for x in self.quantiles[f]]
            if any(mn < raw < mx and (x < lo or x > hi) for raw, x, lo, hi in zip(self.quantiles[f], q, low, high)):
                continue
            # the gap after i brackets lies above the edges up to quantile i - 1 and below the others
            of_gap = [0] + [sum(e <= x for e in cuts) for x in q]
            inside = (count_le if closed == "left" else count_lt)(F.col("_v"), cuts)
            bins[f] = F.when(F.col("_step") < 0, F.lit(len(cuts))).when(
                F.col("_v").isNull(), F.element_at(F.array(*[F.lit(i) for i in of_gap]), F.floor(F.greatest(
                    F.col("_step"), F.lit(0)) / 2).cast("int") + 1)).otherwise(inside)
            known.setdefault(id(kept), []).append(f)
        got = {}
        for names in known.values():
            of = F
            for f in names:
                of = of.when(F.col("feature") == f, bins[f])
            kept = self._kept[names[0]][0].where(F.col("feature").isin(names))
            got |= {(r["feature"], r["bin"]): (r["n"], r["n_pos"]) for r in kept.groupBy(
                "feature", of.cast("int").alias("bin")).agg(F.sum("_c").alias("n"), F.sum("n_pos").alias("n_pos")).collect()}
        return got, [f for f in edges if f not in bins]

    def edges(self, decimals: int | None = None) -> dict[str, list[float]]:
        """Distinct quantiles strictly inside (min, max); ``decimals`` rounds them
        (half up), e.g. to compare two engines."""
        out = {}
        for f, found in self.quantiles.items():
            mn, mx = self.range[f]
            inside = {q if decimals is None else round_half_up(q, decimals) for q in found if mn < q < mx}
            if inside:
                out[f] = sorted(inside)
        return out


def _woe_columns(counts: DataFrame, totals: DataFrame, convention: str, floored: str,
                 decimals: int | None) -> DataFrame:
    """Add n_neg, woe and iv_part to a (feature, bin, n, n_pos) table.

    ``totals`` has one row for each feature of the caller's list, and so a
    size that is known.
    """
    c = (counts.withColumn("n_neg", F.col("n") - F.col("n_pos"))
         .join(F.broadcast(totals), "feature"))
    if convention == "smoothed":
        sp = (F.col("n_pos") + dbl(0.5)) / (F.greatest(F.col("_P"), F.lit(1)) + dbl(0.5))
        sn = (F.col("n_neg") + dbl(0.5)) / (F.greatest(F.col("_N"), F.lit(1)) + dbl(0.5))
        woe = F.ln(sn / sp)
        part = (sn - sp) * woe
    elif convention == "floor":
        def share(n: str, total: str) -> Column:
            got = F.when(F.col(total) > 0, F.col(n) / F.col(total))
            if floored == "zeros":
                return F.when(F.col(n) > 0, got).otherwise(dbl(SHARE_FLOOR))
            return F.greatest(got, dbl(SHARE_FLOOR))

        sp, sn = share("n_pos", "_P"), share("n_neg", "_N")
        woe = F.ln(sp / sn)
        one_class = (F.col("_P") == 0) | (F.col("_N") == 0)
        woe = F.when(one_class, dbl(0)).otherwise(woe)
        part = F.when(one_class | (F.col("n") == 0), dbl(0)).otherwise((sp - sn) * woe)
    else:
        raise ValueError(convention)
    return c.withColumn("woe", woe if decimals is None else F.round(woe, decimals)).withColumn(
        "iv_part", part).select(*TABLE_COLUMNS)


def _class_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature").agg(F.sum("n_pos").alias("_P"),
                                         F.sum(F.col("n") - F.col("n_pos")).alias("_N"))


def _totals_of_rows(train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``_class_totals`` of features of which every row counts: the same for all."""
    pos = F.sum(F.col(target).cast("bigint"))
    all_ = train.agg(F.coalesce(pos, F.lit(0)).alias("_P"), (F.count(F.lit(1)) - F.coalesce(pos, F.lit(0))).alias("_N"))
    return all_.select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"), "_P", "_N")


def _numeric_counts(train: DataFrame, target: str, numeric: Sequence[str], probs: Sequence[float], discrete_max: int,
                    closed: str, edge_decimals: int | None) -> tuple[dict, list[tuple]]:
    """Bins of the numeric features, and rows of ``TABLE_SCHEMA`` up to n_pos."""
    found = NumericSketch(train, numeric, target, probs)
    bins: dict[str, FeatureBins] = {}
    rows = []
    for f in numeric:
        values = sorted(found.values.get(f, []))
        if 0 < len(values) <= discrete_max:
            bins[f] = FeatureBins(f, "discrete_numeric", values=[v for v, _, _ in values])
            rows += [(f, "discrete_numeric", i, str(v), v, v, n, pos) for i, (v, n, pos) in enumerate(values)]
    cont = [f for f in numeric if f not in bins]
    if cont:
        edges = found.edges(edge_decimals)
        for f in cont:
            bins[f] = FeatureBins(f, "numeric", edges=edges.get(f, []))
        got, unknown = found.bin_counts({f: bins[f].edges for f in cont}, closed, edge_decimals)
        if unknown:
            # binned before it is unpivoted and aggregated: a row per feature and bin leaves a task
            cmp = count_le if closed == "left" else count_lt
            wide = train.select(F.col(target).cast("bigint").alias("_y"), *[
                F.when(F.col(f).isNull(), F.lit(len(bins[f].edges))).otherwise(cmp(F.col(f).cast("double"), bins[f].edges))
                .cast("int").alias(f) for f in unknown])
            got |= {(r["feature"], r["bin"]): (r["n"], r["n_pos"]) for r in wide.unpivot(["_y"], unknown, "feature", "bin")
                    .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("n_pos")).collect()}
        for f in cont:
            e = [-math.inf, *bins[f].edges, math.inf]
            rows += [(f, "numeric", i, None, float(e[i]), float(e[i + 1]), *got.get((f, i), (0, 0)))
                     for i in range(len(e) - 1)]
    return bins, rows


def fit_encoder(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                target: str = "y", n_bins: int = 10, discrete_max: int = 8,
                convention: str = "smoothed", closed: str = "left", floored: str = "all",
                edge_decimals: int | None = None, woe_decimals: int | None = None) -> Encoder:
    """Fit bins + WoE on the training rows for every feature in one pass.

    A NULL of a feature with few values has no bin of its own: it takes no
    part in the fit and is encoded as bin 0, like a value not seen in the fit.
    ``floored`` (``floor`` convention): ``all`` raises every share to the
    floor, ``zeros`` only replaces shares that are zero.  ``edge_decimals``
    and ``woe_decimals`` round edges and WoE; by default nothing is rounded.
    """
    spark = train.sparkSession
    probs = [i / n_bins for i in range(1, n_bins)]
    numeric, categorical = list(numeric), list(categorical)
    bins: dict = {}
    full = None
    if numeric:
        bins, known = _numeric_counts(train, target, numeric, probs, discrete_max, closed, edge_decimals)
        # features x bins, both bounded by parameters: kept local
        local = spark.createDataFrame(known, TABLE_SCHEMA.split(", n_neg")[0])
        rows = _woe_columns(local, _class_totals(local), convention, floored, woe_decimals).collect()
        by_f: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: (r["feature"], r["bin"])):
            by_f.setdefault(r["feature"], []).append(r)
        for f, fb in bins.items():
            fb.woe = [r["woe"] for r in by_f.get(f, [])]
            fb.iv = float(sum(r["iv_part"] for r in by_f.get(f, [])))
        full = spark.createDataFrame([tuple(r) for r in rows], TABLE_SCHEMA)
    if categorical:
        # levels grow with the data: written once, never collected, numbered only where they are shown
        counts = level_counts(train, categorical, target).select(
            "feature", F.lit("categorical").alias("type"), F.lit(None).cast("int").alias("bin"), "level",
            F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
            F.col("n").cast("bigint").alias("n"), F.col("n_pos").cast("bigint").alias("n_pos"))
        # totals per feature come from the rows, so that the counts are made once
        totals = _totals_of_rows(train, categorical, target)
        table = materialize(_woe_columns(counts, totals, convention, floored, woe_decimals), "encoder")
        seen = {r["feature"]: r for r in table.groupBy("feature").agg(
            F.count(F.lit(1)).alias("k"), F.sum("iv_part").alias("iv"),
            F.min(F.struct("level", "woe"))["woe"].alias("first")).collect()}
        for f in categorical:
            r = seen.get(f)
            bins[f] = CategoryBins(f, table.where(F.col("feature") == f), r["k"] if r else 0,
                                   r["first"] if r else 0.0, float(r["iv"]) if r else 0.0)
        full = table if full is None else full.unionByName(table)
    return Encoder(bins, full, convention, closed)


def bin_column(fb: FeatureBins, x: Column, closed: str = "left") -> Column:
    """Bin index of ``x`` under a fitted numeric feature (unseen values -> bin 0)."""
    if fb.kind == "numeric":
        if closed == "left":
            return F.when(x.isNull(), F.lit(len(fb.edges))).otherwise(count_le(x, fb.edges))
        return F.least(count_lt(x, fb.edges), F.lit(max(fb.n_bins - 1, 0)))
    if fb.kind == "discrete_numeric":
        return F.when(x.isin(fb.values), count_lt(x, fb.values)).otherwise(F.lit(0))
    raise ValueError(f"{fb.feature}: levels are a table; use transform")


def woe_column(fb: FeatureBins, x: Column, closed: str = "left") -> Column:
    """WoE of a numeric feature as one expression: a chain that ends at the value's bin (as ``bin_column``)."""
    if not fb.woe:
        return dbl(0.0)
    if fb.kind == "discrete_numeric":
        tests, rest = [(x == F.lit(v), w) for v, w in zip(fb.values, fb.woe)], fb.woe[0]
    elif fb.kind != "numeric":
        raise ValueError(f"{fb.feature}: levels are a table; use transform")
    elif closed == "left":  # a NULL or NaN is below no edge: last bin
        tests, rest = [(x < dbl(e), w) for e, w in zip(fb.edges, fb.woe)], fb.woe[-1]
    else:  # a NULL is above no edge: first bin
        tests, rest = [(x > dbl(e), w) for e, w in zip(reversed(fb.edges), reversed(fb.woe))], fb.woe[0]
    out = F
    for test, w in tests:
        out = out.when(test, dbl(w))
    return out.otherwise(dbl(rest)) if tests else dbl(rest)


def transform(df: DataFrame, enc: Encoder, features: Sequence[str], prefix: str = "woe_",
              keep: Sequence[str] = ()) -> DataFrame:
    """Replace features by their WoE: literal lookups, and a join per categorical feature.

    A level not seen in the fit takes the WoE of bin 0; a NULL that was seen
    is a level of its own.
    """
    cols = [F.col(c) for c in keep]
    for i, f in enumerate(features):
        fb = enc.bins[f]
        if fb.kind != "categorical":
            cols.append(woe_column(fb, F.col(f), enc.closed).alias(prefix + f))
            continue
        level, woe = f"_rl_level{i}", f"_rl_woe{i}"
        table = fb.table.select(F.col("level").alias(level), F.col("woe").alias(woe))
        if fb.n_bins <= BROADCAST_LEVELS_MAX:
            table = F.broadcast(table)
        df = df.join(table, F.col(f).cast("string").eqNullSafe(F.col(level)), "left")
        cols.append(F.coalesce(woe, dbl(fb.first)).alias(prefix + f))
    return df.select(*cols)
