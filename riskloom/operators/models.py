"""Model jobs: logistic models, Spark ML boosted trees, and batched greedy search.

A logistic fit takes Newton steps: a pass over blocks of rows, which the
executors keep as arrays, adds up loss, gradient and Hessian.  Trees are Spark
ML's.  The greedy forward search for logistic models does
not run one Spark job per (candidate, fold) fit: every Newton pass computes
gradient and Hessian for all candidates and folds of a step at once
(``mapInPandas`` partial sums over Arrow batches, then one ``groupBy``), and
a single scoring pass evaluates all of them with the exact rank metrics.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.expr import dbl
from ..session import cut_lineage
from . import boosting as B
from .calibration import prob_losses
from .rank_metrics import cumulative, rank_summary

FEATURES_COL = "_rl_features"


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Feature vectors."""
    va = VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="keep")
    return va.transform(df).select(*keep, FEATURES_COL)


@dataclass(frozen=True)
class LogisticFit:
    """Weights of a logistic model; applied as one expression."""

    coefficients: DenseVector
    intercept: float

    def probability(self, features: Sequence[str]) -> Column:
        z = dbl(float(self.intercept))
        for f, w in zip(features, self.coefficients.toArray()):
            z = z + dbl(float(w)) * F.coalesce(F.col(f).cast("double"), dbl(float("nan")))
        return dbl(1) / (dbl(1) + F.exp(-z))


def _blocks(df: DataFrame, features: Sequence[str], label: str):
    """Blocks of rows, (columns with a first one of ones, label), kept by the executors as compact arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([c.to_numpy(zero_copy_only=False) for c in b.columns], float)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["x"])

    width = len(features) + 1

    def load(row):
        x = np.frombuffer(row.x).reshape(width, -1)
        return np.vstack([np.ones(x.shape[1]), x[:-1]]), x[-1]

    cols = [*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y")]
    return df.select(*cols).mapInArrow(run, "x binary").rdd.map(load).persist(StorageLevel.MEMORY_AND_DISK)


def _loss_sums(blocks, w: np.ndarray) -> np.ndarray:
    """Rows, sum of labels, log-loss, gradient and Hessian (flat) over all rows: a few numbers leave a task."""
    def partial(it):
        total = 0
        for x, y in it:
            z = w @ x
            p = 1.0 / (1.0 + np.exp(-z))
            total = total + np.concatenate([[len(y), y.sum(), (np.logaddexp(0, z) - y * z).sum()], x @ (p - y),
                                            ((x * (p * (1 - p))) @ x.T).ravel()])
        return [] if np.isscalar(total) else [total]

    sums = blocks.mapPartitions(partial)
    return sums.treeAggregate(np.zeros(3 + len(w) + len(w) ** 2), np.add, np.add, 2)


def _model_step(w: np.ndarray, g: np.ndarray, h: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """Minimum of the quadratic model at ``w`` plus sum(l1 * abs).

    Accelerated soft-thresholded steps find which weights are zero, a solve gives the others. Where the
    minimum is not unique (equal columns), both take the shortest way, so equal columns get equal weights.
    """
    if not l1.any():
        return w + np.linalg.lstsq(h, -g, rcond=1e-13)[0]
    top = max(float(np.linalg.eigvalsh(h)[-1]), 1e-300)
    shrink = lambda v: np.sign(v) * np.maximum(np.abs(v) - l1 / top, 0)
    v, ahead, t = w.copy(), w.copy(), 1.0
    for _ in range(20_000):
        new = shrink(ahead - (g + h @ (ahead - w)) / top)
        if (ahead - new) @ (new - v) > 0:  # overshot: start the momentum again
            t = 1.0
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = new + (last - 1) / t * (new - v)
        moved, v = np.abs(new - v).max(), new
        if moved < 1e-12:
            break
    on = (v != 0) | (l1 == 0)
    slope = (g + h @ (v - w) + l1 * np.sign(v))[on]
    exact = v.copy()
    exact[on] -= np.linalg.lstsq(h[np.ix_(on, on)], slope, rcond=1e-10)[0]
    return exact if (np.sign(exact) == np.sign(v))[l1 > 0].all() else v


def logistic(df: DataFrame, features: Sequence[str], label: str = "y", C: float = 1.0,
             penalty: str = "l2", n_rows: int | None = None, max_iter: int = 1000,
             penalise_intercept: bool = False, tol: float = 1e-9) -> LogisticFit:
    """Logistic regression with the objective C * sum(logloss) + penalty(w).

    Newton steps (for L1: of the quadratic model with the penalty as it is): a pass adds up loss, gradient
    and Hessian of all rows, so about ten passes reach the optimum whatever the number of rows.  A step
    that does not lower the objective is halved.  The intercept is penalised like a weight only if
    ``penalise_intercept``.  With rows of one class a free intercept is infinite.  ``n_rows`` scales the
    penalty for that many rows.
    """
    features = list(features)
    blocks, k = _blocks(df, features, label), len(features) + 1
    w = np.zeros(k)
    weigh = np.ones(k)
    weigh[0] = float(penalise_intercept)

    def at(w):
        sums = _loss_sums(blocks, w)
        if not np.isfinite(sums).all():
            raise ValueError("features and labels must be finite numbers")
        return sums[0], sums[1], sums[2], sums[3:3 + k].copy(), sums[3 + k:].reshape(k, k).copy()

    try:
        n, ones, loss, g, h = at(w)
        if not n:
            raise ValueError("no rows to fit")
        if not penalise_intercept and ones in (0, n):
            return LogisticFit(DenseVector(w[1:]), float("inf") if ones else float("-inf"))
        strength = weigh * n / (C * (n if n_rows is None else max(n_rows, 1)))
        l1, l2 = (strength, 0 * weigh) if penalty == "l1" else (0 * weigh, strength)
        cost = lambda w, loss: loss + l1 @ np.abs(w) + l2 @ (w * w) / 2
        for _ in range(max_iter):
            step = _model_step(w, g + l2 * w, h + np.diag(l2), l1) - w
            small = np.abs(step).max() < tol
            before = cost(w, loss)
            while True:
                new = w + step
                if small:
                    break
                _, _, loss, g, h = at(new)
                if cost(new, loss) <= before * (1 + 1e-12) or np.abs(step).max() < tol:
                    break
                step = step / 2
            w = new
            if small:
                break
    finally:
        blocks.unpersist()
    return LogisticFit(DenseVector(w[1:]), float(w[0]))


def coefficients(model, features: Sequence[str]) -> list[tuple[str, float]]:
    return [("(intercept)", float(model.intercept))] + [
        (f, float(c)) for f, c in zip(features, model.coefficients.toArray())]


def predict_proba(model, df: DataFrame, features: Sequence[str], keep: Sequence[str],
                  p_col: str = "p") -> DataFrame:
    if isinstance(model, LogisticFit):
        return df.select(*keep, model.probability(features).alias(p_col))
    out = model.transform(assemble(df, features, keep))
    return out.select(*keep, vector_to_array("probability")[1].alias(p_col))


def gbt(df: DataFrame, features: Sequence[str], label: str = "y", max_iter: int = 100,
        max_depth: int = 4, step: float = 0.05, subsample: float = 0.8,
        col_sample: str = "0.8", pos_weight: float = 1.0, seed: int = 42, max_bins: int = 32):
    """Boosted trees (first-order, per-node column sampling); ``pos_weight``
    weights class 1 like ``scale_pos_weight``."""
    data = assemble(df.withColumn("_rl_w", F.when(F.col(label) == 1, dbl(pos_weight))
                                  .otherwise(dbl(1.0))), features,
                    [F.col(label).cast("double").alias("_rl_label"), "_rl_w"])
    est = GBTClassifier(featuresCol=FEATURES_COL, labelCol="_rl_label", weightCol="_rl_w",
                        maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                        subsamplingRate=subsample, featureSubsetStrategy=col_sample, seed=seed,
                        maxBins=max_bins)
    return est.fit(data)


def combined_criterion(scored: DataFrame, group_cols: Sequence[str], p: str = "p",
                       y: str = "y", alpha: float = 0.5) -> DataFrame:
    """alpha * Gini + (1 - alpha) * Brier skill per group (exact AUC)."""
    rk = rank_summary(cumulative(scored, group_cols, p, y), group_cols)
    ls = prob_losses(scored, group_cols, p, y)
    return rk.join(ls, list(group_cols)).select(
        *group_cols, "gini", "brier_skill",
        (dbl(alpha) * F.col("gini") + dbl(1 - alpha) * F.col("brier_skill")).alias("score"))


# ---------------------------------------------------------------------------
# Batched forward selection for L2 logistic models
# ---------------------------------------------------------------------------

def _design(xall: np.ndarray, rows: np.ndarray, pool: list[str], cols: list[str]) -> np.ndarray:
    """[1, x_cols] for the selected rows of a batch already converted to numpy."""
    idx = [pool.index(c) for c in cols]
    x = xall[rows][:, idx] if idx else np.empty((int(rows.sum()), 0))
    return np.column_stack([np.ones(len(x)), x])


def _partial_sums(spec: dict, pool: list[str]):
    """Gradients and Hessians of a task's rows: added up over its batches, a row per number at the end."""
    at = {key: [0, *(1 + pool.index(c) for c in cols)] for key, (cols, _) in spec.items()}

    def partial(it):
        total: dict = {}
        for pdf in it:
            y = pdf["y"].to_numpy(dtype=float)
            fold = pdf["fold"].to_numpy()
            xall = np.column_stack([np.ones(len(y)), pdf[pool].to_numpy(dtype=float)])
            known = {f: (xall[fold != f], y[fold != f]) for f in {f for _, f in spec}}
            for key, (_, w) in spec.items():
                x, label = known[key[1]]
                if not len(x):
                    continue
                x = x[:, at[key]]
                p = 1.0 / (1.0 + np.exp(-(x @ np.asarray(w))))
                vals = np.concatenate([x.T @ (p - label), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
                total[key] = total[key] + vals if key in total else vals
        if total:
            yield pd.concat([pd.DataFrame({"cand": cand, "fold": f, "ix": np.arange(len(vals), dtype=np.int32), "v": vals})
                             for (cand, f), vals in total.items()], ignore_index=True)

    return partial


def _newton_pass(data: DataFrame, pool: list[str], models: dict, n_folds: int) -> dict:
    """Gradient and Hessian of sum(logloss) on each model's training folds."""
    partial = _partial_sums({k: (cols, w.tolist()) for k, (cols, w) in models.items()}, pool)
    agg = (data.mapInPandas(partial, "cand string, fold int, ix int, v double")
           .groupBy("cand", "fold", "ix").agg(F.sum("v").alias("v")).collect())
    sums: dict = {}
    for r in agg:
        sums.setdefault((r["cand"], r["fold"]), {})[r["ix"]] = r["v"]
    return sums


def _fit_all(data: DataFrame, pool: list[str], cand_cols: dict, n_folds: int, C: float,
             max_newton: int = 25, tol: float = 1e-10, warm: dict | None = None) -> dict:
    """Newton fits of every (candidate, fold) model; ``warm`` maps fold ->
    weights of the model chosen at the previous step, extended by a zero for
    the new feature (same optimum, fewer passes)."""
    def start(cols, f):
        w0 = np.zeros(len(cols) + 1)
        if warm and f in warm and len(warm[f]) == len(cols):
            w0[:len(cols)] = warm[f]
        return w0
    models = {(c, f): (cols, start(cols, f))
              for c, cols in cand_cols.items() for f in range(n_folds)}
    for _ in range(max_newton):
        sums = _newton_pass(data, pool, models, n_folds)
        worst = 0.0
        for key, (cols, w) in models.items():
            d = len(w)
            s = sums.get(key)
            if s is None:
                continue
            v = np.array([s.get(i, 0.0) for i in range(d + d * d)])
            g, h = v[:d].copy(), v[d:].reshape(d, d).copy()
            reg = np.ones(d) / C
            reg[0] = 0.0  # intercept not penalised
            g += reg * w
            h += np.diag(reg)
            step = np.linalg.solve(h, g)
            models[key] = (cols, w - step)
            worst = max(worst, float(np.max(np.abs(step))))
        if worst < tol:
            break
    return models


def _cv_scores(data: DataFrame, pool: list[str], models: dict, alpha: float) -> dict:
    spec = {k: (cols, w.tolist()) for k, (cols, w) in models.items()}

    def held_out(it):
        for pdf in it:
            fold = pdf["fold"].to_numpy()
            xall = pdf[pool].to_numpy(dtype=float)
            out = []
            for (cand, f), (cols, w) in spec.items():
                m = fold == f
                if not m.any():
                    continue
                x = _design(xall, m, pool, cols)
                p = 1.0 / (1.0 + np.exp(-(x @ np.asarray(w))))
                out.append(pd.DataFrame({"cand": cand, "fold": f, "p": p,
                                         "y": pdf["y"].to_numpy()[m].astype(np.int64)}))
            if out:
                yield pd.concat(out, ignore_index=True)

    scored = data.mapInPandas(held_out, "cand string, fold int, p double, y long")
    crit = combined_criterion(scored, ["cand", "fold"], "p", "y", alpha)
    per = crit.groupBy("cand").agg(F.avg("score").alias("score")).collect()
    return {r["cand"]: r["score"] for r in per}


def forward_logistic(data: DataFrame, pool: Sequence[str], max_features: int = 10,
                     n_folds: int = 5, C: float = 1.0, alpha: float = 0.5) -> list[tuple]:
    """Greedy forward selection by mean CV combined score; never stops early.

    ``data`` holds the pool features (already scaled), ``y`` and ``fold``.
    Each step fits every remaining candidate on every fold in one batch.
    Returns [(step, feature, score)].  The first candidate in pool order wins
    ties, as a strict ``>`` in a loop would.
    """
    pool = list(pool)
    data = cut_lineage(data.select(*pool, F.col("y").cast("long").alias("y"),
                                   F.col("fold").cast("int").alias("fold")))
    chosen: list[str] = []
    out = []
    warm: dict = {}
    for step in range(1, max_features + 1):
        remaining = [f for f in pool if f not in chosen]
        if not remaining:
            break
        cand_cols = {c: chosen + [c] for c in remaining}
        models = _fit_all(data, pool, cand_cols, n_folds, C, warm=warm)
        scores = _cv_scores(data, pool, models, alpha)
        best, best_score = None, -np.inf
        for c in remaining:
            s = scores.get(c)
            if s is not None and s > best_score:
                best, best_score = c, s
        if best is None:
            break
        chosen.append(best)
        warm = {f: models[(best, f)][1] for f in range(n_folds)}
        out.append((step, best, float(best_score)))
    return out


# ---------------------------------------------------------------------------
# Tree searches: all candidates, folds and weights grow in one chain of passes
# ---------------------------------------------------------------------------

def fold_scores(data: DataFrame, forest: B.Forest, models: Sequence[int], alpha: float) -> DataFrame:
    """model, gini, brier_skill, score on the fold that each model did not see (one rank pass for all)."""
    held = {forest.specs[m].name: forest.specs[m].held_out for m in models}
    own = F.create_map(*[x for n, f in held.items() for x in (F.lit(n), F.lit(f))])
    scored = B.score(data, forest, ["y", "fold"], models).where(F.col("fold") == own[F.col("model")])
    return combined_criterion(scored, ["model"], "p", "y", alpha)


def forward_gbt(data: DataFrame, pool: Sequence[str], max_features: int = 10, n_folds: int = 5,
                alpha: float = 0.5, settings: B.Settings | None = None, key: str = "loan_id") -> list[tuple]:
    """Greedy forward selection with boosted trees: [(step, feature, score)].

    ``data`` holds the pool features, ``y``, ``fold`` and the row key.  The
    models of a step (candidates x folds) grow in one chain of passes, over
    columns that are cut into bins once; the first candidate in pool order
    wins ties.
    """
    pool, settings = list(pool), settings or B.Settings()
    data = cut_lineage(data.select(key, *pool, "y", "fold"))
    edges = B.bin_edges(data, pool)
    chosen: list[str] = []
    out = []
    for step in range(1, max_features + 1):
        remaining = [f for f in pool if f not in chosen]
        if not remaining:
            break
        specs = [B.Spec(f"{c}/{f}", tuple(pool.index(x) for x in [*chosen, c]), held_out=f)
                 for c in remaining for f in range(n_folds)]
        forest = B.grow(data, pool, specs, settings, key, edges)
        rows = fold_scores(data, forest, range(len(specs)), alpha).select("model", "score").collect()
        per: dict[str, list] = {}
        for r in rows:
            if r["score"] is not None:
                per.setdefault(r["model"].rsplit("/", 1)[0], []).append(r["score"])
        best = max((c for c in remaining if c in per), key=lambda c: float(np.mean(per[c])), default=None)
        if best is None:
            break
        chosen.append(best)
        out.append((step, best, float(np.mean(per[best]))))
    return out


def tune_pos_weight(train: DataFrame, test: DataFrame, features: Sequence[str], weights: Sequence[float],
                    n_folds: int = 3, alpha: float = 0.5, settings: B.Settings | None = None,
                    key: str = "loan_id") -> list[tuple]:
    """For each class-1 weight: CV combined score on TRAIN folds, train and test
    Gini of a fit on all TRAIN rows: [(weight, cv_score, gini_train, gini_test)].

    The weights x (folds + 1) models grow in one chain of passes and are
    scored in one rank pass.  ``train`` needs a ``fold``.
    """
    features, settings = list(features), settings or B.Settings()
    train = cut_lineage(train.select(key, *features, "y", "fold"))
    every = tuple(range(len(features)))
    specs = [B.Spec(f"{i}/{f}", every, float(w), f) for i, w in enumerate(weights) for f in [B.NO_FOLD, *range(n_folds)]]
    forest = B.grow(train, features, specs, settings, key)
    rows = train.select(*features, "y", "fold").unionByName(
        test.select(*features, "y", F.lit(B.NO_FOLD).alias("fold")))  # a test row belongs to no fold
    scored = B.score(rows, forest, ["y", "fold"])
    name, held = F.substring_index("model", "/", 1), F.substring_index("model", "/", -1).cast("int")
    part = (F.when(held == F.col("fold"), F.when(held == B.NO_FOLD, "test").otherwise("cv"))
            .when(held == B.NO_FOLD, "train"))
    scored = scored.select(name.alias("weight"), part.alias("part"), held.alias("held"), "p", "y").where("part is not null")
    got: dict = {}
    for r in combined_criterion(scored, ["weight", "part", "held"], "p", "y", alpha).collect():
        got.setdefault((int(r["weight"]), r["part"]), []).append(r["score"] if r["part"] == "cv" else r["gini"])
    mean = lambda i, part: float(np.mean(got[i, part])) if None not in got.get((i, part), [None]) else float("nan")
    return [(float(w), mean(i, "cv"), mean(i, "train"), mean(i, "test")) for i, w in enumerate(weights)]


@dataclass(frozen=True)
class ModelRecord:
    """What a model family is fitted on: its name, features, encoder (None: raw columns) and kind."""

    name: str
    features: tuple[str, ...]
    encoder: object | None
    kind: str


def evaluate(scored: DataFrame, order: Sequence[str]) -> DataFrame:
    """A row per model: Gini, Brier, their gaps, test KS and log-loss; is_best by test Gini.

    ``scored`` holds (model, split, p, y) of all models with the splits train
    and test: one rank pass and one aggregate serve all of them.  ``order`` is
    that of the rows.
    """
    keys = ["model", "split"]
    rank = rank_summary(cumulative(scored, keys, "p", "y"), keys)
    both = rank.join(prob_losses(scored, keys, "p", "y"), keys)
    of = lambda split, c: F.max(F.when(F.col("split") == split, F.col(c)))
    wide = both.groupBy("model").agg(*[of(s, c).alias(f"{n}_{s}") for s in ("train", "test") for c, n in (
        ("gini", "gini"), ("brier", "brier"), ("ks_two_sided", "ks"), ("log_loss", "log_loss"))])
    best = wide.agg(F.max_by("model", F.struct("gini_test", -F.element_at(
        F.create_map(*[x for i, n in enumerate(order) for x in (F.lit(n), F.lit(i))]), F.col("model")))).alias("best"))
    return wide.join(best).select(
        "model", "gini_train", "gini_test", (F.col("gini_train") - F.col("gini_test")).alias("gini_gap"),
        "brier_train", "brier_test", (F.col("brier_test") - F.col("brier_train")).alias("brier_gap"),
        "ks_test", F.col("log_loss_test").alias("log_loss"), (F.col("model") == F.col("best")).alias("is_best"))
