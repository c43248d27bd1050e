"""Quantiles by sketch and refinement against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def values():
    rng = np.random.default_rng(2)
    return {"wide": rng.normal(size=60_000), "tied": np.repeat(rng.normal(size=30), 1000),
            "hot": np.where(rng.uniform(size=40_000) < 0.4, 1.5, rng.normal(size=40_000)),
            "one": np.full(500, 3.25), "single": np.array([7.0]), "two": np.array([1.0, 2.0]),
            "ends": np.array([-np.inf, 0.0, 1.0, np.inf] * 5), None: rng.exponential(size=3000)}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(g, float(x)) for g, v in values().items() for x in v] + [("wide", None), ("empty", None)]
    return spark.createDataFrame(rows, "g string, x double").repartition(6)


def check(rows, groups=None):
    got = {(r["g"], r["pidx"]): r["q"] for r in rows}
    want = {(g, i): np.quantile(v, p, method="linear") if np.isfinite(v).all() else None
            for g, v in values().items() for i, p in enumerate(PROBS)}
    assert got.keys() == want.keys()
    for k, w in want.items():
        if w is not None:
            assert abs(got[k] - w) <= 1e-12 * max(1, abs(w)), k


@pytest.mark.parametrize("errors, window_rows", [(Q.ERRORS, Q.WINDOW_ROWS), (Q.ERRORS, 10), ((0.0, 0.001, 1.0), 10 ** 6)])
def test_percentiles_against_numpy(table, errors, window_rows):
    """As delivered, ordered across tasks, and with brackets that miss at first."""
    check(Q.refined_percentiles(table, ["g"], "x", PROBS, errors, window_rows).collect())


def test_a_bracket_that_misses_is_seen(spark):
    df = spark.range(100_000).select(F.lit(0).alias("g"), F.col("id").cast("double").alias("x"))
    s = Q.sketch(df, ["g"], "x")
    off = Q.brackets(s, ["g"], [0.5], 0.01).withColumn("_lo0", F.col("_lo0") + 5000).withColumn("_hi0", F.col("_hi0") + 5000)
    kept = Q.kept_values(df, ["g"], "x", off, 1)
    assert Q.pick(kept, ["g"], [0.5]).first()["_q0"] is None
    kept = Q.kept_values(df, ["g"], "x", Q.brackets(s, ["g"], [0.5], Q.ERRORS[0]), 1)
    assert Q.pick(kept, ["g"], [0.5]).first()["_q0"] == 49_999.5
    assert kept.count() < 2000  # few values leave the tasks


def test_whole_table_and_empty_table(spark, table):
    wide = table.where("g = 'wide'")
    got = [r["q"] for r in Q.refined_percentiles(wide, [], "x", [0.3, 0.5]).orderBy("pidx").collect()]
    assert np.allclose(got, np.quantile(values()["wide"], [0.3, 0.5]), rtol=1e-12)
    assert Q.refined_percentiles(table.limit(0), ["g"], "x", PROBS).count() == 0


def test_no_exchange_by_range(table):
    wide = Q.wide_percentiles(table, ["g"], "x", PROBS)
    sketches = Q.sketch(table, ["g"], "x")
    plan = Q.brackets(sketches, ["g"], PROBS, Q.ERRORS[0])
    near = table.join(plan, "g").groupBy("g").count()
    assert "rangepartitioning" not in near._jdf.queryExecution().toString() and wide.count() == 8
