"""the fitted scorecard's tables read each loan once; bins come from the pass that finds the quantiles."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.expr import nearest_whole, round_double
from riskloom.operators import woe as W
from riskloom.operators.rank_metrics import threshold_sweep
from riskloom.operators.stability import psi_grades
from riskloom.plans import models_q as MQ


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    r = random.Random(3)
    rows = [(r.choice(["TRAIN", "VAL", "OOT", None]), r.random(), r.randrange(2), r.choice(["A", "B", "C", None]))
            for _ in range(400)]
    path = str(tmp_path_factory.mktemp("scored") / "t")
    spark.createDataFrame(rows, "cohort string, p double, y int, grade string").write.parquet(path)
    return spark.read.parquet(path), rows


def test_threshold_sweep_scans_once(scored):
    df, rows = scored
    got = threshold_sweep(df, ["cohort"], "p", "y")
    assert scans(got) == 1
    found = {(r["cohort"], r["k"]): (r["tp"], r["fp"]) for r in got.collect()}
    assert len(found) == 800
    for cohort in ("TRAIN", None):
        for k in (0, 57, 199):
            t = k / 199
            want = tuple(sum(c == cohort and p >= t and y == label for c, p, y, _ in rows) for label in (1, 0))
            assert found[cohort, k] == want


def test_psi_grades_scans_once(scored):
    df, rows = scored
    got = psi_grades(df, "cohort", "grade", "TRAIN", ["VAL", "OOT"])
    assert scans(got) == 1
    found = {r["actual_split"]: r["psi"] for r in got.collect()}

    def share(split, grade):
        own = [g for c, _, _, g in rows if c == split]
        return own.count(grade) / len(own)

    assert set(found) == {"VAL", "OOT"}
    for s in found:
        want = sum((share(s, g) - share("TRAIN", g)) * math.log(share(s, g) / share("TRAIN", g)) for g in "ABC")
        assert found[s] == pytest.approx(want, abs=1e-12)


def test_scores_are_not_written_for_one_scan(spark, monkeypatch):
    written = []
    real = MQ.materialize
    monkeypatch.setattr(MQ, "materialize", lambda df, name: written.append(name) or real(df, name))
    MQ.FittedScorecard(spark, "/root/testdata/sf0.001")
    assert written == ["woe"]
    MQ.FittedScorecard(spark, "/root/testdata/sf0.001", written=True)
    assert written == ["woe", "woe", "scored"]


@pytest.mark.parametrize("closed", ["left", "right"])
def test_bins_from_the_quantile_pass(spark, closed):
    r = np.random.default_rng(5)
    n = 30_000
    a = r.normal(size=n)
    b = np.where(r.random(n) < 0.4, 0.5, r.random(n))  # a value that holds several quantiles
    few = r.integers(0, 3, n)
    y = (r.random(n) < 0.3).astype(int)
    rows = [(None if i % 97 == 0 else float("nan") if i % 89 == 0 else float(a[i]), float(b[i]), int(few[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, few int, y int").repartition(4)
    found = W.NumericSketch(df, ["b", "few"], "y", [i / 10 for i in range(1, 10)])
    edges = found.edges(9)
    assert edges["b"] == sorted(set(np.round(np.quantile(b, [i / 10 for i in range(1, 10)]), 9)) - {b.min(), b.max()})
    counts, unknown = found.bin_counts(edges, closed, 9)
    assert unknown == []
    at = np.searchsorted(edges["b"], b, "right" if closed == "left" else "left")
    assert {k: v for k, v in counts.items() if k[0] == "b"} == {
        ("b", i): (int((at == i).sum()), int(y[at == i].sum())) for i in set(at.tolist())}
    # nulls and NaN: in the last bin
    enc = W.fit_encoder(df, ["a", "b", "few"], [], "y", closed=closed)
    cuts = enc.bins["a"].edges
    want = {}
    for x, _, _, label in rows:
        i = len(cuts) if x is None or math.isnan(x) else int(np.searchsorted(cuts, x, "right" if closed == "left" else "left"))
        have = want.setdefault(i, [0, 0])
        have[0] += 1
        have[1] += label
    got = {r["bin"]: [r["n"], r["n_pos"]] for r in enc.rows.where("feature = 'a'").collect()}
    assert got == want


def test_an_edge_rounded_out_of_its_bracket_is_read_from_rows(spark):
    x = [i * 1e-6 for i in range(20_000)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(x)], "x double, y int")
    found = W.NumericSketch(df, ["x"], "y", [0.3])
    cuts = found.edges(2)
    assert cuts == {"x": [0.01]}  # the quantile is 0.006
    assert found.bin_counts(cuts, "left", 2) == ({}, ["x"])
    enc = W.fit_encoder(df, ["x"], [], "y", n_bins=2, edge_decimals=2)
    n = {r["bin"]: r["n"] for r in enc.rows.collect()}
    assert enc.bins["x"].edges == [0.01] and n == {0: sum(v < 0.01 for v in x), 1: sum(v >= 0.01 for v in x)}


def test_rounding_without_decimals(spark):
    r = np.random.default_rng(1)
    v = [*(r.normal(size=3000) * 1e3), *(k / 2e6 for k in range(-2000, 2000)), *(k / 2e9 for k in range(2000)),
         *(k + 0.5 for k in range(-500, 500)), *(10 ** r.uniform(5, 14, 2000))]
    v += [np.nextafter(x, s) for x in v[::3] for s in (-1e9, 1e9)]
    v = [float(x) for x in v]
    df = spark.createDataFrame([(x,) for x in [*v, None, float("nan"), float("inf"), -0.0, -1e-9, 1e300]], "x double")
    for d in (6, 9):
        both = df.select(F.round("x", d).cast("string").alias("a"), round_double(F.col("x"), d).cast("string").alias("b"))
        assert both.where("not (a <=> b)").isEmpty()
    df = df.where("x is null or abs(x) < 1e15")
    assert df.where(~F.round("x").cast("bigint").eqNullSafe(nearest_whole(F.col("x")))).isEmpty()
