"""Scalar column expressions used by the scorecard operators.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# Master rating scale: upper cut points and grade labels, in order.
GRADE_EDGES = [0.005, 0.01, 0.025, 0.05, 0.08, 0.12, 0.18, 0.28, 1.0]
GRADE_LABELS = ["A1", "A2", "A3", "B1", "B2", "B3", "C1", "C2", "C3"]
# Information value cut-offs (useless / weak / medium / strong / suspicious)
# and the screening threshold; stability cut-offs for PSI.
IV_STRENGTH_CUTS = [0.02, 0.1, 0.3, 0.5]
IV_THRESHOLD = 0.02
PSI_CUTS = [0.10, 0.25]
# Probability clip used by log-loss and logit.
PROB_EPS = 1e-15
# ---------------------------------------------------------------------------


def dbl(v) -> Column:
    """A double literal (Spark reads bare decimals such as 0.55 as DECIMAL)."""
    return F.lit(float(v)).cast("double")


def sigmoid(x: Column) -> Column:
    return dbl(1.0) / (dbl(1.0) + F.exp(-x))


def clip_prob(p: Column, eps: float = PROB_EPS) -> Column:
    return F.least(F.greatest(p, dbl(eps)), dbl(1.0 - eps))


def logit(p: Column, eps: float = PROB_EPS) -> Column:
    """log(p / (1 - p)) with p clipped so ln never sees 0 (NULL in Spark)."""
    pc = clip_prob(p, eps)
    return F.ln(pc / (dbl(1.0) - pc))


def clip_lower(c: Column, lower: float) -> Column:
    """pandas ``clip(lower=..)``: NULL stays NULL (``greatest`` would drop it)."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(c.cast("double"), dbl(lower)))


def annuity(amount: Column, rate_pct: Column, n_months: Column) -> Column:
    """Monthly annuity payment a*r/(1-(1+r)^-n), r = rate_pct/1200.

    A zero rate is 0/0 in the closed form; the limit a/n is returned instead.
    A term of 0 has no payment: NULL.
    """
    r = rate_pct.cast("double") / dbl(100.0) / dbl(12.0)
    n = n_months.cast("double")
    closed = F.try_divide(amount * r, dbl(1.0) - F.pow(dbl(1.0) + r, -n))
    return F.when(r == 0, F.try_divide(amount, n)).otherwise(closed)


def count_le(x: Column, edges: Sequence[float]) -> Column:
    """Number of edges <= x (left-closed bin index over inner edges)."""
    if not edges:
        return F.lit(0)
    terms = [F.when(x >= dbl(e), 1).otherwise(0) for e in edges]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def count_lt(x: Column, edges: Sequence[float]) -> Column:
    """Number of edges < x (right-closed bin index, lowest bin inclusive)."""
    if not edges:
        return F.lit(0)
    terms = [F.when(x > dbl(e), 1).otherwise(0) for e in edges]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def grade_index(p: Column, edges: Sequence[float] = GRADE_EDGES) -> Column:
    """``searchsorted(edges, p, side='right')`` clipped to the last grade."""
    return F.least(count_le(p, edges), F.lit(len(edges) - 1))


def grade_label(p: Column, edges: Sequence[float] = GRADE_EDGES,
                labels: Sequence[str] = GRADE_LABELS) -> Column:
    ix = F.least(count_le(p, edges), F.lit(len(labels) - 1))
    return F.element_at(F.array(*[F.lit(s) for s in labels]), ix + 1)


def iv_strength(iv: Column) -> Column:
    c = IV_STRENGTH_CUTS
    return (F.when(iv < c[0], "useless").when(iv < c[1], "weak").when(iv < c[2], "medium")
            .when(iv < c[3], "strong").otherwise("suspicious"))


def psi_verdict(psi: Column) -> Column:
    return F.when(psi < PSI_CUTS[0], "stable").when(psi < PSI_CUTS[1], "moderate").otherwise(
        "shift")


def r6(c: Column) -> Column:
    return F.round(c, 6)


def nearest_whole(x: Column) -> Column:
    """``round(x)`` of a double as bigint, ties away from zero, without decimal numbers.

    The part after the point is exact, and only a tie prints as one.
    """
    whole = x.cast("bigint")
    part = x - whole.cast("double")
    return whole + F.when(part >= 0.5, 1).when(part <= -0.5, -1).otherwise(0)


def round_double(x: Column, d: int) -> Column:
    """``F.round(x, d)`` of a double, through decimal numbers only where the digits after the last come near a tie.

    Below 10^12 the scaled value is off by less than 0.0003, so farther from a tie its nearest whole number
    is the rounded one, and the quotient of two whole doubles is the double nearest to it.  ``x`` is used
    more than once: give it as a column.
    """
    scaled = x * dbl(10 ** d)
    whole = F.rint(scaled)
    sure = (F.abs(scaled) < dbl(1e12)) & (F.abs(scaled - whole) < dbl(0.499))
    return F.when(sure, whole.cast("bigint").cast("double") / dbl(10 ** d)).otherwise(F.round(x, d))


def round_half_up(x: float, d: int) -> float:
    """Driver-side twin of Spark's ``round`` on a double: HALF_UP applied to
    the shortest decimal form, so collected values round as in SQL."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP))


def join_null_safe(left, right, keys, how: str = "inner"):
    """Equality join on ``keys`` in which NULL keys meet; the left side's keys stay."""
    right = right.select(*[F.col(k).alias(f"_ns_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"_ns_{k}"])
        cond = c if cond is None else cond & c
    return left.join(right, cond, how).drop(*[f"_ns_{k}" for k in keys])
