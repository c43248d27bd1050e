"""DuckDB SQL text for the oracle checks, built from the same configuration.

These strings are test oracles only (the library never runs them): each one
restates a query of ``plans.queries`` in plain SQL over the pre-registered
tables, so the driver can compare results engine against engine.
"""

from __future__ import annotations

from ..sources.tables import LOAN_SQL
from . import scorecard as S


def _loan_ctes() -> str:
    body = LOAN_SQL.strip()
    assert body.startswith("WITH ")
    cut = body.index("\nSELECT loan_id, vintage")
    return body[5:cut].rstrip() + ",\nloan AS (" + body[cut + 1:] + ")"


def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def d(v) -> str:
    return f"CAST({float(v)!r} AS double)"


def cohort_case(col: str = "vintage") -> str:
    return (f"CASE WHEN {col} IN {in_list(S.TRAIN_VINTAGES)} THEN 'TRAIN' "
            f"WHEN {col} IN {in_list(S.VAL_VINTAGES)} THEN 'VAL' "
            f"WHEN {col} >= {q(S.OOT_FROM)} THEN 'OOT' END")


def prep_ctes() -> str:
    med_cols = ", ".join(f"round(quantile_cont({c}, 0.5), 6) AS m_{c}" for c in S.MEDIAN_IMPUTED)
    inc = "CASE WHEN acctbal IS NULL THEN NULL ELSE greatest(acctbal, CAST(1 AS double)) END"
    r = "(rate_pct / CAST(100 AS double) / CAST(12 AS double))"
    return f""",
p0 AS (SELECT *, {cohort_case()} AS cohort, CAST(substr(vintage, 1, 4) AS INTEGER) AS period,
       CAST(acctbal IS NULL AS INTEGER) AS acctbal_missing,
       CAST(avg_qty IS NULL AS INTEGER) AS lines_missing FROM loan),
med AS (SELECT vintage, {med_cols} FROM loan GROUP BY vintage),
p1 AS (SELECT p0.loan_id, p0.vintage, cohort, period, y, loan_amount,
       coalesce(acctbal, m_acctbal) AS acctbal, segment, priority,
       coalesce(n_lines, CAST(0 AS BIGINT)) AS n_lines, coalesce(avg_qty, m_avg_qty) AS avg_qty,
       coalesce(max_disc, CAST(0 AS double)) AS max_disc, coalesce(avg_tax, m_avg_tax) AS avg_tax,
       n_returns, acctbal_missing, lines_missing
       FROM p0 LEFT JOIN med ON p0.vintage = med.vintage),
p2 AS (SELECT *, CASE WHEN n_lines > 4 THEN 60 ELSE 36 END AS term,
       CAST(8 AS double) + CAST(100 AS double) * avg_tax AS rate_pct FROM p1),
p3 AS (SELECT *, round(CASE WHEN {r} = 0 THEN loan_amount / CAST(term AS double)
       ELSE loan_amount * {r} / (CAST(1 AS double) - pow(CAST(1 AS double) + {r}, -CAST(term AS double))) END, 6)
       AS payment FROM p2),
prep AS (SELECT *, round(loan_amount / {inc}, 6) AS loan_to_income,
       round(payment * CAST(12 AS double) / {inc}, 6) AS payment_to_income,
       round(ln(CAST(1 AS double) + loan_amount), 6) AS log_loan_amount FROM p3)"""


def base(*extra: str, prep: bool = True) -> str:
    """WITH loan [, prep ...] [, extra ...]"""
    s = "WITH " + _loan_ctes()
    if prep:
        s += prep_ctes()
    for e in extra:
        s += ",\n" + e
    return s


def union_long(features, value_fmt: str, where: str, src: str = "prep",
               extra_cols: str = "y") -> str:
    parts = [f"SELECT {extra_cols}, {q(f)} AS feature, {value_fmt.format(c=f)} AS value "
             f"FROM {src} WHERE {where}" for f in features]
    return "\nUNION ALL ".join(parts)


def deciles_list(n_bins: int = 10) -> str:
    return "[" + ", ".join(repr(i / n_bins) for i in range(1, n_bins)) + "]"


def edge_ctes(features, where: str = "cohort = 'TRAIN'", src: str = "prep", prefix: str = "",
              discrete_max: int = 8, n_bins: int = 10) -> list[str]:
    """{prefix}tl (long train rows), {prefix}ed (feature, k, mn, mx, edges)."""
    p = prefix
    return [
        f"{p}tl AS ({union_long(features, 'CAST({c} AS double)', where, src)})",
        f"""{p}fs AS (SELECT feature, count(DISTINCT value) AS k, min(value) AS mn,
              max(value) AS mx, quantile_cont(value, {deciles_list(n_bins)}) AS qs
              FROM {p}tl GROUP BY feature)""",
        f"""{p}ed AS (SELECT feature, k, mn, mx, CASE WHEN k <= {discrete_max} THEN 'discrete_numeric'
              ELSE 'numeric' END AS type,
              list_sort(list_distinct(list_transform(list_filter(qs, lambda x: x > mn AND x < mx),
                                                     lambda x: round(x, 9)))) AS edges
              FROM {p}fs)""",
    ]


def woe_smoothed_ctes(prefix: str = "", discrete_max: int = 8) -> list[str]:
    """From {p}tl/{p}ed and categorical long {p}tc: {p}wb(feature,type,bin,n,n_pos,n_neg,woe,iv_part)."""
    p = prefix
    return [
        f"""{p}tb AS (SELECT t.feature, t.y, t.value, e.type,
              CASE WHEN e.type = 'discrete_numeric'
                   THEN dense_rank() OVER (PARTITION BY t.feature ORDER BY t.value) - 1
                   WHEN t.value IS NULL THEN len(e.edges)
                   ELSE len(list_filter(e.edges, lambda x: x <= t.value)) END AS bin
              FROM {p}tl t JOIN {p}ed e ON t.feature = e.feature)""",
        f"""{p}cn AS (SELECT feature, type, bin, count(*) AS n, sum(y) AS n_pos
              FROM {p}tb GROUP BY feature, type, bin)""",
        f"""{p}sp AS (SELECT feature, type, unnest(range(0, len(edges) + 1)) AS bin FROM {p}ed
              WHERE type = 'numeric')""",
        f"""{p}cc AS (SELECT feature, 'categorical' AS type,
              dense_rank() OVER (PARTITION BY feature ORDER BY level) - 1 AS bin, n, n_pos FROM
              (SELECT feature, level, count(*) AS n, sum(y) AS n_pos FROM {p}tc GROUP BY feature, level))""",
        f"""{p}ca AS (SELECT sp.feature, sp.type, CAST(sp.bin AS BIGINT) AS bin,
                   coalesce(cn.n, 0) AS n, coalesce(cn.n_pos, 0) AS n_pos
              FROM {p}sp sp LEFT JOIN {p}cn cn ON sp.feature = cn.feature AND sp.bin = cn.bin
              UNION ALL SELECT feature, type, CAST(bin AS BIGINT), n, n_pos FROM {p}cn
              WHERE type = 'discrete_numeric'
              UNION ALL SELECT feature, type, CAST(bin AS BIGINT), n, n_pos FROM {p}cc)""",
        f"""{p}tt AS (SELECT feature, sum(n_pos) AS P, sum(n - n_pos) AS N FROM {p}ca GROUP BY feature)""",
        f"""{p}sh AS (SELECT a.*, a.n - a.n_pos AS n_neg,
              (a.n_pos + CAST(0.5 AS double)) / (greatest(t.P, 1) + CAST(0.5 AS double)) AS s_pos,
              (a.n - a.n_pos + CAST(0.5 AS double)) / (greatest(t.N, 1) + CAST(0.5 AS double)) AS s_neg
              FROM {p}ca a JOIN {p}tt t ON a.feature = t.feature)""",
        f"""{p}wb AS MATERIALIZED (SELECT feature, type, bin, n, n_pos, n_neg, round(ln(s_neg / s_pos), 9) AS woe,
              (s_neg - s_pos) * ln(s_neg / s_pos) AS iv_part FROM {p}sh)""",
    ]


def categorical_long(features, where: str = "cohort = 'TRAIN'", src: str = "prep",
                     prefix: str = "") -> str:
    parts = [f"SELECT y, {q(f)} AS feature, CAST({f} AS varchar) AS level FROM {src} WHERE {where}"
             for f in features]
    return f"{prefix}tc AS (" + "\nUNION ALL ".join(parts) + ")"


def scorecard_woe_ctes() -> list[str]:
    return [*edge_ctes(S.NUMERIC), categorical_long(S.CATEGORICAL), *woe_smoothed_ctes()]


def all_rows_woe_ctes(features, categorical) -> list[str]:
    """WoE of every loan (all cohorts) for ``features``: aw(loan_id, feature, woe)."""
    num = [f for f in features if f not in categorical]
    cat = [f for f in features if f in categorical]
    out = ["dvals AS (SELECT t.feature, list_sort(list(DISTINCT t.value)) AS vals FROM tl t "
           "JOIN ed e ON t.feature = e.feature WHERE e.type = 'discrete_numeric' "
           "AND t.value IS NOT NULL GROUP BY t.feature)",
           "cl AS (SELECT feature, level, dense_rank() OVER (PARTITION BY feature ORDER BY level) - 1"
           " AS bin FROM (SELECT DISTINCT feature, level FROM tc))"]
    parts = []
    if num:
        out.append(f"al AS ({union_long(num, 'CAST({c} AS double)', 'TRUE', extra_cols='loan_id')})")
        out.append("""ab AS (SELECT a.loan_id, a.feature,
              CASE WHEN e.type = 'discrete_numeric' THEN
                     CASE WHEN list_contains(dv.vals, a.value)
                          THEN len(list_filter(dv.vals, lambda v: v < a.value)) ELSE 0 END
                   WHEN a.value IS NULL THEN len(e.edges)
                   ELSE len(list_filter(e.edges, lambda x: x <= a.value)) END AS bin
              FROM al a JOIN ed e ON a.feature = e.feature
              LEFT JOIN dvals dv ON a.feature = dv.feature)""")
        parts.append("SELECT ab.loan_id, ab.feature, wb.woe FROM ab JOIN wb "
                     "ON ab.feature = wb.feature AND ab.bin = wb.bin")
    if cat:
        sel = "\nUNION ALL ".join(
            f"SELECT loan_id, {q(f)} AS feature, CAST({f} AS varchar) AS level FROM prep"
            for f in cat)
        out.append(f"acl AS ({sel})")
        out.append("""acb AS (SELECT a.loan_id, a.feature, coalesce(cl.bin, 0) AS bin FROM acl a
              LEFT JOIN cl ON a.feature = cl.feature AND a.level = cl.level)""")
        parts.append("SELECT acb.loan_id, acb.feature, wb.woe FROM acb JOIN wb "
                     "ON acb.feature = wb.feature AND acb.bin = wb.bin")
    out.append("aw AS (" + "\nUNION ALL ".join(parts) + ")")
    return out


def scored_ctes(steps: int | None = None) -> list[str]:
    """... -> gr(loan_id, cohort, y, p, p_cal, grade) and cal(c, t)."""
    from ..functions.expr import GRADE_EDGES, GRADE_LABELS, PROB_EPS
    steps = steps or S.CALIBRATION_STEPS
    feats = list(S.SCORE_WEIGHTS)
    piv = ", ".join(f"max(CASE WHEN feature = {q(f)} THEN woe END) AS w_{f}" for f in feats)
    z = d(S.SCORE_INTERCEPT)
    for f, w in S.SCORE_WEIGHTS.items():
        z = f"{z} + {d(w)} * w_{f}"
    z = "(" + z.replace(f"{d(S.SCORE_INTERCEPT)} + ", f"{d(S.SCORE_INTERCEPT)} + ", 1) + ")"
    # left-to-right evaluation, same association as the Spark expression
    eps = d(PROB_EPS)
    one_m = d(1.0 - PROB_EPS)
    pc = f"least(greatest(p, {eps}), {one_m})"
    out = [*scorecard_woe_ctes(), *all_rows_woe_ctes(feats, S.CATEGORICAL),
           f"pw AS (SELECT loan_id, {piv} FROM aw GROUP BY loan_id)",
           f"""sc AS (SELECT prep.loan_id, prep.cohort, prep.y,
                  round(CAST(1 AS double) / (CAST(1 AS double) + exp(-{z})), 9) AS p
                  FROM prep JOIN pw ON prep.loan_id = pw.loan_id)""",
           f"lz AS MATERIALIZED (SELECT *, ln({pc} / (CAST(1 AS double) - {pc})) AS z FROM sc)",
           "tg AS (SELECT avg(y) AS t FROM lz WHERE cohort = 'TRAIN')",
           "c0 AS (SELECT CAST(0 AS double) AS c)"]
    for i in range(1, steps + 1):
        out.append(f"""c{i} AS (SELECT greatest(CAST(-10 AS double), least(CAST(10 AS double),
              c - (avg(s) - t) / avg(s * (CAST(1 AS double) - s)))) AS c FROM
              (SELECT CAST(1 AS double) / (CAST(1 AS double) + exp(-(lz.z + c{i - 1}.c))) AS s,
                      c{i - 1}.c AS c, tg.t AS t FROM lz, c{i - 1}, tg WHERE lz.cohort = 'TRAIN')
              GROUP BY c, t)""")
    labels = "[" + ", ".join(q(s) for s in GRADE_LABELS) + "]"
    edges = "[" + ", ".join(repr(float(e)) for e in GRADE_EDGES) + "]"
    out += [f"cal AS (SELECT round(c{steps}.c, 9) AS c, tg.t AS t FROM c{steps}, tg)",
            """pc AS (SELECT lz.loan_id, lz.cohort, lz.y, lz.p, lz.z,
                  round(CAST(1 AS double) / (CAST(1 AS double) + exp(-(lz.z + cal.c))), 9) AS p_cal
                  FROM lz, cal)""",
            f"""gr AS MATERIALIZED (SELECT *, {labels}[least(len(list_filter({edges}, lambda e: e <= p_cal)),
                  {len(GRADE_LABELS) - 1}) + 1] AS grade FROM pc)"""]
    return out
