"""Code-pair queries (Q11) over the cohort's person-level diagnosis flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.stats import LN_TOL, log_factorial_sql
from cohortlens.operators import features as fe
from cohortlens.operators import pairs as pr
from cohortlens.plans import params as P
from cohortlens.plans.q_cohort import features, features_sql
from cohortlens.plans.registry import register

FLAGS = [f"icd9_{fe.code_token(c)}_{P.LOOKBACK_DAYS}d" for c in P.ICD_CODES]


def flag_table(spark, sf_dir):
    """Person-level diagnosis flags of the feature rows (evaluated once: the pair sums are written)."""
    return features(spark, sf_dir, hcpcs=(), pairs=(), demographics=False).select(S.PERSON, S.LABEL, S.INDEX_DATE, *FLAGS)


def sums(spark, sf_dir):
    return pr.pair_sums(flag_table(spark, sf_dir), FLAGS)


def counts(spark, sf_dir):
    return pr.counts_of(sums(spark, sf_dir), FLAGS)


_POS = " UNION ALL ".join(f"SELECT '{f}' AS code, {i} AS pos" for i, f in enumerate(FLAGS))
_LONG = " UNION ALL ".join(f"SELECT person_id, case_ind, '{f}' AS code, {f} AS v FROM ft" for f in FLAGS)
# ALL_SQL: every pair of flags; COUNTS_SQL: the pairs that some person has both of.
ALL_SQL = f"""
WITH ft AS ({features_sql(hcpcs=(), pairs=(), demographics=False)}),
pos AS ({_POS}),
lg AS (SELECT l.person_id, l.case_ind, l.code, p.pos, l.v FROM ({_LONG}) l JOIN pos p ON l.code = p.code),
cls AS (SELECT count(CASE WHEN case_ind = 1 THEN 1 END) AS n_pos,
               count(CASE WHEN case_ind = 0 THEN 1 END) AS n_neg FROM ft),
pr AS (SELECT a.code AS code1, b.code AS code2, a.pos AS pos1, b.pos AS pos2,
              sum(CASE WHEN a.case_ind = 1 THEN a.v ELSE 0 END) AS n1_pos,
              sum(CASE WHEN a.case_ind = 1 THEN b.v ELSE 0 END) AS n2_pos,
              sum(CASE WHEN a.case_ind = 1 THEN a.v * b.v ELSE 0 END) AS n11_pos,
              sum(CASE WHEN a.case_ind = 0 THEN a.v ELSE 0 END) AS n1_neg,
              sum(CASE WHEN a.case_ind = 0 THEN b.v ELSE 0 END) AS n2_neg,
              sum(CASE WHEN a.case_ind = 0 THEN a.v * b.v ELSE 0 END) AS n11_neg
       FROM lg a JOIN lg b ON a.person_id = b.person_id AND a.pos < b.pos
       GROUP BY 1, 2, 3, 4)
SELECT code1, code2, pos1, pos2, CAST(n_pos AS BIGINT) AS n_pos, CAST(n1_pos AS BIGINT) AS n1_pos,
       CAST(n2_pos AS BIGINT) AS n2_pos, CAST(n11_pos AS BIGINT) AS n11_pos, CAST(n_neg AS BIGINT) AS n_neg,
       CAST(n1_neg AS BIGINT) AS n1_neg, CAST(n2_neg AS BIGINT) AS n2_neg, CAST(n11_neg AS BIGINT) AS n11_neg
FROM pr, cls"""
COUNTS_SQL = f"SELECT * FROM ({ALL_SQL}) every WHERE n11_pos + n11_neg > 0"

PHI = """CASE WHEN sqrt(CAST(n1_pos AS DOUBLE) * (n_pos - n1_pos) * n2_pos * (n_pos - n2_pos)) > 0 THEN
  (CAST(n_pos AS DOUBLE) * n11_pos - CAST(n1_pos AS DOUBLE) * n2_pos)
  / sqrt(CAST(n1_pos AS DOUBLE) * (n_pos - n1_pos) * n2_pos * (n_pos - n2_pos)) END"""


def _mi_sql(n, n1, n2, n11):
    cells = [(f"({n11})", f"({n1})", f"({n2})"),
             (f"(({n1}) - ({n11}))", f"({n1})", f"(({n}) - ({n2}))"),
             (f"(({n2}) - ({n11}))", f"(({n}) - ({n1}))", f"({n2})"),
             (f"(({n}) - ({n1}) - ({n2}) + ({n11}))", f"(({n}) - ({n1}))", f"(({n}) - ({n2}))")]
    terms = [f"CASE WHEN {x} > 0 THEN ({x} / ({n})) * ln((({n}) * {x}) / ({a} * {b})) ELSE 0.0 END"
             for x, a, b in cells]
    return f"CASE WHEN ({n}) > 0 THEN 0.0 + {' + '.join(terms)} END"


MI_POS = _mi_sql("CAST(n_pos AS DOUBLE)", "CAST(n1_pos AS DOUBLE)", "CAST(n2_pos AS DOUBLE)",
                 "CAST(n11_pos AS DOUBLE)")

register("J11_pair_counts", COUNTS_SQL)(counts)


@register("A19_cooccur", f"WITH c AS ({COUNTS_SQL}) SELECT code1, code2, pos1, pos2, n11_pos AS cooccurrence_count FROM c")
def a19_cooccur(spark, sf_dir):
    return pr.cooccurrence(counts(spark, sf_dir))


def _corr_sql(counts_sql):
    return f"""WITH c AS ({counts_sql}), one AS (SELECT code1, code2, pos1, pos2, {PHI} AS correlation FROM c)
SELECT * FROM one UNION ALL SELECT code2, code1, pos2, pos1, correlation FROM one"""


CORR_SQL, CORR_ALL_SQL = _corr_sql(COUNTS_SQL), _corr_sql(ALL_SQL)


@register("X5_corr", CORR_SQL)
def x5_corr(spark, sf_dir):
    return pr.correlations(counts(spark, sf_dir))


@register("R4_top_corr", f"""WITH z AS ({CORR_ALL_SQL})
SELECT * FROM z ORDER BY correlation DESC NULLS LAST, pos1, pos2 LIMIT 20""")
def r4_top_corr(spark, sf_dir):
    return pr.top_correlations(sums(spark, sf_dir), FLAGS, 20)


@register("R5_lower", f"WITH z AS ({CORR_SQL}) SELECT * FROM z WHERE pos1 > pos2")
def r5_lower(spark, sf_dir):
    return pr.lower_triangle(counts(spark, sf_dir))


MI_SQL = f"WITH c AS ({COUNTS_SQL}) SELECT code1, code2, pos1, pos2, {MI_POS} AS mutual_info FROM c"
MI_ALL_SQL = f"WITH c AS ({ALL_SQL}) SELECT code1, code2, pos1, pos2, {MI_POS} AS mutual_info FROM c"


def _rounded(df, col="mutual_info", digits=10):
    """Only what is reported is rounded, after any ranking."""
    return df.withColumn(col, F.round(col, digits))


@register("X6_mi", f"SELECT * REPLACE (round(mutual_info, 10) AS mutual_info) FROM ({MI_SQL}) m")
def x6_mi(spark, sf_dir):
    return _rounded(pr.mutual_information(counts(spark, sf_dir)))


@register("X6_mi_top", f"""SELECT * REPLACE (round(mutual_info, 10) AS mutual_info) FROM (
  SELECT * FROM ({MI_ALL_SQL}) m ORDER BY mutual_info DESC NULLS LAST, pos1, pos2 LIMIT 20)""")
def x6_mi_top(spark, sf_dir):
    """The 20 pairs of highest mutual information among all pairs of codes."""
    return _rounded(pr.top_pairs(sums(spark, sf_dir), FLAGS, "mutual_info", 20))


@register("U3_combined", f"""
WITH c AS ({ALL_SQL}),
corr AS (SELECT code1, code2, 'correlation' AS method, 1 AS prio FROM ({CORR_ALL_SQL}) z
         ORDER BY correlation DESC NULLS LAST, pos1, pos2 LIMIT 20),
co AS (SELECT code1, code2, 'cooccurrence' AS method, 2 AS prio FROM c
       ORDER BY n11_pos DESC NULLS LAST, pos1, pos2 LIMIT 20),
mi AS (SELECT code1, code2, 'mutual_info' AS method, 3 AS prio FROM ({MI_ALL_SQL}) m
       ORDER BY mutual_info DESC NULLS LAST, pos1, pos2 LIMIT 20),
u AS (SELECT * FROM corr UNION ALL SELECT * FROM co UNION ALL SELECT * FROM mi)
SELECT code1, code2, arg_min(method, prio) AS method FROM u GROUP BY code1, code2""")
def u3_combined(spark, sf_dir):
    return pr.combined_top(sums(spark, sf_dir), FLAGS)


TABLE_SQL = f"""WITH c AS ({COUNTS_SQL})
SELECT code1, code2, pos1, pos2, n11_pos AS tp, n11_neg AS fp, n_pos - n11_pos AS fn, n_neg - n11_neg AS tn FROM c"""


@register("A20_pair_table", TABLE_SQL)
def a20_pair_table(spark, sf_dir):
    return pr.pair_table(counts(spark, sf_dir))


_D = "CAST({} AS DOUBLE)"
_tp, _fp, _fn, _tn = (_D.format(x) for x in ("tp", "fp", "fn", "tn"))


X7_SQL = f"""WITH t AS ({TABLE_SQL}),
s AS (SELECT code1, code2, tp, fp, fn, tn,
        CASE WHEN {_tp} + {_fp} > 0 THEN {_tp} / ({_tp} + {_fp}) ELSE 0.0 END AS PPV,
        CASE WHEN {_tp} + {_fn} > 0 THEN {_tp} / ({_tp} + {_fn}) ELSE 0.0 END AS prevalence_pos,
        CASE WHEN {_fp} + {_tn} > 0 THEN {_fp} / ({_fp} + {_tn}) ELSE 0.0 END AS prevalence_neg,
        CASE WHEN {_fn} > 0 THEN {_tp} / {_fn} ELSE 'Infinity'::DOUBLE END AS odds_pos,
        CASE WHEN {_tn} > 0 THEN {_fp} / {_tn} ELSE 'Infinity'::DOUBLE END AS odds_neg,
        {_mi_sql(f"{_tp} + {_fp} + {_fn} + {_tn}", f"{_tp} + {_fp}", f"{_tp} + {_fn}", _tp)} AS mutual_info
      FROM t)
SELECT code1, code2, tp, fp, fn, tn, PPV, prevalence_pos, prevalence_neg,
       prevalence_pos - prevalence_neg AS prevalence_diff,
       CASE WHEN odds_neg > 0 THEN odds_pos / odds_neg ELSE 'Infinity'::DOUBLE END AS odds_ratio, mutual_info
FROM s"""


@register("X7_pair_stats", f"SELECT * REPLACE (round(mutual_info, 10) AS mutual_info) FROM ({X7_SQL}) s")
def x7_pair_stats(spark, sf_dir):
    return _rounded(pr.pair_statistics(pr.pair_table(counts(spark, sf_dir)), p_values=False))


_LF = log_factorial_sql
FISHER_SQL = f"""WITH t AS ({TABLE_SQL}),
f AS (SELECT code1, code2, tp, fp, fn, tn, tp + fp AS r1, tp + fn AS c1, tp + fp + fn + tn AS n FROM t),
g AS (SELECT *, {_LF('r1')} + {_LF('n - r1')} + {_LF('c1')} + {_LF('n - c1')} - {_LF('n')} AS const FROM f),
sup AS (SELECT g.code1, g.code2, g.tp, x.k,
          const - ({_LF('x.k')} + {_LF('r1 - x.k')} + {_LF('c1 - x.k')} + {_LF('n - r1 - c1 + x.k')}) AS logp
        FROM g, LATERAL (SELECT unnest(range(greatest(0, r1 + c1 - n), least(r1, c1) + 1)) AS k) x),
obs AS (SELECT code1, code2, logp + {LN_TOL!r} AS cut FROM sup WHERE k = tp)
SELECT s.code1, s.code2, least(fsum(CASE WHEN s.logp <= o.cut THEN exp(s.logp) ELSE 0.0 END), 1.0) AS p_value
FROM sup s JOIN obs o ON s.code1 = o.code1 AND s.code2 = o.code2
GROUP BY s.code1, s.code2"""


def _with_p(spark, sf_dir):
    return pr.pair_statistics(pr.pair_table(counts(spark, sf_dir)), p_values=True)


@register("X8_fisher", f"SELECT code1, code2, round(p_value, 12) AS p_value FROM ({FISHER_SQL}) f")
def x8_fisher(spark, sf_dir):
    return _with_p(spark, sf_dir).select("code1", "code2", F.round("p_value", 12).alias("p_value"))


X9_SQL = f"""WITH z AS (SELECT a.*, b.p_value FROM ({X7_SQL}) a
                       JOIN ({FISHER_SQL}) b ON a.code1 = b.code1 AND a.code2 = b.code2)
SELECT * FROM z WHERE p_value < 0.05 AND PPV >= 0.5 AND odds_ratio > 2
UNION
SELECT * FROM (SELECT * FROM z ORDER BY p_value, code1, code2 LIMIT 20) top"""


@register("X9_select_pairs", f"""SELECT * REPLACE (round(p_value, 12) AS p_value, round(mutual_info, 10) AS mutual_info)
FROM ({X9_SQL}) z""")
def x9_select_pairs(spark, sf_dir):
    return _rounded(_rounded(pr.select_pairs(_with_p(spark, sf_dir))), "p_value", 12)
