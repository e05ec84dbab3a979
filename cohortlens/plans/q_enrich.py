"""Code enrichment queries (Q10) over the lookback window of the cohort."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import stats as st
from cohortlens.operators import enrich as en
from cohortlens.operators import features as fe
from cohortlens.plans import params as P
from cohortlens.plans.q_cohort import cohort_claims, index_dates, window_claims, window_sql
from cohortlens.plans.registry import register
from cohortlens.sources import driver

W = f"w AS ({window_sql()})"
LONG = "l AS (SELECT person_id, case_ind, unnest(icd_codes) AS code FROM w)"
PRES = "p AS (SELECT DISTINCT person_id, case_ind, code FROM l WHERE code IS NOT NULL)"
WIN_N = ("n AS (SELECT CAST(count(DISTINCT CASE WHEN case_ind = 1 THEN person_id END) AS DOUBLE) AS n_pos, "
         "CAST(count(DISTINCT CASE WHEN case_ind = 0 THEN person_id END) AS DOUBLE) AS n_neg FROM w)")


def _long(spark, sf_dir):
    return en.explode_codes(window_claims(spark, sf_dir))


@register("R2_explode", f"WITH {W} SELECT person_id, case_ind, unnest(icd_codes) AS code FROM w")
def r2_explode(spark, sf_dir):
    return _long(spark, sf_dir)


@register("A11_frequency", f"""WITH {W}, {LONG}
SELECT person_id, case_ind, code, count(*) AS frequency FROM l WHERE code IS NOT NULL GROUP BY ALL""")
def a11_frequency(spark, sf_dir):
    return en.frequency(_long(spark, sf_dir))


_PIV = ", ".join(f"max(CASE WHEN code = '{c}' THEN 1 ELSE 0 END) AS \"{c}\"" for c in P.ICD_CODES)
_FRQ = ", ".join(f"count(CASE WHEN code = '{c}' THEN 1 END) AS \"{c}\"" for c in P.ICD_CODES)


@register("A13_pivot_presence", f"""WITH {W}, {LONG}
SELECT person_id, case_ind, {_PIV} FROM l WHERE code IS NOT NULL GROUP BY person_id, case_ind""")
def a13_pivot_presence(spark, sf_dir):
    """The known codes' columns, then those of any other code of the window."""
    long = _long(spark, sf_dir)
    return en.pivot_wide(long, en.code_levels(long, P.ICD_CODES), "presence")


@register("A13_pivot_frequency", f"""WITH {W}, {LONG}
SELECT person_id, case_ind, {_FRQ} FROM l WHERE code IS NOT NULL GROUP BY person_id, case_ind""")
def a13_pivot_frequency(spark, sf_dir):
    long = _long(spark, sf_dir)
    return en.pivot_wide(long, en.code_levels(long, P.ICD_CODES), "frequency")


@register("A13_sparse", f"""WITH {W}, {LONG},
f AS (SELECT person_id, case_ind, code, CAST(count(*) AS INTEGER) AS v FROM l WHERE code IS NOT NULL GROUP BY ALL),
lv AS (SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS level, CAST(count(*) OVER () AS INTEGER) AS size
       FROM (SELECT DISTINCT code FROM f))
SELECT person_id, case_ind, max(size) AS size, list(level ORDER BY level) AS indices, list(v ORDER BY level) AS "values"
FROM f JOIN lv ON f.code = lv.code GROUP BY person_id, case_ind""")
def a13_sparse(spark, sf_dir):
    """One sparse row a person over the sorted code levels."""
    return en.pivot_sparse(_long(spark, sf_dir), "frequency")[1]


@register("A12_presence", f"WITH {W}, {LONG}, {PRES} SELECT * FROM p")
def a12_presence(spark, sf_dir):
    return en.presence(_long(spark, sf_dir))


A14_SQL = f"""WITH {W}, {LONG},
f AS (SELECT person_id, case_ind, code, count(*) AS frequency FROM l WHERE code IS NOT NULL GROUP BY ALL),
n AS (SELECT CAST(count(DISTINCT CASE WHEN case_ind = 1 THEN person_id END) AS DOUBLE) AS n_pos,
             CAST(count(DISTINCT CASE WHEN case_ind = 0 THEN person_id END) AS DOUBLE) AS n_neg FROM f),
pc AS (SELECT code, count(CASE WHEN case_ind = 1 THEN 1 END) AS pos_people,
              count(CASE WHEN case_ind = 0 THEN 1 END) AS neg_people,
              coalesce(sum(CASE WHEN case_ind = 1 THEN frequency END), 0) AS pos_freq,
              coalesce(sum(CASE WHEN case_ind = 0 THEN frequency END), 0) AS neg_freq
       FROM f GROUP BY code),
m AS (SELECT code, pos_people / n_pos AS pp, neg_people / n_neg AS pn,
             pos_freq / n_pos AS fp, neg_freq / n_neg AS fn FROM pc, n)
SELECT code, pp AS prev_pos, pn AS prev_neg, pp - pn AS prev_diff,
       CASE WHEN pn = 0 THEN NULL ELSE pp / pn END AS prev_ratio,
       fp AS freq_pos, fn AS freq_neg, fp - fn AS freq_diff,
       CASE WHEN fn = 0 THEN 'Infinity'::DOUBLE ELSE fp / fn END AS freq_ratio
FROM m"""


@register("A14_class_means", A14_SQL)
def a14_class_means(spark, sf_dir):
    return en.class_means(_long(spark, sf_dir))


@register("X4_screen", f"""WITH z AS ({A14_SQL})
SELECT code FROM z WHERE prev_diff > 0.01 AND prev_ratio > 2
UNION SELECT code FROM z WHERE freq_diff > 0.01 AND freq_ratio > 2""")
def x4_screen(spark, sf_dir):
    return en.screen_codes(en.class_means(_long(spark, sf_dir)))


@register("A15_class_avgs", f"""WITH {W},
per AS (SELECT person_id, case_ind, file_type, count(claim_id) AS claim_count,
               sum(CAST(claim_amt AS DECIMAL(18,2))) AS spend FROM w GROUP BY ALL)
SELECT case_ind, file_type, sum(claim_count) / count(*) AS avg_claim_count,
       CAST(sum(spend) AS DOUBLE) / count(*) AS avg_spend
FROM per GROUP BY ALL""")
def a15_class_avgs(spark, sf_dir):
    return en.class_averages(window_claims(spark, sf_dir, codes=False))


@register("A16_class_sizes", f"""WITH {W}
SELECT case_ind, count(DISTINCT person_id) AS people FROM w GROUP BY case_ind""")
def a16_class_sizes(spark, sf_dir):
    return (window_claims(spark, sf_dir, codes=False).select(S.PERSON, S.LABEL).distinct()
            .groupBy(S.LABEL).agg(F.count("*").alias("people")))


@register("A17_prevalence", f"""WITH {W}, {LONG}, {PRES}, {WIN_N},
pc AS (SELECT code, count(CASE WHEN case_ind = 1 THEN 1 END) AS np,
              count(CASE WHEN case_ind = 0 THEN 1 END) AS nn FROM p GROUP BY code)
SELECT code, np / n_pos AS prevalence_pos, nn / n_neg AS prevalence_neg,
       np / n_pos - nn / n_neg AS difference
FROM pc, n ORDER BY difference DESC, code LIMIT 10""")
def a17_prevalence(spark, sf_dir):
    return en.prevalence_by_class(window_claims(spark, sf_dir))


CONT_SQL = f"""WITH {W}, {LONG}, {PRES}, {WIN_N}
SELECT code, count(CASE WHEN case_ind = 1 THEN 1 END) AS pos_with_code,
       count(CASE WHEN case_ind = 0 THEN 1 END) AS neg_with_code,
       CAST(any_value(n_pos) AS BIGINT) AS n_pos, CAST(any_value(n_neg) AS BIGINT) AS n_neg
FROM p, n GROUP BY code"""


@register("A18_contingency", CONT_SQL)
def a18_contingency(spark, sf_dir):
    return en.contingency(window_claims(spark, sf_dir))


STATS_SQL = f"""WITH t AS ({CONT_SQL}),
v AS (SELECT code, pos_with_code, neg_with_code, n_pos, n_neg,
             CAST(pos_with_code AS DOUBLE) AS a, CAST(n_pos - pos_with_code AS DOUBLE) AS b,
             CAST(neg_with_code AS DOUBLE) AS c, CAST(n_neg - neg_with_code AS DOUBLE) AS d FROM t),
s AS (SELECT *, a + b + c + d AS nn, a + b AS r1, c + d AS r2, a + c AS c1, b + d AS c2,
             CASE WHEN n_pos > 0 THEN pos_with_code / n_pos ELSE 0.0 END AS pp,
             CASE WHEN n_neg > 0 THEN neg_with_code / n_neg ELSE 0.0 END AS pn FROM v),
g AS (SELECT *, greatest(abs(a * d - b * c) / nn - 0.5, 0.0) AS adj FROM s)
SELECT code, pp AS prevalence_positive, pn AS prevalence_negative, pp - pn AS prevalence_difference,
       CASE WHEN pn > 0 THEN pp / pn ELSE 'Infinity'::DOUBLE END AS prevalence_ratio,
       CASE WHEN b > 0 AND c > 0 THEN (a * d) / (b * c) ELSE 'Infinity'::DOUBLE END AS odds_ratio,
       CASE WHEN r1 > 0 AND r2 > 0 AND c1 > 0 AND c2 > 0 THEN
         adj * adj / (r1 * c1 / nn) + adj * adj / (r1 * c2 / nn) + adj * adj / (r2 * c1 / nn)
         + adj * adj / (r2 * c2 / nn) END AS chi2,
       pos_with_code, neg_with_code
FROM g"""


def _stats(spark, sf_dir, p_values=False):
    table = en.contingency(window_claims(spark, sf_dir))
    return en.code_statistics(table, p_values=p_values)


@register("X1_odds", f"SELECT code, odds_ratio, pos_with_code, neg_with_code FROM ({STATS_SQL}) z")
def x1_odds(spark, sf_dir):
    return _stats(spark, sf_dir).select("code", "odds_ratio", "pos_with_code", "neg_with_code")


@register("X2_code_stats", STATS_SQL)
def x2_code_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@register("X3_screen", f"""WITH z AS ({STATS_SQL})
SELECT * FROM z WHERE chi2 > {st.CHI2_CRIT_05}
  AND ((odds_ratio > 2 AND prevalence_difference > 0.01) OR (odds_ratio < 0.5 AND prevalence_difference < -0.01))""")
def x3_screen(spark, sf_dir):
    """Q10 report: screened with the chi-square p-value (UDF), p column dropped
    for the SQL comparison (equivalent to chi2 > 3.8415)."""
    return en.significance_screen(_stats(spark, sf_dir, p_values=True)).drop("p_value")


# erfc(sqrt(chi2 / 2)): the series below z = 2.5, the continued fraction above it
P_SQL = """CASE WHEN chi2 <= 0 THEN 1.0 WHEN sqrt(chi2 / 2) < 2.5 THEN 1.0 - 2.0 * sqrt(chi2 / 2) / sqrt(pi()) * exp(-chi2 / 2)
  * (1.0 + list_sum(list_transform(range(1, 81), lambda n: list_product(list_transform(range(1, n + 1),
      lambda m: chi2 / (2.0 * m + 1.0))))))
  ELSE exp(-chi2 / 2) / (sqrt(chi2 / 2) * sqrt(pi())) / list_reduce(list_reverse(range(1, 81))::DOUBLE[],
      lambda a, n: 1.0 + n / chi2 / a, 1.0::DOUBLE) END"""


def _report_sql(stats):
    return f"""SELECT *, round({P_SQL}, 12) AS p_value FROM ({stats}) z WHERE {P_SQL} < 0.05
  AND ((odds_ratio > 2 AND prevalence_difference > 0.01) OR (odds_ratio < 0.5 AND prevalence_difference < -0.01))"""


@register("Q10_enrichment_report", _report_sql(STATS_SQL))
def q10_enrichment_report(spark, sf_dir):
    """The full report with p-values."""
    out = en.significance_screen(_stats(spark, sf_dir, p_values=True))
    return out.withColumn("p_value", F.round("p_value", 12))


@register("X2_p_values", f"SELECT code, round({P_SQL}, 12) AS p_value FROM ({STATS_SQL}) z")
def x2_p_values(spark, sf_dir):
    """The chi-square p-value of every code, unscreened."""
    return _stats(spark, sf_dir, p_values=True).select("code", F.round("p_value", 12).alias("p_value"))


# ---- the same report on procedure codes -------------------------------------

def _proc(sql: str) -> str:
    return sql.replace("unnest(icd_codes)", "unnest(hcpcs_codes)")


def _proc_stats(spark, sf_dir, p_values=False):
    return en.code_statistics(en.contingency(window_claims(spark, sf_dir), codes=S.HCPCS), p_values=p_values)


@register("A14_class_means_proc", _proc(A14_SQL))
def a14_class_means_proc(spark, sf_dir):
    return en.class_means(en.explode_codes(window_claims(spark, sf_dir), S.HCPCS))


@register("A18_contingency_proc", _proc(CONT_SQL))
def a18_contingency_proc(spark, sf_dir):
    return en.contingency(window_claims(spark, sf_dir), codes=S.HCPCS)


@register("X2_code_stats_proc", _proc(STATS_SQL))
def x2_code_stats_proc(spark, sf_dir):
    return _proc_stats(spark, sf_dir)


@register("Q10_report_proc", _proc(_report_sql(STATS_SQL)))
def q10_report_proc(spark, sf_dir):
    out = en.significance_screen(_proc_stats(spark, sf_dir, p_values=True))
    return out.withColumn("p_value", F.round("p_value", 12))


# ---- a window that includes the index day: the case code itself is enriched --

def _incl(sql: str) -> str:
    return sql.replace("c.claim_date < i.index_date", "c.claim_date <= i.index_date")


def _incl_stats(spark, sf_dir):
    idx = index_dates(spark, sf_dir).withColumn(S.INDEX_DATE, F.date_add(S.INDEX_DATE, 1))
    w = fe.lookback(idx, cohort_claims(spark, sf_dir), P.LOOKBACK_DAYS + 1)
    return en.code_statistics(en.contingency(driver.attach_codes(spark, sf_dir, w)))


@register("X3_screen_index_day", _incl(_report_sql(STATS_SQL)))
def x3_screen_index_day(spark, sf_dir):
    """The report over the lookback window and the index day."""
    stats = _incl_stats(spark, sf_dir).withColumn("p_value", st.chi2_pvalue("chi2"))
    return en.significance_screen(stats).withColumn("p_value", F.round("p_value", 12))
