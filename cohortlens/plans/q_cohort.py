"""Cohort and lookback-feature queries (Q4, Q5, Q6, J5, J6, A7-A10, E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import year_range
from cohortlens.operators import cohort as co
from cohortlens.operators import features as fe
from cohortlens.plans import params as P
from cohortlens.plans.registry import register
from cohortlens.plans.sql_common import claims_sql
from cohortlens.session import written
from cohortlens.sources import driver, layout

PAIRS = [("Brand#1", "Brand#2"), ("Brand#3", "Brand#7"), ("Brand#7", "Brand#12")]
Y0, Y1 = f"{P.YEAR}-01-01", f"{P.YEAR}-12-31"
L = P.LOOKBACK_DAYS
STAGED_BUCKETS = 8


# ---- Spark side -----------------------------------------------------------

def cohort_claims(spark, sf_dir):
    """Claims in the load window (C8), without code slots."""
    return driver.claims(spark, sf_dir, P.CLAIM_START, P.CLAIM_END)


def covered(spark, sf_dir):
    """Covered beneficiaries."""
    return driver.beneficiaries(spark, sf_dir).filter(F.col("coverage") >= 1)


def _inpatient_of_year(spark, sf_dir):
    return (driver.claims(spark, sf_dir, P.CLAIM_START, P.CLAIM_END, types=["inpatient"])
            .filter(year_range(S.DATE, P.YEAR)))


def case_claims(spark, sf_dir):
    """Inpatient claims of the study year with the case code in a slot (a
    semi-join against the distinct orders having a line of that brand)."""
    return _inpatient_of_year(spark, sf_dir).join(driver.orders_with_brand(spark, sf_dir, P.CASE_CODE), S.CLAIM, "left_semi")


def cases(spark, sf_dir):
    """Q4: the latest case claim of each person."""
    return co.latest_dates(case_claims(spark, sf_dir))


def index_dates(spark, sf_dir):
    """Q5, planned anew by each query that reads it: one aggregate on the person."""
    hits = case_claims(spark, sf_dir).select(S.PERSON, F.col(S.DATE).alias("latest_case_date"))
    return co.assign_index_dates(hits, cohort_claims(spark, sf_dir), covered(spark, sf_dir),
                                 P.YEAR, P.CONTROL_START, P.CONTROL_END, P.SEED)


def window_claims(spark, sf_dir, days=L, codes=True, index=None):
    """Claims in each person's lookback window; code slots are attached
    to these claims only."""
    w = fe.lookback(index_dates(spark, sf_dir) if index is None else index, cohort_claims(spark, sf_dir), days)
    return driver.attach_codes(spark, sf_dir, w) if codes else w


def features(spark, sf_dir, icd=tuple(P.ICD_CODES), hcpcs=tuple(P.HCPCS_CODES), pairs=tuple(PAIRS),
             demographics=True, days=L):
    """Q6: the index dates (Q5) are written first, as the window and its base both read them."""
    demo = covered(spark, sf_dir).drop("coverage") if demographics else None
    index = written(index_dates(spark, sf_dir), "index_dates")
    window = window_claims(spark, sf_dir, days, codes=bool(icd or hcpcs or pairs), index=index)
    return fe.features_from_window(index, window, demo, days, icd, hcpcs, pairs)


def dataset(spark, sf_dir):
    """Q7: the full feature dataset."""
    return features(spark, sf_dir)


# ---- SQL side ---------------------------------------------------------------

CL_SQL = claims_sql(P.CLAIM_START, P.CLAIM_END, codes=True)
CASES_SQL = f"""
SELECT person_id, max(claim_date) AS latest_case_date FROM ({CL_SQL}) c
WHERE file_type = 'inpatient' AND claim_date BETWEEN DATE '{Y0}' AND DATE '{Y1}'
  AND list_contains(icd_codes, '{P.CASE_CODE}')
GROUP BY person_id"""
COVERED_SQL = ("SELECT c_custkey AS person_id, c_mktsegment AS sex, CAST(c_nationkey AS VARCHAR) AS state "
               "FROM customer WHERE c_acctbal >= 1")
INDEX_SQL = f"""
WITH cases AS ({CASES_SQL}),
draws AS (
  SELECT person_id,
         arg_min(claim_date, ('0x' || substr(md5(concat_ws('|', CAST(person_id AS VARCHAR), CAST(claim_id AS VARCHAR),
           '{P.SEED}')), 1, 15))::BIGINT) AS index_date
  FROM ({CL_SQL}) c
  WHERE claim_date BETWEEN DATE '{Y0}' AND DATE '{Y1}'
    AND claim_date BETWEEN DATE '{P.CONTROL_START}' AND DATE '{P.CONTROL_END}'
  GROUP BY person_id)
SELECT person_id, 1 AS case_ind, latest_case_date AS index_date FROM cases
UNION ALL
SELECT person_id, 0 AS case_ind, index_date FROM draws
WHERE person_id IN (SELECT person_id FROM ({COVERED_SQL}) v)
  AND NOT EXISTS (SELECT 1 FROM cases k WHERE k.person_id = draws.person_id)"""


def window_sql(days=L) -> str:
    return f"""
SELECT i.person_id, i.case_ind, i.index_date, c.claim_id, c.claim_date, c.claim_amt, c.file_type,
       c.primary_dx, c.icd_codes, c.hcpcs_codes
FROM ({INDEX_SQL}) i JOIN ({CL_SQL}) c
  ON i.person_id = c.person_id AND c.claim_date >= i.index_date - INTERVAL {days} DAY
 AND c.claim_date < i.index_date"""


def _tok(c):
    return fe.code_token(c)


def agg_sql(days=L, icd=(), hcpcs=(), pairs=(), types=tuple(S.CLAIM_TYPES)) -> list[str]:
    out = []
    for t in types:
        out.append(f"CAST(count(CASE WHEN file_type = '{t}' THEN claim_id END) AS INTEGER) AS {t}_count_{days}d")
        out.append(f"CAST(sum(CASE WHEN file_type = '{t}' THEN CAST(claim_amt AS DECIMAL(18,2)) END) AS DOUBLE)"
                   f" AS {t}_amt_{days}d")
    for c in icd:
        out.append(f"max(CAST(list_contains(icd_codes, '{c}') AS INTEGER)) AS icd9_{_tok(c)}_{days}d")
    for a, b in pairs:
        out.append(f"max(CAST(list_contains(icd_codes, '{a}') AND list_contains(icd_codes, '{b}') AS INTEGER))"
                   f" AS icd9_{_tok(a)}_and_{_tok(b)}_{days}d")
    for c in hcpcs:
        out.append(f"max(CAST(list_contains(hcpcs_codes, '{c}') AS INTEGER)) AS hcpcs_{_tok(c)}_{days}d")
    return out


def _alias(expr: str) -> str:
    return expr.rsplit(" AS ", 1)[1]


def features_sql(icd=tuple(P.ICD_CODES), hcpcs=tuple(P.HCPCS_CODES), pairs=tuple(PAIRS),
                 demographics=True, days=L) -> str:
    aggs = agg_sql(days, icd, hcpcs, pairs)
    names = [_alias(a) for a in aggs]
    fills = [f"coalesce(a.{n}, 0{'.0' if '_amt_' in n else ''}) AS {n}" for n in names]
    demo_cols = "d.sex, d.state, " if demographics else ""
    demo_join = f"LEFT JOIN ({COVERED_SQL}) d ON i.person_id = d.person_id" if demographics else ""
    return f"""
WITH w AS ({window_sql(days)}),
a AS (SELECT person_id, case_ind, index_date, {', '.join(aggs)} FROM w GROUP BY 1, 2, 3)
SELECT i.person_id, i.case_ind, i.index_date, {demo_cols}{', '.join(fills)}
FROM ({INDEX_SQL}) i {demo_join}
LEFT JOIN a ON i.person_id = a.person_id AND i.case_ind = a.case_ind AND i.index_date = a.index_date"""


# ---- registered queries ------------------------------------------------------

register("Q4_cases", CASES_SQL)(cases)


@register("C20_any_slot", CASES_SQL)
def c20_any_slot(spark, sf_dir):
    """Case finding over the code-slot arrays themselves."""
    claims = driver.attach_codes(spark, sf_dir, _inpatient_of_year(spark, sf_dir))
    return co.find_cases(claims, P.CASE_CODE, P.YEAR)


register("Q5_index_dates", INDEX_SQL)(index_dates)


@register("J1_covered_with_claims", f"""
SELECT person_id FROM ({COVERED_SQL}) v
WHERE person_id IN (SELECT person_id FROM ({CL_SQL}) c WHERE claim_date BETWEEN DATE '{Y0}' AND DATE '{Y1}')""")
def j1_covered_with_claims(spark, sf_dir):
    cl = cohort_claims(spark, sf_dir).filter(year_range(S.DATE, P.YEAR))
    return co.people_with_claims(covered(spark, sf_dir), cl)


@register("J6_lookback", f"""
SELECT person_id, case_ind, index_date, claim_id, claim_date, claim_amt, file_type FROM ({window_sql()}) w""")
def j6_lookback(spark, sf_dir):
    return window_claims(spark, sf_dir, codes=False).select(S.PERSON, S.LABEL, S.INDEX_DATE, S.CLAIM, S.DATE,
                                                            S.AMOUNT, S.FILE_TYPE)


@register("J5_demographics", f"""
SELECT i.person_id, i.case_ind, i.index_date, d.sex, d.state
FROM ({INDEX_SQL}) i LEFT JOIN ({COVERED_SQL}) d ON i.person_id = d.person_id""")
def j5_demographics(spark, sf_dir):
    return index_dates(spark, sf_dir).join(covered(spark, sf_dir).drop("coverage"), S.PERSON, "left")


@register("A7_type_features", features_sql(icd=(), hcpcs=(), pairs=(), demographics=False))
def a7_type_features(spark, sf_dir):
    return features(spark, sf_dir, icd=(), hcpcs=(), pairs=(), demographics=False)


@register("A8_code_flags", features_sql(hcpcs=(), pairs=(), demographics=False))
def a8_code_flags(spark, sf_dir):
    return features(spark, sf_dir, hcpcs=(), pairs=(), demographics=False)


@register("A9_pair_flags", features_sql(icd=(), hcpcs=(), demographics=False))
def a9_pair_flags(spark, sf_dir):
    return features(spark, sf_dir, icd=(), hcpcs=(), demographics=False)


@register("A10_code_flags", features_sql(icd=(), pairs=(), demographics=False))
def a10_code_flags(spark, sf_dir):
    return features(spark, sf_dir, icd=(), pairs=(), demographics=False)


register("Q6_features", features_sql())(features)


def staged_layout(spark, sf_dir):
    """The study's claims with their codes, and the index dates, as bucketed tables."""
    built = layout.stage_claims(driver.attach_codes(spark, sf_dir, cohort_claims(spark, sf_dir)), STAGED_BUCKETS)
    return layout.stage_index(built, index_dates(spark, sf_dir))


@register("Q7_dataset", f"SELECT * REPLACE (CAST(case_ind AS TINYINT) AS case_ind) FROM ({features_sql()}) f")
def q7_dataset(spark, sf_dir):
    """The feature dataset built from the staged layout, written once and read back, label as a byte."""
    feats = layout.staged_features(staged_layout(spark, sf_dir), covered(spark, sf_dir).drop("coverage"), L,
                                   P.ICD_CODES, P.HCPCS_CODES, PAIRS)
    return written(feats.withColumn(S.LABEL, F.col(S.LABEL).cast("byte")), "dataset")


@register("J6_staged", f"""
SELECT person_id, case_ind, index_date, claim_id, claim_date, claim_amt, file_type FROM ({window_sql()}) w""")
def j6_staged(spark, sf_dir):
    """The lookback window over the staged layout."""
    usual, hot = layout.staged_window(staged_layout(spark, sf_dir), L)
    cols = [S.PERSON, S.LABEL, S.INDEX_DATE, S.CLAIM, S.DATE, S.AMOUNT, S.FILE_TYPE]
    return usual.select(*cols).unionByName(hot.select(*cols))


# Events as a dense lookback: person = user, claim = event, date = timestamp,
# amount = value, type = event type.  Index = each user's latest 'error' event
# with value > 100; features = per-type counts and sums in the 7 days before.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
E_DAYS = 7


def _events_as_claims(spark, sf_dir):
    ev = driver.table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias(S.PERSON), F.col("event_id").alias(S.CLAIM),
                     F.col("ts").alias(S.DATE), F.col("value").alias(S.AMOUNT),
                     F.col("event_type").alias(S.FILE_TYPE))


@register("E_lookback", f"""
WITH ev AS (SELECT user_id AS person_id, event_id AS claim_id, ts AS claim_date, value AS claim_amt,
                   event_type AS file_type FROM events),
idx AS (SELECT person_id, 1 AS case_ind, max(claim_date) AS index_date FROM ev
        WHERE file_type = 'error' AND claim_amt > 100 GROUP BY person_id),
w AS (SELECT i.person_id, i.case_ind, i.index_date, e.claim_id, e.claim_amt, e.file_type
      FROM idx i JOIN ev e ON i.person_id = e.person_id
       AND e.claim_date >= i.index_date - INTERVAL {E_DAYS} DAY AND e.claim_date < i.index_date)
SELECT person_id, case_ind, index_date, {', '.join(agg_sql(E_DAYS, types=EVENT_TYPES))}
FROM w GROUP BY 1, 2, 3""")
def e_lookback(spark, sf_dir):
    ev = _events_as_claims(spark, sf_dir)
    idx = (ev.filter((F.col(S.FILE_TYPE) == "error") & (F.col(S.AMOUNT) > 100))
           .groupBy(S.PERSON).agg(F.lit(1).alias(S.LABEL), F.max(S.DATE).alias(S.INDEX_DATE)))
    w = fe.lookback(idx, ev, E_DAYS)
    return w.groupBy(*fe.KEYS).agg(*fe.feature_aggregates(E_DAYS, types=EVENT_TYPES))
