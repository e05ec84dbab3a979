"""Dashboard queries over the merged claim table of the top payers (Q9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.operators import dashboard as db
from cohortlens.operators.summary import top_n
from cohortlens.plans import params as P
from cohortlens.plans.q_summary import MERGED_SQL, merged_claims
from cohortlens.plans.registry import register
from cohortlens.plans.sql_common import MONEY_SUM
from cohortlens.sources import driver

NORM_DX = "regexp_replace(trim(CAST(primary_dx AS VARCHAR)), '^0+', '')"
LOOKUP_SQL = """
SELECT regexp_replace(trim(lpad(CAST(n_nationkey AS VARCHAR), 3, '0')), '^0+', '') AS code,
       min(n_name) AS description
FROM nation GROUP BY 1"""


@register("A2_person_totals", f"""
SELECT person_id, {MONEY_SUM.format('claim_amt')} AS total_payment, count(claim_id) AS claim_count
FROM ({MERGED_SQL}) m WHERE person_id IS NOT NULL GROUP BY person_id""")
def a2_person_totals(spark, sf_dir):
    return db.totals_by(merged_claims(spark, sf_dir), S.PERSON)


def _top_dx_sql(where: str = "") -> str:
    return f"""
WITH m AS (SELECT *, {NORM_DX} AS dx FROM ({MERGED_SQL}) x {where}),
agg AS (SELECT dx AS primary_dx, coalesce({MONEY_SUM.format('claim_amt')}, 0) AS total_payment,
               count(claim_id) AS claim_count
        FROM m WHERE dx IS NOT NULL GROUP BY dx
        ORDER BY total_payment DESC, primary_dx LIMIT 10)
SELECT a.primary_dx, a.total_payment, a.claim_count, coalesce(l.description, a.primary_dx) AS description
FROM agg a LEFT JOIN ({LOOKUP_SQL}) l ON a.primary_dx = l.code"""


@register("A3_top_dx", _top_dx_sql())
def a3_top_dx(spark, sf_dir):
    return db.top_codes(merged_claims(spark, sf_dir), driver.dx_lookup(spark, sf_dir))


@register("J7_dx_described", f"""
WITH agg AS (SELECT {NORM_DX} AS primary_dx, count(*) AS claim_count
             FROM ({MERGED_SQL}) x GROUP BY 1)
SELECT a.primary_dx, a.claim_count, coalesce(l.description, a.primary_dx) AS description
FROM agg a LEFT JOIN ({LOOKUP_SQL}) l ON a.primary_dx = l.code""")
def j7_dx_described(spark, sf_dir):
    m = db.with_normalized_dx(merged_claims(spark, sf_dir))
    agg = m.groupBy(S.DX).agg(F.count("*").alias("claim_count"))
    return db.describe(agg, driver.dx_lookup(spark, sf_dir))


def _series_sql(period: str, where: str = "", max_week: int = 53) -> str:
    types = "(VALUES ('inpatient'), ('outpatient'), ('carrier')) t(file_type)"
    if period == "week":
        spine = f"SELECT CAST(w.range AS INTEGER) AS week, t.file_type FROM range(1, {max_week + 1}) w, {types}"
        key, col = "CAST(weekofyear(claim_date) AS INTEGER)", "week"
    else:
        spine = (f"SELECT printf('{P.YEAR}-%02d', CAST(m.range AS INTEGER)) AS month, t.file_type "
                 f"FROM range(1, 13) m, {types}")
        key, col = "strftime(claim_date, '%Y-%m')", "month"
    return f"""
WITH m AS (SELECT * FROM ({MERGED_SQL}) x {where}),
agg AS (SELECT {key} AS {col}, file_type, {MONEY_SUM.format('claim_amt')} AS claim_amt
        FROM m WHERE file_type IS NOT NULL GROUP BY 1, 2),
spine AS ({spine})
SELECT s.{col}, s.file_type, coalesce(a.claim_amt, 0.0) AS claim_amt
FROM spine s LEFT JOIN agg a ON s.{col} = a.{col} AND s.file_type = a.file_type"""


@register("A4_weekly", _series_sql("week"))
def a4_weekly(spark, sf_dir):
    return db.period_series(merged_claims(spark, sf_dir), "week", P.YEAR)


@register("A4_weekly_53", _series_sql("week", max_week=53))
def a4_weekly_53(spark, sf_dir):
    return db.period_series(merged_claims(spark, sf_dir), "week", P.YEAR, max_week=53)


@register("A4_monthly", _series_sql("month"))
def a4_monthly(spark, sf_dir):
    return db.period_series(merged_claims(spark, sf_dir), "month", P.YEAR)


DRILL_DX = "1"  # the selected (normalised) diagnosis


@register("C23_drilldown_dx", _series_sql("month", where=f"WHERE {NORM_DX} = '{DRILL_DX}'"))
def c23_drilldown_dx(spark, sf_dir):
    m = db.with_normalized_dx(merged_claims(spark, sf_dir))
    return db.period_series(db.drilldown(m, dx=DRILL_DX), "month", P.YEAR)


TOP_PERSON_SQL = f"""(SELECT person_id FROM ({MERGED_SQL}) x GROUP BY person_id
  ORDER BY {MONEY_SUM.format('claim_amt')} DESC, person_id LIMIT 1)"""


@register("C23_drilldown_person", _top_dx_sql(where=f"WHERE person_id IN {TOP_PERSON_SQL}"))
def c23_drilldown_person(spark, sf_dir):
    m = merged_claims(spark, sf_dir)
    first = top_n(db.totals_by(m, S.PERSON), 1, "total_payment", S.PERSON)
    return db.top_codes(db.drilldown_by(m, first, S.PERSON), driver.dx_lookup(spark, sf_dir))
