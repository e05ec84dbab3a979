"""Q1 summary pipeline over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.operators import summary as sm
from cohortlens.plans import params as P
from cohortlens.plans.registry import register
from cohortlens.plans.sql_common import MONEY_SUM, claims_sql
from cohortlens.sources import driver

Y0, Y1 = f"{P.YEAR}-01-01", f"{P.YEAR}-12-31"

TOP_SQL = f"""
SELECT person_id, {MONEY_SUM.format('claim_amt')} AS total_payment
FROM ({claims_sql(Y0, Y1)}) c
GROUP BY person_id ORDER BY total_payment DESC, person_id LIMIT {P.TOP_N}"""


@register("T1_top_customers", TOP_SQL)
def t1_top_customers(spark, sf_dir):
    return sm.top_persons(driver.claims(spark, sf_dir, Y0, Y1), P.TOP_N)


@register("A1_person_totals", f"""
SELECT person_id, {MONEY_SUM.format('claim_amt')} AS total_payment
FROM ({claims_sql(Y0, Y1)}) c GROUP BY person_id""")
def a1_person_totals(spark, sf_dir):
    return sm.person_totals(driver.claims(spark, sf_dir, Y0, Y1))


MERGED_SQL = f"""
SELECT person_id, claim_id, claim_date, claim_amt, primary_dx, prcdr_drg_cd, file_type
FROM ({claims_sql(Y0, Y1, proc=True)}) c
WHERE person_id IN (SELECT person_id FROM ({TOP_SQL}) t)"""


def merged_claims(spark, sf_dir):
    """Q1: the merged claim table of the top people in the study year."""
    in_year = driver.claims(spark, sf_dir, Y0, Y1)
    top = sm.top_persons(in_year, P.TOP_N)
    # Select the people first, then attach the procedure code only to their
    # claims: the line/part join runs on the reduced set.
    chosen = sm.keep_keys(in_year, top, S.PERSON)
    return _with_proc(spark, sf_dir, chosen).select(
        S.PERSON, S.CLAIM, S.DATE, S.AMOUNT, S.DX, S.PROC, S.FILE_TYPE)


def _with_proc(spark, sf_dir, claims):
    from cohortlens.functions.cleaning import impute_code
    li = driver.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    li = li.join(claims.select(F.col(S.CLAIM).alias("l_orderkey")), "l_orderkey", "left_semi")
    p = driver.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    first_type = (li.join(p, li.l_partkey == p.p_partkey)
                  .groupBy("l_orderkey").agg(F.min("p_type").alias("_t")))
    return (claims.join(first_type, claims[S.CLAIM] == first_type.l_orderkey, "left")
            .withColumn(S.PROC, impute_code("_t")).drop("l_orderkey", "_t"))


register("U5_merged_claims", MERGED_SQL)(merged_claims)
