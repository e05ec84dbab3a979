"""Cleaning (C*) and profile (P*) queries over the driver tables.

Dirty input is rendered from driver columns the way claim exports look:
dates as 'yyyyMMdd' text (carrier rows with a trailing '.0', as a float
export writes them), amounts as text, priority '4-NOT SPECIFIED' exported
as the text 'None'.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import cleaning as cl
from cohortlens.operators import clean as cn
from cohortlens.operators import profile as pf
from cohortlens.plans import params as P
from cohortlens.plans.q_cohort import INDEX_SQL, dataset, features_sql, index_dates
from cohortlens.plans.q_pairs import FLAGS
from cohortlens.plans.registry import register
from cohortlens.plans.sql_common import claims_sql
from cohortlens.sources import driver

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rendered_inpatient(spark, sf_dir):
    o = driver.table(spark, sf_dir, "orders")
    date_text = F.concat(F.date_format("o_orderdate", "yyyyMMdd"),
                         F.when(F.col("o_orderstatus") == "P", F.lit(".0")).otherwise(F.lit("")))
    dx = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("None")).otherwise(
        F.lpad(F.substring_index("o_orderpriority", "-", 1), 3, "0"))
    return o.select(F.col("o_custkey").cast("string").alias("DESYNPUF_ID"),
                    F.col("o_orderkey").cast("string").alias("CLM_ID"), date_text.alias("CLM_FROM_DT"),
                    F.col("o_totalprice").cast("string").alias("CLM_PMT_AMT"), dx.alias("ICD9_DGNS_CD_1"),
                    F.col("o_orderstatus").alias("CLM_DRG_CD"))


RENDERED_SQL = """SELECT CAST(o_custkey AS VARCHAR) AS DESYNPUF_ID, CAST(o_orderkey AS VARCHAR) AS CLM_ID,
  strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderstatus = 'P' THEN '.0' ELSE '' END AS CLM_FROM_DT,
  CAST(o_totalprice AS VARCHAR) AS CLM_PMT_AMT,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'None'
       ELSE lpad(split_part(o_orderpriority, '-', 1), 3, '0') END AS ICD9_DGNS_CD_1,
  o_orderstatus AS CLM_DRG_CD
FROM orders"""
TYPED_SQL = f"""SELECT DESYNPUF_ID, CLM_ID, try_strptime(CLM_FROM_DT, '%Y%m%d')::DATE AS CLM_FROM_DT,
  TRY_CAST(CLM_PMT_AMT AS DOUBLE) AS CLM_PMT_AMT, ICD9_DGNS_CD_1, CLM_DRG_CD FROM ({RENDERED_SQL}) r"""


@register("C1_types", TYPED_SQL)
def c1_types(spark, sf_dir):
    return cn.convert_types(rendered_inpatient(spark, sf_dir), "inpatient")


@register("C3_impute", f"""SELECT DESYNPUF_ID, CLM_ID, CLM_FROM_DT, CLM_PMT_AMT,
  coalesce(nullif(ICD9_DGNS_CD_1, 'None'), 'Unknown') AS ICD9_DGNS_CD_1,
  coalesce(nullif(CLM_DRG_CD, 'None'), 'Unknown') AS CLM_DRG_CD
FROM ({TYPED_SQL}) t WHERE DESYNPUF_ID IS NOT NULL AND CLM_ID IS NOT NULL AND CLM_PMT_AMT IS NOT NULL""")
def c3_impute(spark, sf_dir):
    return cn.handle_missing(cn.convert_types(rendered_inpatient(spark, sf_dir), "inpatient"), "inpatient")


@register("C4_dates", f"""SELECT CLM_ID,
  try_strptime(trim(regexp_replace(CLM_FROM_DT, '\\.0$', '')), '%Y%m%d')::DATE AS claim_date
FROM ({RENDERED_SQL}) r""")
def c4_dates(spark, sf_dir):
    r = rendered_inpatient(spark, sf_dir)
    return r.select("CLM_ID", cl.parse_date("CLM_FROM_DT").alias("claim_date"))


@register("C7_year_counts", f"""SELECT file_type, count(*) AS claims
FROM ({claims_sql(f'{P.YEAR}-01-01', f'{P.YEAR}-12-31')}) c GROUP BY file_type""")
def c7_year_counts(spark, sf_dir):
    c = driver.claims(spark, sf_dir).filter(cl.year_range(S.DATE, P.YEAR))
    return c.groupBy(S.FILE_TYPE).agg(F.count("*").alias("claims"))


@register("C11_recode", f"""SELECT c_custkey AS person_id,
  {', '.join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS seg_{s}" for s in SEGMENTS)},
  {' + '.join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END" for s in SEGMENTS)} AS flag_count
FROM customer""")
def c11_recode(spark, sf_dir):
    c = driver.table(spark, sf_dir, "customer")
    flags = [cl.flag_equals("c_mktsegment", s).alias(f"seg_{s}") for s in SEGMENTS]
    out = c.select(F.col("c_custkey").alias(S.PERSON), *flags)
    return out.withColumn("flag_count", cl.row_sum([f"seg_{s}" for s in SEGMENTS], "int"))


def _line_order():
    return Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")


def numbered_lines(spark, sf_dir):
    """Order lines with their slot: the place within the order by line number, then part and price (line numbers
    repeat, so they are not slots themselves)."""
    return (driver.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
            .withColumn("slot", F.row_number().over(_line_order())))


WIDTH = S.CARRIER_LINE_SLOTS  # slots of a wide row; lines beyond go to further rows of the same order


def wide_lines(lines, value):
    """(l_orderkey, block, slots 1..WIDTH) of numbered lines: a fixed number of columns, and every line kept."""
    placed = (lines.withColumn("block", F.floor((F.col("slot") - 1) / WIDTH)).withColumn("place", F.pmod(F.col("slot") - 1, F.lit(WIDTH)) + 1))
    return placed.groupBy("l_orderkey", "block").pivot("place", list(range(1, WIDTH + 1))).agg(value)


def wide_amounts(lines):
    """(l_orderkey, block, slots 1..WIDTH) of the amounts of unjoined lines: each WIDTH-th line of an order's sorted
    lines reads those after it, so a task holds its sort and no table of lines or of slots."""
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    ahead = [F.lead("l_extendedprice", i).over(_line_order()).alias(f"_{i + 1}") for i in range(1, WIDTH)]
    placed = lines.select("l_orderkey", F.row_number().over(_line_order()).alias("slot"), F.col("l_extendedprice").alias("_1"), *ahead)
    return placed.where(F.pmod(F.col("slot") - 1, F.lit(WIDTH)) == 0).select(
        "l_orderkey", F.floor((F.col("slot") - 1) / WIDTH).alias("block"),
        *[cl.money(f"_{i}").alias(str(i)) for i in range(1, WIDTH + 1)])


NUMBERED_SQL = """SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_extendedprice) AS INTEGER) AS slot FROM lineitem"""


@register("C13_line_sum", """SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS claim_amt
FROM lineitem GROUP BY l_orderkey""")
def c13_line_sum(spark, sf_dir):
    """Order lines pivoted to the carrier's wide line-amount slots, one a line, then the row-wise sum with NULL
    slots as 0, over all rows of an order."""
    wide = wide_amounts(driver.table(spark, sf_dir, "lineitem"))
    rows = wide.select("l_orderkey", cl.row_sum([F.col(f"`{x}`") for x in range(1, WIDTH + 1)], "decimal(28,2)").alias("_sum"))
    return rows.groupBy("l_orderkey").agg(F.sum("_sum").cast("double").alias(S.AMOUNT))


@register("C19_calendar", f"""SELECT claim_id, CAST(weekofyear(claim_date) AS INTEGER) AS week,
  strftime(claim_date, '%Y-%m') AS month FROM ({claims_sql(f'{P.YEAR}-01-01', f'{P.YEAR}-12-31')}) c""")
def c19_calendar(spark, sf_dir):
    c = driver.claims(spark, sf_dir, f"{P.YEAR}-01-01", f"{P.YEAR}-12-31")
    return c.select(S.CLAIM, F.weekofyear(S.DATE).alias("week"), F.date_format(S.DATE, "yyyy-MM").alias("month"))


_P1_COLS = ["person_id", "claim_id", "claim_date", "claim_amt", "file_type", "primary_dx", "icd_codes",
            "hcpcs_codes"]


@register("P1_nulls", f"""WITH c AS ({claims_sql(codes=True)}), n AS (SELECT count(*) AS total FROM c),
m AS ({' UNION ALL '.join(f"SELECT '{x}' AS column_name, count(*) - count({x}) AS null_count FROM c" for x in _P1_COLS)})
SELECT column_name, null_count,
  CASE WHEN total > 0 THEN floor((20000 * null_count + total) / (2 * total)) / 100.0 END AS null_pct
FROM m, n WHERE null_count > 0""")
def p1_nulls(spark, sf_dir):
    return pf.null_profile(driver.claims(spark, sf_dir, codes=True))


@register("P2_counts", f"SELECT count(*) AS rows, CAST(sum(case_ind) AS BIGINT) AS positives FROM ({INDEX_SQL}) i")
def p2_counts(spark, sf_dir):
    return pf.counts(index_dates(spark, sf_dir), S.LABEL)


@register("P3_summary", """SELECT count(c_acctbal) AS count,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean,
  round(stddev_samp(c_acctbal), 6) AS std, min(c_acctbal) AS min,
  round(quantile_cont(c_acctbal, 0.25), 6) AS q25, round(quantile_cont(c_acctbal, 0.5), 6) AS q50,
  round(quantile_cont(c_acctbal, 0.75), 6) AS q75, max(c_acctbal) AS max FROM customer""")
def p3_summary(spark, sf_dir):
    return pf.numeric_summary(driver.table(spark, sf_dir, "customer"), "c_acctbal", digits=6)


@register("P4_values", """SELECT c_mktsegment, count(*) AS count FROM customer
WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""")
def p4_values(spark, sf_dir):
    return pf.value_counts(driver.table(spark, sf_dir, "customer"), "c_mktsegment")


_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@register("P5_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM customer" for c, t in _CUSTOMER.items()))
def p5_schema(spark, sf_dir):
    return pf.non_null_schema(driver.table(spark, sf_dir, "customer"))


@register("P6_prevalence", f"""WITH f AS ({features_sql(hcpcs=(), pairs=(), demographics=False)})
{' UNION ALL '.join(f"SELECT '{c}' AS flag, avg({c}) * 100 AS prevalence_pct FROM f" for c in FLAGS)}""")
def p6_prevalence(spark, sf_dir):
    return pf.flag_prevalence(dataset(spark, sf_dir), FLAGS)


@register("P7_histogram", """WITH m AS (SELECT CAST(min(c_acctbal) AS DOUBLE) AS lo, CAST(max(c_acctbal) AS DOUBLE) AS hi
  FROM customer),
b AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor((c_acctbal - lo) / (hi - lo) * 30) + 1, 30) ELSE 1 END
        AS INTEGER) AS bin, lo, hi FROM customer, m WHERE c_acctbal IS NOT NULL)
SELECT bin, any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 30 AS bin_start, count(*) AS count
FROM b GROUP BY bin""")
def p7_histogram(spark, sf_dir):
    return pf.histogram(driver.table(spark, sf_dir, "customer"), "c_acctbal", 30)


def line_slots(spark, sf_dir):
    """Order lines in the wide slot layout of a claim file: (frame, slot columns), slot_i = the brand of the i-th line
    of the order's block."""
    p = driver.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    li = numbered_lines(spark, sf_dir)
    wide = wide_lines(li.join(p, li.l_partkey == p.p_partkey), F.min("p_brand"))
    slots = range(1, WIDTH + 1)
    return wide.select("l_orderkey", "block", *[F.col(f"`{i}`").alias(f"slot_{i}") for i in slots]), [f"slot_{i}" for i in slots]


SLOTS_SQL = f"""SELECT l_orderkey, slot, p_brand AS b FROM ({NUMBERED_SQL}) n JOIN part ON l_partkey = p_partkey"""


@register("R1_arrays", f"""SELECT l_orderkey,
  list(trim(b) ORDER BY slot) FILTER (WHERE b IS NOT NULL AND trim(b) NOT IN ('', 'None')) AS codes
FROM ({SLOTS_SQL}) s GROUP BY l_orderkey""")
def r1_arrays(spark, sf_dir):
    wide, slots = line_slots(spark, sf_dir)
    rows = wide.select("l_orderkey", "block", cl.code_slots(slots).alias("codes"))
    return (rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("block", "codes"))).alias("_rows"))
            .select("l_orderkey", F.flatten(F.col("_rows.codes")).alias("codes")))


@register("R3_melt", f"""SELECT l_orderkey, b AS code FROM ({SLOTS_SQL}) s
WHERE b IS NOT NULL AND b NOT IN ('', 'None')""")
def r3_melt(spark, sf_dir):
    from cohortlens.operators import enrich as en
    wide, slots = line_slots(spark, sf_dir)
    return en.melt_slots(wide, slots, ids=["l_orderkey"])


@register("C6_codes", f"""WITH s AS ({SLOTS_SQL}),
grid AS (SELECT l_orderkey, CAST(unnest(range(1, ((max(slot) - 1) // {WIDTH} + 1) * {WIDTH} + 1)) AS INTEGER) AS slot FROM s GROUP BY l_orderkey)
SELECT g.l_orderkey, g.slot, coalesce(trim(s.b), '') AS code
FROM grid g LEFT JOIN s ON s.l_orderkey = g.l_orderkey AND s.slot = g.slot""")
def c6_codes(spark, sf_dir):
    """Cleaned code slots, one row a slot; an order has as many full rows of slots as its lines need."""
    wide, slots = line_slots(spark, sf_dir)
    cells = F.array(*[F.struct((F.col("block") * WIDTH + i + 1).cast("int").alias("slot"), cl.clean_code(c).alias("code")) for i, c in enumerate(slots)])
    return wide.select("l_orderkey", F.inline(cells))
