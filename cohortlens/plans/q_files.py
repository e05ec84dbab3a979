"""File sources and sinks (S1-S7), and the loaders built on them.

Each query renders driver rows as claim files in a new folder of the shared
store, with the quirks that such files have, and reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import cleaning as cl
from cohortlens.operators import clean as cn
from cohortlens.operators import profile as pf
from cohortlens.operators import summary as sm
from cohortlens.plans import params as P
from cohortlens.plans import q_clean_profile as cp
from cohortlens.plans.registry import register
from cohortlens.plans.sql_common import claims_sql
from cohortlens.session import shared_folder
from cohortlens.sources import driver, files


def new_folder(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/files-{uuid.uuid4().hex[:12]}"


def _csv(df, path, **options):
    df.write.options(header=True, **options).csv(path)
    return path


def _claims(spark, sf_dir, file_type):
    """One type's orders in the columns of its file; HCPCS and DRG carry the priority digits."""
    c = driver.claims(spark, sf_dir, types=[file_type])
    amount = "LINE_NCH_PMT_AMT_1" if file_type == "carrier" else "CLM_PMT_AMT"
    proc = "CLM_DRG_CD" if file_type == "inpatient" else "HCPCS_CD_1"
    return c.select(F.col(S.PERSON).cast("string").alias("DESYNPUF_ID"), F.col(S.CLAIM).cast("string").alias("CLM_ID"),
                    F.date_format(S.DATE, "yyyyMMdd").alias("CLM_FROM_DT"), F.col(S.AMOUNT).alias(amount),
                    F.lit(None).cast("string").alias("ADMTNG_ICD9_DGNS_CD"), F.col(S.DX).alias("ICD9_DGNS_CD_1"),
                    F.substring(S.DX, 3, 1).alias(proc))


def _claims_sql(file_type):
    return f"SELECT * FROM ({claims_sql()}) c WHERE file_type = '{file_type}'"


def render_directory(spark, sf_dir) -> str:
    """Claim files of three types: outpatient in two layouts (one with stray and reordered columns, compressed), and two
    files that must be skipped: amounts that are no numbers, and required columns missing."""
    folder = new_folder(spark)
    _csv(_claims(spark, sf_dir, "inpatient"), f"{folder}/Inpatient_1.csv")
    out = _claims(spark, sf_dir, "outpatient")
    even = F.col("CLM_ID").cast("long") % 2 == 0
    _csv(out.where(even), f"{folder}/outpatient_1.csv")
    odd = out.where(~even).withColumn("STRAY", F.lit("x"))
    _csv(odd.select(*reversed(odd.columns)), f"{folder}/outpatient_2.csv", compression="gzip")
    carrier = _claims(spark, sf_dir, "carrier")
    _csv(carrier, f"{folder}/carrier_1.csv")
    _csv(carrier.withColumn("LINE_NCH_PMT_AMT_1", F.lit("n/a")), f"{folder}/carrier_2.csv")
    _csv(carrier.select("DESYNPUF_ID", "CLM_ID"), f"{folder}/inpatient_2.csv")
    return folder


_S1_COLUMNS = ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "ICD9_DGNS_CD_1", "CLM_DRG_CD"]
_FILE_SQL = """CAST(person_id AS VARCHAR) AS DESYNPUF_ID, CAST(claim_id AS VARCHAR) AS CLM_ID,
  strftime(claim_date, '%Y%m%d') AS CLM_FROM_DT, claim_amt AS CLM_PMT_AMT, primary_dx AS ICD9_DGNS_CD_1, substr(primary_dx, 3, 1)"""


@register("S1_load_file", f"SELECT {_FILE_SQL} AS CLM_DRG_CD FROM ({_claims_sql('inpatient')}) c")
def s1_load_file(spark, sf_dir):
    path = _csv(_claims(spark, sf_dir, "inpatient"), f"{new_folder(spark)}/inpatient.csv")
    return files.load_file(spark, path, S.REQUIRED_ON_LOAD["inpatient"], S.SCHEMAS["inpatient"]).select(*_S1_COLUMNS)


def loaded(spark, sf_dir):
    """The directory's types, typed and cleaned."""
    dfs = files.load_all(spark, render_directory(spark, sf_dir))
    return {t: cn.handle_missing(cn.convert_types(df, t), t) for t, df in dfs.items()}


@register("S2_load_all", f"""SELECT CAST(person_id AS VARCHAR) AS person_id, CAST(claim_id AS VARCHAR) AS claim_id, claim_date, claim_amt,
  primary_dx, substr(primary_dx, 3, 1) AS prcdr_drg_cd, file_type FROM ({claims_sql()}) c WHERE file_type IS NOT NULL""")
def s2_load_all(spark, sf_dir):
    """The directory in one layout (C14) with its source tag (C15, U1); bad files are left out."""
    return sm.stack_claims(loaded(spark, sf_dir))


@register("S3_typed_scan", f"""SELECT CAST(claim_id AS VARCHAR) AS CLM_ID, claim_amt AS CLM_PMT_AMT, substr(primary_dx, 3, 1) AS HCPCS_CD_1,
  CAST(NULL AS VARCHAR) AS HCPCS_CD_2 FROM ({_claims_sql('outpatient')}) c""")
def s3_typed_scan(spark, sf_dir):
    """Declared columns by name; one that the file lacks is NULL."""
    path = _csv(_claims(spark, sf_dir, "outpatient"), f"{new_folder(spark)}/outpatient.csv")
    return files.load_typed(spark, path, "outpatient", ["CLM_ID", "CLM_PMT_AMT", "HCPCS_CD_1", "HCPCS_CD_2"])


@register("S4_lookup", "SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, n_name AS description FROM nation")
def s4_lookup(spark, sf_dir):
    rows = driver.dx_lookup(spark, sf_dir).select(F.col("description").alias("ICD9_DESC_LONG"), F.col("code").alias("ICD9_CD"))
    return files.load_lookup(spark, _csv(rows, f"{new_folder(spark)}/dx.tsv", sep="\t"))


_STAGE_SQL = f"SELECT person_id, claim_id, claim_date, claim_amt, file_type FROM ({claims_sql()}) c"
_STAGE = [S.PERSON, S.CLAIM, S.DATE, S.AMOUNT, S.FILE_TYPE]


@register("S5_reread", _STAGE_SQL)
def s5_reread(spark, sf_dir):
    """A stage written as CSV and read again with its declared types, the date parsed."""
    path = files.write_table(driver.claims(spark, sf_dir).select(*_STAGE), f"{new_folder(spark)}/stage", fmt="csv")
    return files.load_processed(spark, path, "person_id bigint, claim_id bigint, claim_date string, claim_amt double, file_type string", [S.DATE])


@register("S6_sink", _STAGE_SQL)
def s6_sink(spark, sf_dir):
    """A stage written as Parquet, partitioned by file type, and read again."""
    claims = driver.claims(spark, sf_dir).select(*_STAGE)
    path = files.write_table(claims, f"{new_folder(spark)}/stage", partition_by=[S.FILE_TYPE])
    return files.load_processed(spark, path, claims.schema, fmt="parquet").select(*_STAGE)


@register("S7_fixed_width", "SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, trim(n_name) AS description FROM nation")
def s7_fixed_width(spark, sf_dir):
    path = f"{new_folder(spark)}/dx.txt"
    driver.dx_lookup(spark, sf_dir).select(F.concat(F.rpad("code", 6, " "), F.rpad("description", 40, " ")).alias("value")).write.text(path)
    return files.load_fixed_width(spark, path, [("code", 1, 6), ("description", 7, 40)])


@register("P1_observed", f"""WITH r AS (SELECT {_FILE_SQL} AS CLM_DRG_CD, CAST(NULL AS VARCHAR) AS ADMTNG_ICD9_DGNS_CD FROM ({_claims_sql('inpatient')}) c)
SELECT 'rows' AS column_name, count(*) AS null_count FROM r UNION ALL
{' UNION ALL '.join(f"SELECT '{c}', count(*) - count({c}) FROM r" for c in [*_S1_COLUMNS, 'ADMTNG_ICD9_DGNS_CD'])}""")
def p1_observed(spark, sf_dir):
    """Row and null counts that come with the load's own scan."""
    path = _csv(_claims(spark, sf_dir, "inpatient"), f"{new_folder(spark)}/inpatient.csv")
    typed = files.load_typed(spark, path, "inpatient", [*_S1_COLUMNS, "ADMTNG_ICD9_DGNS_CD"])
    _, seen = pf.written_with_nulls(typed, "inpatient")
    return spark.createDataFrame(list(seen.items()), "column_name string, null_count long")


_BIRTH = "1900 + (c_custkey * 7) % 95"


@register("Q2_beneficiary", f"""WITH b AS (SELECT *, {', '.join(f"CASE WHEN (c_custkey + {i}) % 3 = 0 THEN 1 ELSE 0 END AS {c}" for i, c in enumerate(S.CHRONIC_COLUMNS))}
  FROM customer WHERE c_acctbal >= 1)
SELECT CAST(c_custkey AS VARCHAR) AS DESYNPUF_ID, CAST(CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE {P.YEAR} - ({_BIRTH}) END AS INTEGER) AS age,
  c_mktsegment AS BENE_SEX_IDENT_CD, CAST(c_nationkey AS VARCHAR) AS SP_STATE_CODE,
  CASE WHEN c_nationkey = 1 THEN 1 ELSE 0 END AS BENE_ESRD_IND, {', '.join(S.CHRONIC_COLUMNS)},
  {' + '.join(S.CHRONIC_COLUMNS)} AS chronic_condition_count FROM b""")
def q2_beneficiary(spark, sf_dir):
    """A beneficiary file (some birth dates unreadable) through the loader: coverage, age, recodes, condition count."""
    c = driver.table(spark, sf_dir, "customer")
    birth = F.concat(F.expr(_BIRTH).cast("string"), F.lit("0615"))
    raw = c.select(F.col("c_custkey").cast("string").alias("DESYNPUF_ID"),
                   F.when(F.col("c_custkey") % 11 == 0, F.lit("unknown")).otherwise(birth).alias("BENE_BIRTH_DT"),
                   F.col("c_mktsegment").alias("BENE_SEX_IDENT_CD"), F.col("c_nationkey").cast("string").alias("SP_STATE_CODE"),
                   F.when(F.col("c_acctbal") >= 1, 12).otherwise(0).alias("BENE_HI_CVRAGE_TOT_MONS"),
                   F.when(F.col("c_nationkey") == 1, "Y").otherwise("0").alias("BENE_ESRD_IND"),
                   *[F.when((F.col("c_custkey") + i) % 3 == 0, 1).otherwise(2).alias(x) for i, x in enumerate(S.CHRONIC_COLUMNS)])
    path = _csv(raw, f"{new_folder(spark)}/beneficiary.csv")
    return cn.load_beneficiary(files.load_typed(spark, path, "beneficiary"), P.YEAR)


_Q3_SQL = f"""WITH n AS ({cp.NUMBERED_SQL}),
l AS (SELECT n.*, (slot - 1) // {cp.WIDTH} AS block, p_brand, p_type FROM n JOIN part ON l_partkey = p_partkey)
SELECT CAST(o_custkey AS VARCHAR) AS person_id, CAST(o_orderkey AS VARCHAR) AS claim_id, CAST(o_orderdate AS DATE) AS claim_date,
  round(sum(l_extendedprice), 2) AS claim_amt, 'carrier' AS file_type,
  list(p_brand ORDER BY slot) AS icd_codes, list(p_type ORDER BY slot) AS hcpcs_codes
FROM l JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'P' AND o_custkey % 50 <> 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '{P.CLAIM_START}' AND DATE '{P.CLAIM_END}'
GROUP BY o_custkey, o_orderkey, o_orderdate, block"""


@register("Q3_carrier_claims", _Q3_SQL)
def q3_carrier_claims(spark, sf_dir):
    """A carrier file with line slots (13 a row, further lines in further rows), dates with a trailing '.0' and some
    unreadable, padded codes, through the loader."""
    lines = cp.numbered_lines(spark, sf_dir)
    p = driver.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    value = F.first(F.struct(F.col("l_extendedprice").alias("a"), F.concat(F.lit(" "), "p_brand").alias("d"), F.col("p_type").alias("h")))
    wide = cp.wide_lines(lines.join(p, lines.l_partkey == p.p_partkey), value)
    o = driver.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    date = F.when(F.col("o_custkey") % 50 == 0, "no date").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".0")))
    slots = range(1, cp.WIDTH + 1)
    raw = wide.join(o, wide.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("DESYNPUF_ID"), F.col("o_orderkey").cast("string").alias("CLM_ID"), date.alias("CLM_FROM_DT"),
        *[F.col(f"`{i}`.d").alias(f"LINE_ICD9_DGNS_CD_{i}") for i in slots], *[F.col(f"`{i}`.h").alias(f"HCPCS_CD_{i}") for i in slots],
        *[F.col(f"`{i}`.a").alias(f"LINE_NCH_PMT_AMT_{i}") for i in slots])
    path = _csv(raw, f"{new_folder(spark)}/carrier.csv")
    out = cn.load_claims(files.load_typed(spark, path, "carrier"), "carrier", P.CLAIM_START, P.CLAIM_END)
    return out.withColumn(S.AMOUNT, F.round(S.AMOUNT, 2))


@register("C17_dots", "SELECT o_orderkey, replace(strftime(o_orderdate, '%Y.%m.%d'), '.', '') AS code FROM orders")
def c17_dots(spark, sf_dir):
    o = driver.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", cl.remove_dots(F.date_format("o_orderdate", "yyyy.MM.dd")).alias("code"))


@register("C18_affixes", "SELECT p_partkey, p_brand AS code FROM part")
def c18_affixes(spark, sf_dir):
    p = driver.table(spark, sf_dir, "part")
    return p.select("p_partkey", cl.feature_code(F.concat(F.lit("icd9_"), "p_brand", F.lit(f"_{P.LOOKBACK_DAYS}d"))).alias("code"))
