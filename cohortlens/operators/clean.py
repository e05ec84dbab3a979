"""Table-level cleaning (C1-C3, C5, C9-C13; Q2, Q3) for claim files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import cleaning as cl

# Columns cast per file type (fixed values of the file layout).
TYPE_MAP = {
    "beneficiary": {"DESYNPUF_ID": "string", "BENE_BIRTH_DT": "date", "BENE_SEX_IDENT_CD": "string"},
    "inpatient": {"DESYNPUF_ID": "string", "CLM_ID": "string", "CLM_FROM_DT": "date", "CLM_PMT_AMT": "double",
                  "ICD9_DGNS_CD_1": "string", "CLM_DRG_CD": "string"},
    "outpatient": {"DESYNPUF_ID": "string", "CLM_ID": "string", "CLM_FROM_DT": "date", "CLM_PMT_AMT": "double",
                   "ICD9_DGNS_CD_1": "string", "HCPCS_CD_1": "string"},
    "carrier": {"DESYNPUF_ID": "string", "CLM_ID": "string", "CLM_FROM_DT": "date",
                "LINE_NCH_PMT_AMT_1": "double", "ICD9_DGNS_CD_1": "string", "HCPCS_CD_1": "string"},
}
# Key columns, and columns to impute, per file type (fixed values of the file layout).
KEY_COLUMNS = {
    "beneficiary": ["DESYNPUF_ID", "BENE_BIRTH_DT"],
    "inpatient": ["DESYNPUF_ID", "CLM_ID", "CLM_PMT_AMT"],
    "outpatient": ["DESYNPUF_ID", "CLM_ID", "CLM_PMT_AMT"],
    "carrier": ["DESYNPUF_ID", "CLM_ID", "LINE_NCH_PMT_AMT_1"],
}
IMPUTE_COLUMNS = {
    "inpatient": ["ICD9_DGNS_CD_1", "CLM_DRG_CD"],
    "outpatient": ["ICD9_DGNS_CD_1", "HCPCS_CD_1"],
    "carrier": ["ICD9_DGNS_CD_1", "HCPCS_CD_1"],
}


def convert_types(df: DataFrame, file_type: str, date_format: str = "yyyyMMdd") -> DataFrame:
    """Cast the listed columns; dates parsed with ``date_format`` (bad
    text becomes NULL); numbers with try_cast.  Unknown type or missing
    column raises ValueError; other columns pass through."""
    if file_type not in TYPE_MAP:
        raise ValueError(f"Invalid file_type: {file_type}")
    mapping = TYPE_MAP[file_type]
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    out = []
    for c in df.columns:
        t = mapping.get(c)
        if t == "date":
            out.append(F.try_to_date(F.col(c).cast("string"), date_format).alias(c))
        elif t == "string":
            out.append(F.col(c).cast("string").alias(c))
        elif t:
            out.append(F.expr(f"try_cast(`{c}` AS {t})").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def handle_missing(df: DataFrame, file_type: str, fill: str = "Unknown") -> DataFrame:
    """C2 + C3: drop rows with a NULL key column, then impute code columns
    (NULL or 'None' -> ``fill``); absent columns are skipped."""
    if file_type not in KEY_COLUMNS:
        raise ValueError(f"Invalid file_type: {file_type}")
    out = df.dropna(subset=[c for c in KEY_COLUMNS[file_type] if c in df.columns])
    for c in IMPUTE_COLUMNS.get(file_type, []):
        if c in out.columns:
            out = out.withColumn(c, cl.impute_code(c, fill))
    return out


def load_beneficiary(df: DataFrame, year: int = 2009) -> DataFrame:
    """Q2: covered people (C9), age (C10), ESRD and chronic recodes (C11),
    chronic count (C12), selected columns."""
    chronic = [c for c in S.CHRONIC_COLUMNS if c in df.columns]
    covered = df.filter(F.col("BENE_HI_CVRAGE_TOT_MONS") >= 1)
    flags = [cl.flag_equals(F.col(c).cast("int"), 1).alias(c) for c in chronic]
    out = covered.select(
        F.col("DESYNPUF_ID").cast("string").alias("DESYNPUF_ID"),
        cl.age_in_year(cl.parse_date("BENE_BIRTH_DT"), year).alias("age"),
        "BENE_SEX_IDENT_CD", "SP_STATE_CODE",
        cl.flag_equals("BENE_ESRD_IND", "Y").alias("BENE_ESRD_IND"), *flags)
    return out.withColumn("chronic_condition_count", cl.row_sum(chronic, "int"))


def load_claims(df: DataFrame, file_type: str, start: str = "2008-12-02", end: str = "2009-12-31") -> DataFrame:
    """Q3: carrier amount = sum of 13 line amounts (C13); date cleanup (C4),
    NULL dates dropped (C5); code slots as trimmed arrays without blanks
    (C6 + R1); claims in [start, end] (C8).  Output is the canonical claim
    layout with ``icd_codes`` and ``hcpcs_codes`` arrays."""
    cols = df.columns
    if file_type == "carrier":
        amount = cl.row_sum([f"LINE_NCH_PMT_AMT_{i}" for i in range(1, S.CARRIER_LINE_SLOTS + 1)
                             if f"LINE_NCH_PMT_AMT_{i}" in cols])
    else:
        amount = F.col("CLM_PMT_AMT").cast("double")
    icd = [c for c in cols if "ICD9_DGNS_CD" in c]
    hcpcs = [c for c in cols if "HCPCS_CD" in c]
    out = df.select(
        F.col("DESYNPUF_ID").cast("string").alias(S.PERSON), F.col("CLM_ID").cast("string").alias(S.CLAIM),
        cl.parse_date("CLM_FROM_DT").alias(S.DATE), amount.alias(S.AMOUNT), F.lit(file_type).alias(S.FILE_TYPE),
        cl.code_slots(icd).alias(S.ICD), cl.code_slots(hcpcs).alias(S.HCPCS))
    return out.filter(F.col(S.DATE).isNotNull() &
                      F.col(S.DATE).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
