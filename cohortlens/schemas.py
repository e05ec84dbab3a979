"""Declared schemas of the claim files and the canonical column names.

All fields are nullable and read as text where the source is text, so a
bad value becomes NULL in the cleaning step instead of failing the scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical column names used by the operators (all overridable).
PERSON = "person_id"
CLAIM = "claim_id"
DATE = "claim_date"
AMOUNT = "claim_amt"
FILE_TYPE = "file_type"
DX = "primary_dx"
PROC = "prcdr_drg_cd"
ICD = "icd_codes"
HCPCS = "hcpcs_codes"
LABEL = "case_ind"
INDEX_DATE = "index_date"

CLAIM_TYPES = ["inpatient", "outpatient", "carrier"]
FILE_TYPES = ["beneficiary"] + CLAIM_TYPES

# Fixed values of the claim-file layout (slot counts per file type).
CHRONIC_COLUMNS = [
    "SP_ALZHDMTA", "SP_CHF", "SP_CHRNKIDN", "SP_CNCR", "SP_COPD",
    "SP_DEPRESSN", "SP_DIABETES", "SP_ISCHMCHT", "SP_OSTEOPRS",
    "SP_RA_OA", "SP_STRKETIA",
]
INST_ICD_SLOTS = 10
INST_HCPCS_SLOTS = 45
CARRIER_ICD_SLOTS = 8
CARRIER_LINE_SLOTS = 13

# Required columns checked when a file is loaded, per file type.
REQUIRED_ON_LOAD = {
    "beneficiary": ["DESYNPUF_ID", "BENE_BIRTH_DT", "BENE_SEX_IDENT_CD"],
    "inpatient": ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "CLM_DRG_CD", "ICD9_DGNS_CD_1"],
    "outpatient": ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "HCPCS_CD_1", "ICD9_DGNS_CD_1"],
    "carrier": ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "LINE_NCH_PMT_AMT_1", "HCPCS_CD_1", "ICD9_DGNS_CD_1"],
}


def _s(name):
    return T.StructField(name, T.StringType(), True)


def _d(name):
    return T.StructField(name, T.DoubleType(), True)


def _i(name):
    return T.StructField(name, T.IntegerType(), True)


BENEFICIARY = T.StructType(
    [_s("DESYNPUF_ID"), _s("BENE_BIRTH_DT"), _s("BENE_SEX_IDENT_CD"), _s("SP_STATE_CODE"),
     _i("BENE_HI_CVRAGE_TOT_MONS"), _s("BENE_ESRD_IND")]
    + [_i(c) for c in CHRONIC_COLUMNS]
)


def institutional(drg: bool) -> T.StructType:
    fields = [_s("DESYNPUF_ID"), _s("CLM_ID"), _s("CLM_FROM_DT"), _d("CLM_PMT_AMT")]
    if drg:
        fields.append(_s("CLM_DRG_CD"))
    fields.append(_s("ADMTNG_ICD9_DGNS_CD"))
    fields += [_s(f"ICD9_DGNS_CD_{i}") for i in range(1, INST_ICD_SLOTS + 1)]
    fields += [_s(f"HCPCS_CD_{i}") for i in range(1, INST_HCPCS_SLOTS + 1)]
    return T.StructType(fields)


CARRIER = T.StructType(
    [_s("DESYNPUF_ID"), _s("CLM_ID"), _s("CLM_FROM_DT")]
    + [_s(f"ICD9_DGNS_CD_{i}") for i in range(1, CARRIER_ICD_SLOTS + 1)]
    + [_s(f"LINE_ICD9_DGNS_CD_{i}") for i in range(1, CARRIER_LINE_SLOTS + 1)]
    + [_s(f"HCPCS_CD_{i}") for i in range(1, CARRIER_LINE_SLOTS + 1)]
    + [_d(f"LINE_NCH_PMT_AMT_{i}") for i in range(1, CARRIER_LINE_SLOTS + 1)]
)

SCHEMAS = {
    "beneficiary": BENEFICIARY,
    "inpatient": institutional(drg=True),
    "outpatient": institutional(drg=False),
    "carrier": CARRIER,
}

LOOKUP = T.StructType([_s("ICD9_CD"), _s("ICD9_DESC_LONG")])
