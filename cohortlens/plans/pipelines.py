"""End-to-end pipelines over claim files (Q1, Q8), each stage written out.

Stage outputs go to ``out_dir`` (a shared folder on a cluster); every later
stage reads the written table, so a lost executor never re-runs earlier
stages, and lineage stays short.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.operators import clean as cn
from cohortlens.operators import cohort as co
from cohortlens.operators import features as fe
from cohortlens.operators import summary as sm
from cohortlens.sources import files


def summary_from_files(spark: SparkSession, data_dir: str, year: int, n: int, out_path: str,
                       fmt: str = "csv") -> DataFrame:
    """Q1: load every claim file, type and clean it, filter the year, pick the
    top-n payers, write their merged claims."""
    dfs = files.load_all(spark, data_dir)
    typed = {t: cn.handle_missing(cn.convert_types(df, t), t) for t, df in dfs.items()}
    stacked = sm.stack_claims({t: d for t, d in typed.items() if t in S.CLAIM_TYPES})
    return sm.summary_pipeline(stacked, year, n, out_path, fmt)


def cohort_from_files(spark: SparkSession, beneficiary_path: str, claim_paths: Mapping[str, str],
                      out_dir: str, case_code: str = "0389", year: int = 2009, lookback_days: int = 30,
                      icd_codes: Sequence[str] = (), hcpcs_codes: Sequence[str] = (),
                      pairs: Sequence[tuple[str, str]] = (), claim_start: str = "2008-12-02",
                      claim_end: str = "2009-12-31", control_start: str = "2009-01-01",
                      control_end: str = "2009-12-25", seed: int = 42) -> DataFrame:
    """Q8: beneficiaries (Q2), claims of each type (Q3) unioned with their
    type tag, cases (Q4) from inpatient claims, index dates (Q5), lookback
    features (Q6), dataset written (Q7)."""
    ben = cn.load_beneficiary(files.load_typed(spark, beneficiary_path, "beneficiary"), year)
    claims = None
    for t, path in claim_paths.items():
        c = cn.load_claims(files.load_typed(spark, path, t), t, claim_start, claim_end)
        claims = c if claims is None else claims.unionByName(c)
    claims_path = files.write_table(claims, f"{out_dir}/claims")
    claims = spark.read.parquet(claims_path)
    ben = ben.withColumnRenamed("DESYNPUF_ID", S.PERSON)
    cases = co.find_cases(claims.filter(F.col(S.FILE_TYPE) == "inpatient"), case_code, year)
    cases = spark.read.parquet(files.write_table(cases, f"{out_dir}/cases"))
    idx = co.assign_index_dates(cases, claims, ben, year, control_start, control_end, seed)
    idx = spark.read.parquet(files.write_table(idx, f"{out_dir}/index_dates"))
    demo_fill = ["age", "chronic_condition_count"] + [c for c in S.CHRONIC_COLUMNS if c in ben.columns]
    feats = fe.engineer_features(idx, claims, ben, lookback_days, icd_codes, hcpcs_codes, pairs,
                                 demographic_fill=demo_fill)
    feats = feats.withColumn(S.LABEL, F.col(S.LABEL).cast("byte"))
    return spark.read.parquet(files.write_table(feats, f"{out_dir}/dataset"))
