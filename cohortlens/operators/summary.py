"""Summary pipeline operators: year filter, per-person totals, top-N, merged claims
(C7, C14, C15, A1, T1, J3, U1, U5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import money_sum, year_range

# Per-type column roles of the claim files (fixed values of the file layout).
FILE_LAYOUT = {
    "inpatient": {"amount": "CLM_PMT_AMT", "dx": "ICD9_DGNS_CD_1", "proc": "CLM_DRG_CD"},
    "outpatient": {"amount": "CLM_PMT_AMT", "dx": "ICD9_DGNS_CD_1", "proc": "HCPCS_CD_1"},
    "carrier": {"amount": "LINE_NCH_PMT_AMT_1", "dx": "ICD9_DGNS_CD_1", "proc": "HCPCS_CD_1"},
}


def filter_year(dfs: Mapping[str, DataFrame], year: int, date_col: str = "CLM_FROM_DT",
                claim_types: Sequence[str] = tuple(S.CLAIM_TYPES)) -> dict[str, DataFrame]:
    """Claims whose service year is ``year``; other frames pass through.

    Written as a date range so Parquet statistics prune row groups.  An
    empty result stays an empty DataFrame (trap K3).
    """
    out = dict(dfs)
    for t in claim_types:
        if t in out and out[t] is not None:
            out[t] = out[t].filter(year_range(date_col, year))
    return out


def stack_claims(dfs: Mapping[str, DataFrame], layout: Mapping[str, Mapping[str, str]] = FILE_LAYOUT,
                 person: str = "DESYNPUF_ID", claim: str = "CLM_ID", date: str = "CLM_FROM_DT") -> DataFrame:
    """C14 + C15 + U1: claim files to one frame in the merged layout
    (person, claim, date, claim_amt, primary_dx, prcdr_drg_cd, file_type)."""
    parts = []
    for t, roles in layout.items():
        if t not in dfs or dfs[t] is None:
            continue
        parts.append(dfs[t].select(
            F.col(person).cast("string").alias(S.PERSON), F.col(claim).cast("string").alias(S.CLAIM),
            F.col(date).alias(S.DATE), F.col(roles["amount"]).cast("double").alias(S.AMOUNT),
            F.col(roles["dx"]).alias(S.DX), F.col(roles["proc"]).alias(S.PROC),
            F.lit(t).alias(S.FILE_TYPE)))
    if not parts:
        raise ValueError("No valid claims DataFrames")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def person_totals(claims: DataFrame, person: str = S.PERSON, amount: str = S.AMOUNT,
                  total: str = "total_payment") -> DataFrame:
    """A1: total payment per person over all claim types.

    One aggregate over the stacked claims: Spark computes partial sums per
    map task before the shuffle, so a person holding a large share of the
    claims sends one row per task, not one per claim.
    """
    return (claims.filter(F.col(person).isNotNull())
            .groupBy(person).agg(F.coalesce(money_sum(amount), F.lit(0.0)).alias(total)))


def top_n(df: DataFrame, n: int, metric: str, key: str, descending: bool = True) -> DataFrame:
    """N rows with the largest (smallest) metric; ties broken by key.

    orderBy + limit plans as TakeOrderedAndProject: each task keeps its own
    top n and only those reach the final merge.
    """
    order = F.desc(metric) if descending else F.asc(metric)
    return df.orderBy(order, F.asc(key)).limit(n)


def top_persons(claims: DataFrame, n: int = 100, person: str = S.PERSON, amount: str = S.AMOUNT) -> DataFrame:
    """The n people with the largest total payment (ties: smaller id first)."""
    return top_n(person_totals(claims, person, amount), n, "total_payment", person)


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Semi-join against a key list; the planner picks the join by the
    list's measured size (AQE)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def merge_claims(claims: DataFrame, top: DataFrame, person: str = S.PERSON) -> DataFrame:
    """Claims of the selected people in the merged layout."""
    cols = [S.PERSON, S.CLAIM, S.DATE, S.AMOUNT, S.DX, S.PROC, S.FILE_TYPE]
    return keep_keys(claims, top, person).select(*cols)


def summary_pipeline(claims: DataFrame, year: int, n: int = 100, output_path: str | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Q1 over stacked claims: year filter, top-n people, their merged claims."""
    from cohortlens.sources.files import write_table

    in_year = claims.filter(year_range(S.DATE, year))
    merged = merge_claims(in_year, top_persons(in_year, n))
    if output_path:
        write_table(merged, output_path, fmt=fmt)
    return merged
