"""Lookback features (J5, J6, A7-A10, C21; Q6)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import money

KEYS = [S.PERSON, S.LABEL, S.INDEX_DATE]


def code_token(code: str) -> str:
    """Feature-name form of a code: dots and other non-alphanumerics removed (C17)."""
    return re.sub(r"[^0-9A-Za-z]", "", code)


def lookback(index_dates: DataFrame, claims: DataFrame, days: int, person: str = S.PERSON,
             date: str = S.DATE, index_date: str = S.INDEX_DATE) -> DataFrame:
    """Claims with index_date - days <= date < index_date, same person.

    Inner equi-join on person plus a range predicate.  Both sides shuffle on
    person; the per-person aggregate that follows reuses that partitioning.
    A person holding a large share of claims is split by AQE's skew-join
    handling (inner joins can split either side)."""
    i = index_dates.alias("i")
    c = claims.alias("c")
    idx = F.col(f"i.{index_date}")
    is_ts = dict(index_dates.dtypes)[index_date].startswith("timestamp")
    lower = idx - F.expr(f"INTERVAL {int(days)} DAYS") if is_ts else F.date_sub(idx, days)
    cond = ((F.col(f"i.{person}") == F.col(f"c.{person}")) &
            (F.col(f"c.{date}") >= lower) &
            (F.col(f"c.{date}") < F.col(f"i.{index_date}")))
    return i.join(c, cond, "inner").select("i.*", *[F.col(f"c.{x}") for x in claims.columns if x != person])


def feature_aggregates(days: int, icd_codes: Sequence[str] = (), hcpcs_codes: Sequence[str] = (),
                       pairs: Sequence[tuple[str, str]] = (),
                       types: Sequence[str] = tuple(S.CLAIM_TYPES)) -> list:
    """A7-A10 as one list of aggregate expressions (one pass, one group-by)."""
    aggs = []
    for t in types:
        is_t = F.col(S.FILE_TYPE) == F.lit(t)
        aggs.append(F.count(F.when(is_t, F.col(S.CLAIM))).cast("int").alias(f"{t}_count_{days}d"))
        aggs.append(F.sum(F.when(is_t, money(S.AMOUNT))).cast("double").alias(f"{t}_amt_{days}d"))
    for c in icd_codes:
        aggs.append(F.max(F.array_contains(S.ICD, F.lit(c)).cast("int")).alias(f"icd9_{code_token(c)}_{days}d"))
    for a, b in pairs:
        both = F.array_contains(S.ICD, F.lit(a)) & F.array_contains(S.ICD, F.lit(b))
        aggs.append(F.max(both.cast("int"))
                    .alias(f"icd9_{code_token(a)}_and_{code_token(b)}_{days}d"))
    for c in hcpcs_codes:
        aggs.append(F.max(F.array_contains(S.HCPCS, F.lit(c)).cast("int")).alias(f"hcpcs_{code_token(c)}_{days}d"))
    return aggs


def engineer_features(index_dates: DataFrame, claims: DataFrame, demographics: DataFrame | None,
                      days: int = 30, icd_codes: Sequence[str] = (), hcpcs_codes: Sequence[str] = (),
                      pairs: Sequence[tuple[str, str]] = (), types: Sequence[str] = tuple(S.CLAIM_TYPES),
                      demographic_fill: Sequence[str] = ()) -> DataFrame:
    """Q6: one row per index date with demographics (J5, left), per-type
    counts and amounts (A7), diagnosis flags (A8), same-claim pair flags (A9),
    procedure flags (A10); absent values zero-filled (C21).

    The reference's 6 + one-per-code group-by/left-join rounds become one
    range join and one aggregate; the result is joined back to the index
    dates (left) so people without claims in the window keep a zero row.
    """
    window = lookback(index_dates, claims.select(S.PERSON, S.CLAIM, S.DATE, S.AMOUNT, S.FILE_TYPE,
                                                 *([S.ICD] if (icd_codes or pairs) else []),
                                                 *([S.HCPCS] if hcpcs_codes else [])), days)
    return features_from_window(index_dates, window, demographics, days, icd_codes, hcpcs_codes, pairs,
                                types, demographic_fill)


def features_from_window(index_dates: DataFrame, window: DataFrame, demographics: DataFrame | None,
                         days: int, icd_codes: Sequence[str] = (), hcpcs_codes: Sequence[str] = (),
                         pairs: Sequence[tuple[str, str]] = (), types: Sequence[str] = tuple(S.CLAIM_TYPES),
                         demographic_fill: Sequence[str] = ()) -> DataFrame:
    """Q6 from an already windowed claim table (see ``engineer_features``)."""
    aggs = feature_aggregates(days, icd_codes, hcpcs_codes, pairs, types)
    agg = window.groupBy(*KEYS).agg(*aggs)
    base = index_dates
    if demographics is not None:
        base = base.join(demographics, S.PERSON, "left")
    out = base.join(agg, KEYS, "left")
    feat_cols = [c for c in agg.columns if c not in KEYS]
    ints = [c for c in feat_cols if "_amt_" not in c] + list(demographic_fill)
    dbls = [c for c in feat_cols if "_amt_" in c]
    return out.fillna(0, subset=ints).fillna(0.0, subset=dbls)
