"""Dashboard queries.

The reference serves these through a web UI; here they are parameterised
query functions over the merged claim table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import money_sum, normalize_key
from cohortlens.operators.summary import top_n


def totals_by(claims: DataFrame, key: str, amount: str = S.AMOUNT, claim: str = S.CLAIM) -> DataFrame:
    """A2: total payment and claim count (non-NULL claim ids) per key.
    NULL keys are dropped and an all-NULL sum is 0 (trap K13)."""
    return (claims.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.coalesce(money_sum(amount), F.lit(0.0)).alias("total_payment"),
                 F.count(claim).alias("claim_count")))


def normalized_lookup(lookup: DataFrame, code: str = "code", desc: str = "description") -> DataFrame:
    """C16 + K6: lookup keys normalised; keys that collide after normalising
    keep their smallest description, so the join cannot repeat rows."""
    return (lookup.select(normalize_key(code).alias("_code"), F.col(desc).alias("_desc"))
            .groupBy("_code").agg(F.min("_desc").alias("_desc")))


def describe(df: DataFrame, lookup: DataFrame, key: str = S.DX, out: str = "description") -> DataFrame:
    """Left lookup; a missing description falls back to the code.

    The lookup is a code vocabulary, not claim data; the planner broadcasts
    it when its measured size is under the threshold.
    """
    lk = normalized_lookup(lookup)
    return (df.join(lk, df[key] == lk["_code"], "left")
            .withColumn(out, F.coalesce(F.col("_desc"), F.col(key)))
            .drop("_code", "_desc"))


def with_normalized_dx(claims: DataFrame, dx: str = S.DX) -> DataFrame:
    return claims.withColumn(dx, normalize_key(dx))


def top_codes(claims: DataFrame, lookup: DataFrame, k: int = 10, dx: str = S.DX) -> DataFrame:
    """A3: payment and count per (normalised) diagnosis, described, top k."""
    agg = totals_by(with_normalized_dx(claims, dx), dx)
    return describe(top_n(agg, k, "total_payment", dx), lookup, dx)


def period_spine(spark: SparkSession, period: str, year: int,
                 types: Sequence[str] = tuple(S.CLAIM_TYPES), max_week: int = 53) -> DataFrame:
    """Every (week 1..max_week | month of ``year``) x file type.

    Built with generators (range + explode), not a cross join; its size is
    fixed by the parameters."""
    kinds = F.explode(F.array(*[F.lit(t) for t in types])).alias(S.FILE_TYPE)
    if period == "week":
        return spark.range(1, max_week + 1).select(F.col("id").cast("int").alias("week"), kinds)
    return spark.range(1, 13).select(
        F.format_string(f"{year}-%02d", F.col("id").cast("int")).alias("month"), kinds)


def period_series(claims: DataFrame, period: str = "week", year: int = 2009,
                  types: Sequence[str] = tuple(S.CLAIM_TYPES), max_week: int = 53,
                  date: str = S.DATE, amount: str = S.AMOUNT) -> DataFrame:
    """A4 + J8: payment per (ISO week | yyyy-MM month, file type), zero-filled
    over the spine.  The spine has all 53 ISO weeks a calendar year's dates can
    fall in, so no payment is lost; ``max_week=52`` gives the shorter series
    that leaves week 53 out (trap K5)."""
    key = F.weekofyear(date) if period == "week" else F.date_format(date, "yyyy-MM")
    col = "week" if period == "week" else "month"
    agg = (claims.filter(F.col(S.FILE_TYPE).isNotNull())
           .groupBy(key.alias(col), F.col(S.FILE_TYPE)).agg(money_sum(amount).alias(amount)))
    spine = period_spine(claims.sparkSession, period, year, types, max_week)
    return (spine.join(agg, [col, S.FILE_TYPE], "left")
            .withColumn(amount, F.coalesce(F.col(amount), F.lit(0.0)))
            .orderBy(col, S.FILE_TYPE))


def drilldown(claims: DataFrame, person=None, dx: str | None = None) -> DataFrame:
    """Rows of one person, else of one diagnosis; the person wins."""
    if person is not None:
        return claims.filter(F.col(S.PERSON) == F.lit(person))
    if dx is not None:
        return claims.filter(F.col(S.DX) == F.lit(dx))
    return claims


def drilldown_by(claims: DataFrame, selection: DataFrame, key: str) -> DataFrame:
    """C23 with the selection as a (one-row) DataFrame, e.g. the first row of
    a ranked table, so the selected key never passes through the driver."""
    return claims.join(F.broadcast(selection.select(key).limit(1)), key, "left_semi")
