"""Case finding and index dates (C20, A5, A6, J1, J2, J4, C8, U1; Q4, Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions.cleaning import year_range


def find_cases(claims: DataFrame, code: str, year: int, codes: str = S.ICD,
               person: str = S.PERSON, date: str = S.DATE) -> DataFrame:
    """Q4: people with a claim in ``year`` carrying ``code`` in any slot, and
    their latest such date (person, latest_case_date)."""
    hit = claims.filter(year_range(date, year) & F.array_contains(F.col(codes), F.lit(code)))
    return latest_dates(hit, person, date)


def latest_dates(case_claims: DataFrame, person: str = S.PERSON, date: str = S.DATE) -> DataFrame:
    """A5: latest case-claim date per person.  Partial max per map task
    before the shuffle, so a hot person costs one row per task."""
    return case_claims.groupBy(person).agg(F.max(date).alias("latest_case_date"))


def seeded_draw_key(person: str, claim: str, seed: int) -> F.Column:
    """A6 key: the first 60 bits of the md5 of (person, claim, seed), so the
    draw is a hash aggregate.  The same under any partitioning and retry,
    independent between people (trap K19)."""
    text = F.concat_ws("|", F.col(person).cast("string"), F.col(claim).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def draw_one_date(claims: DataFrame, seed: int = 42, person: str = S.PERSON,
                  claim: str = S.CLAIM, date: str = S.DATE) -> DataFrame:
    """One claim row per person drawn with a seeded hash -> (person, index_date).

    min_by over a long key is a hash aggregate with a partial phase, so no
    group is ever collected into one task."""
    return (claims.groupBy(person)
            .agg(F.min_by(F.col(date), seeded_draw_key(person, claim, seed)).alias(S.INDEX_DATE)))


def people_with_claims(persons: DataFrame, claims: DataFrame, person: str = S.PERSON) -> DataFrame:
    """Covered people having at least one claim.  The right side is
    deduplicated on the map side first, so a hot person is one row a task."""
    return persons.select(person).join(claims.select(person).distinct(), person, "left_semi")


def assign_index_dates(cases: DataFrame, claims: DataFrame, persons: DataFrame,
                       year: int, start: str, end: str, seed: int = 42,
                       person: str = S.PERSON, claim: str = S.CLAIM, date: str = S.DATE) -> DataFrame:
    """Q5: (person, case_ind, index_date).

    Cases keep their latest case date (they need not be covered, trap K7);
    ``cases`` may have several rows a person.  Controls are covered people
    with a claim in ``year`` who are not cases; their index date is one seeded
    draw among their claims in [start, end].  A person with claims in the year
    but none in [start, end] has no draw and is not a control, as in the
    reference (inner merge then filter).

    One aggregate over the union of three narrow streams (claims, covered
    people, case dates) replaces J1, J2 and J4: one exchange on the person,
    with partial sums, and no join.
    """
    nothing = {"_d": F.lit(None).cast("date"), "_k": F.lit(None).cast("long"), "_cov": F.lit(None).cast("int"),
               "_case": F.lit(None).cast("date")}

    def stream(df, **cols):
        return df.where(F.col(person).isNotNull()).select(person, *[cols.get(n, v).alias(n) for n, v in nothing.items()])

    window = claims.filter(year_range(date, year) &
                           F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    rows = (stream(window, _d=F.col(date), _k=seeded_draw_key(person, claim, seed))
            .unionByName(stream(persons, _cov=F.lit(1)))
            .unionByName(stream(cases, _case=F.col("latest_case_date"))))
    one = rows.groupBy(person).agg(F.min_by("_d", "_k").alias("_d"), F.max("_cov").alias("_cov"), F.max("_case").alias("_case"))
    return (one.where(F.col("_case").isNotNull() | (F.col("_cov").isNotNull() & F.col("_d").isNotNull()))
            .select(person, F.col("_case").isNotNull().cast("int").alias(S.LABEL),
                    F.coalesce("_case", "_d").alias(S.INDEX_DATE)))
