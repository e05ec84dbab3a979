"""Data profiles (P1-P7) as single aggregates, never row loops on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortlens.operators.evaluate import cumulative_before
from cohortlens.session import written


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Per column the NULL count and percent (2 decimals); with
    ``only_missing`` only columns that have NULLs."""
    cols = df.columns
    one = df.agg(F.count("*").alias("_n"), *[F.count(F.when(F.col(c).isNull(), True)).alias(f"_m{i}")
                                             for i, c in enumerate(cols)])
    long = one.select("_n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("null_count")) for i, c in enumerate(cols)])))
    out = long.select("column_name", "null_count",
                      F.when(F.col("_n") > 0, F.floor((F.lit(20000) * F.col("null_count") + F.col("_n"))
                                                      / (2 * F.col("_n"))) / 100.0).alias("null_pct"))
    return out.filter(F.col("null_count") > 0) if only_missing else out


def written_with_nulls(df: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """Write ``df`` and read it back, with its row count (``rows``) and each column's NULL count (P1, P2): the counts are
    observed while the rows pass to the files, so nothing is scanned for them."""
    seen = Observation(f"{name}_nulls")
    watched = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(F.col(c).isNull(), True)).alias(c) for c in df.columns])
    table = written(watched, name)
    got = seen.get
    return table, {"rows": got["_rows"], **{c: got[c] for c in df.columns}}


def counts(df: DataFrame, label: str) -> DataFrame:
    """Rows and label total in one pass."""
    return df.agg(F.count("*").alias("rows"), F.sum(label).cast("long").alias("positives"))


def numeric_summary(df: DataFrame, col: str, digits: int | None = None, approx: bool = False,
                    accuracy: int = 1_000_000) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max.  Mean from an exact
    decimal sum; spread statistics rounded to ``digits`` on request.

    Exact quartiles (linear interpolation) come from running counts over the
    distinct values in range-partitioned slices, so no task holds all values;
    ``approx=True`` uses a bounded-memory quantile sketch with relative rank
    error 1/accuracy."""
    x = F.col(col)
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    if approx:
        qs = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy)
        quartiles = [qs[i] for i in range(3)]
    else:
        per_value = df.where(x.isNotNull()).groupBy(x.cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
        q = _order_statistics(cumulative_before(per_value, "v", ["c"]), (0.25, 0.5, 0.75)).scalar()
        quartiles = [shown(q[i]) for i in range(3)]
    return df.agg(
        F.count(x).alias("count"),
        (F.sum(x.cast("decimal(18,2)")).cast("double") / F.count(x)).alias("mean"),
        shown(F.stddev_samp(x)).alias("std"), F.min(x).alias("min"),
        *[v.alias(n) for v, n in zip(quartiles, ("q25", "q50", "q75"))], F.max(x).alias("max"))


def _order_statistics(cum: DataFrame, qs: tuple) -> DataFrame:
    """Interpolated quantiles from (v, c, before_c): an array, one row."""
    n = cum.agg(F.sum("c")).scalar()

    def at(rank):  # the value whose run of equal rows holds the rank
        return F.max(F.when((F.col("before_c") <= rank) & (rank < F.col("before_c") + F.col("c")), F.col("v")))

    out = []
    for q in qs:
        pos = (n - 1) * F.lit(q)
        lo, hi = at(F.floor(pos)), at(F.ceil(pos))
        out.append(lo + (hi - lo) * F.any_value(pos - F.floor(pos)))
    return cum.agg(F.array(*out).alias("q"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, NULL dropped, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def non_null_schema(df: DataFrame) -> DataFrame:
    """P5: column, Spark type and non-NULL count (one aggregate)."""
    types = dict(df.dtypes)
    one = df.agg(*[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"_c{i}").alias("non_null"))
        for i, c in enumerate(df.columns)])))


def flag_prevalence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Percent of rows with each 0/1 flag set, largest first."""
    one = df.agg(*[F.avg(F.col(c)).alias(f"_p{i}") for i, c in enumerate(flags)])
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("flag"), (F.col(f"_p{i}") * 100).alias("prevalence_pct"))
        for i, c in enumerate(flags)])))
    return long.orderBy(F.desc("prevalence_pct"), F.asc("flag"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from min to max; the maximum belongs to the last
    bin.  min / max are scalar subqueries (computed once)."""
    lo = df.agg(F.min(col).cast("double")).scalar()
    hi = df.agg(F.max(col).cast("double")).scalar()
    b = F.least(F.floor((F.col(col) - lo) / (hi - lo) * bins) + 1, F.lit(bins))
    b = F.when(hi > lo, b).otherwise(F.lit(1))
    return (df.filter(F.col(col).isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count("*").alias("count"))
            .select("bin", (lo + (F.col("bin") - 1) * (hi - lo) / bins).alias("bin_start"), "count"))
