"""Code enrichment between classes (R1-R3, A11-A18, X1-X4, U4; Q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import stats as st
from cohortlens.operators.evaluate import cumulative_before
from cohortlens.session import written

CODE = "code"


def explode_codes(window: DataFrame, codes: str = S.ICD, person: str = S.PERSON,
                  label: str = S.LABEL) -> DataFrame:
    """R2: one row per (person, class, code) occurrence; empty lists vanish."""
    return window.select(person, label, F.explode(codes).alias(CODE)).filter(F.col(CODE).isNotNull())


def melt_slots(df: DataFrame, slot_cols, drop=("", "None"), person: str = S.PERSON,
               label: str = S.LABEL, ids=None) -> DataFrame:
    """Slot columns to (ids..., code) rows, dropping NULL and junk; ids
    default to (person, class)."""
    long = df.unpivot(list(ids) if ids else [person, label], list(slot_cols), "slot", CODE)
    return long.filter(F.col(CODE).isNotNull() & ~F.col(CODE).isin(*drop)).drop("slot")


def frequency(long: DataFrame, person: str = S.PERSON, label: str = S.LABEL) -> DataFrame:
    """Occurrences per (person, class, code)."""
    return long.groupBy(person, label, CODE).agg(F.count("*").alias("frequency"))


def presence(long: DataFrame, person: str = S.PERSON, label: str = S.LABEL) -> DataFrame:
    """Distinct (person, class, code)."""
    return long.select(person, label, CODE).distinct()


def marked_presence(window: DataFrame, long: DataFrame | None = None, codes: str = S.ICD, person: str = S.PERSON,
                    label: str = S.LABEL) -> DataFrame:
    """A12 + A16 in one stream: distinct (person, class, code), with a NULL code
    for every person of the window.  From the window's own code arrays, so the
    window is evaluated once, or from separate ``long`` rows."""
    if long is None:
        cells = F.concat(F.coalesce(F.col(codes), F.array().cast("array<string>")), F.array(F.lit(None).cast("string")))
        return window.select(person, label, F.explode(cells).alias(CODE)).distinct()
    people = window.select(person, label, F.lit(None).cast("string").alias(CODE))
    return people.union(long.where(F.col(CODE).isNotNull()).select(person, label, CODE)).distinct()


def _with_totals(per_code: DataFrame, pos: str, neg: str) -> DataFrame:
    """Per-code rows with the NULL code's counts as ``n_pos`` and ``n_neg`` (a
    window over one row a code), without that row."""
    whole = Window.partitionBy()

    def total(c):
        return F.coalesce(F.max(F.when(F.col(CODE).isNull(), F.col(c))).over(whole), F.lit(0)).cast("double")

    return (per_code.withColumn("n_pos", total(pos)).withColumn("n_neg", total(neg)).where(F.col(CODE).isNotNull()))


def code_levels(long: DataFrame, first=()) -> list[str]:
    """The codes of ``first``, then every other code of ``long`` in order; more
    than Spark's bound on pivot columns is an error, nothing is dropped."""
    first = list(first)
    most = int(long.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = long.select(CODE).where(F.col(CODE).isNotNull()).distinct().limit(most + 1).collect()
    levels = first + sorted({r[0] for r in rows} - set(first))
    if len(levels) > most:
        raise ValueError(f"more than {most} codes to pivot; keep them long or raise spark.sql.pivotMaxValues")
    return levels


def pivot_wide(long: DataFrame, codes=None, value: str = "presence", person: str = S.PERSON,
               label: str = S.LABEL) -> DataFrame:
    """Long (person, class, code) rows to one column per code, absent = 0.
    ``value`` 'presence' takes the max of 1, 'frequency' counts occurrences.
    Without ``codes`` all codes found get a column, at the price of a distinct
    pass; an explicit list saves the pass and leaves other codes out."""
    codes = code_levels(long) if codes is None else list(codes)
    if not codes:
        return long.select(person, label).distinct()
    g = long.groupBy(person, label).pivot(CODE, codes)
    out = g.agg(F.max(F.lit(1))) if value == "presence" else g.agg(F.count(F.lit(1)))
    cells = [(c, F.col("`" + c.replace("`", "``") + "`")) for c in codes]
    return out.select(person, label, *[F.coalesce(x, F.lit(0)).alias(c) for c, x in cells])


def pivot_sparse(long: DataFrame, value: str = "frequency", person: str = S.PERSON, label: str = S.LABEL) -> tuple[DataFrame, DataFrame]:
    """A13 for any number of codes: ((code, level): every code's place from 0 in sorted order; (person, class, size,
    indices, values): one sparse row a person, indices rising).  Nothing grows with people times codes."""
    seen = written(frequency(long.where(F.col(CODE).isNotNull()), person, label), "code_frequency")
    levels = cumulative_before(seen.select(CODE).distinct().withColumn("_one", F.lit(1)), CODE, ["_one"]).select(
        CODE, F.col("before__one").cast("int").alias("level"))
    cell = F.struct("level", (F.lit(1) if value == "presence" else F.col("frequency")).cast("int").alias("v"))
    rows = seen.join(levels, CODE).groupBy(person, label).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))  # one cell a code
    size = levels.agg(F.count(F.lit(1)).cast("int")).scalar()
    return levels, rows.select(person, label, size.alias("size"), F.col("_cells.level").alias("indices"), F.col("_cells.v").alias("values"))


def class_means(long: DataFrame, person: str = S.PERSON, label: str = S.LABEL) -> DataFrame:
    """Per code, mean presence and mean frequency by class over the
    people with at least one code in the window; difference and ratio.

    Prevalence ratio is NULL when the negative mean is 0; frequency ratio is
    infinite there (the reference's two conventions)."""
    marked = long.select(person, label, F.explode(F.array(F.col(CODE), F.lit(None).cast("string"))).alias(CODE))
    per_code = _with_totals(frequency(marked, person, label).groupBy(CODE).agg(
        F.count(F.when(F.col(label) == 1, True)).alias("pos_people"),
        F.count(F.when(F.col(label) == 0, True)).alias("neg_people"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("frequency"))), F.lit(0)).alias("pos_freq"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("frequency"))), F.lit(0)).alias("neg_freq")), "pos_people", "neg_people")
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    pp, pn = F.try_divide(F.col("pos_people"), n_pos), F.try_divide(F.col("neg_people"), n_neg)
    fp, fn = F.try_divide(F.col("pos_freq"), n_pos), F.try_divide(F.col("neg_freq"), n_neg)
    return per_code.select(
        CODE,
        pp.alias("prev_pos"), pn.alias("prev_neg"), (pp - pn).alias("prev_diff"),
        F.when(pn == 0, F.lit(None).cast("double")).otherwise(pp / pn).alias("prev_ratio"),
        fp.alias("freq_pos"), fn.alias("freq_neg"), (fp - fn).alias("freq_diff"),
        F.when(fn == 0, F.lit(st.INF)).otherwise(fp / fn).alias("freq_ratio"))


def screen_codes(means: DataFrame, min_diff: float = 0.01, min_ratio: float = 2.0) -> DataFrame:
    """X4 + U4: codes passing the prevalence screen or the frequency screen
    (difference > min_diff and ratio > min_ratio; NULL ratios fail, infinite
    pass), as one distinct code list."""
    prev = (F.col("prev_diff") > min_diff) & (F.col("prev_ratio") > min_ratio)
    freq = (F.col("freq_diff") > min_diff) & (F.col("freq_ratio") > min_ratio)
    return means.filter(prev | freq).select(CODE)


def class_averages(window: DataFrame, person: str = S.PERSON, label: str = S.LABEL) -> DataFrame:
    """Mean per-person claim count and spend by (class, file type); people
    with no claim of a type are not in that mean."""
    per = window.groupBy(person, label, S.FILE_TYPE).agg(
        F.count(S.CLAIM).alias("claim_count"),
        F.sum(F.col(S.AMOUNT).cast("decimal(18,2)")).alias("spend"))
    return per.groupBy(label, S.FILE_TYPE).agg(
        (F.sum("claim_count") / F.count("*")).alias("avg_claim_count"),
        (F.sum("spend").cast("double") / F.count("*")).alias("avg_spend"))


def prevalence_by_class(window: DataFrame, long: DataFrame | None = None, top: int | None = 10,
                        person: str = S.PERSON, label: str = S.LABEL, codes: str = S.ICD) -> DataFrame:
    """Per code, share of people of each class with the code, over the
    people with a claim in the window (K10); difference; top by difference."""
    t = contingency(window, long, person, label, codes)
    out = t.select(CODE, F.try_divide(F.col("pos_with_code").cast("double"), F.col("n_pos")).alias("prevalence_pos"),
                   F.try_divide(F.col("neg_with_code").cast("double"), F.col("n_neg")).alias("prevalence_neg"))
    out = out.withColumn("difference", F.col("prevalence_pos") - F.col("prevalence_neg"))
    if top:
        out = out.orderBy(F.desc("difference"), F.asc(CODE)).limit(top)
    return out


def contingency(window: DataFrame, long: DataFrame | None = None, person: str = S.PERSON,
                label: str = S.LABEL, codes: str = S.ICD) -> DataFrame:
    """Per code, people with the code in each class and the class totals
    (people with a claim in the window)."""
    per_code = marked_presence(window, long, codes, person, label).groupBy(CODE).agg(
        F.count(F.when(F.col(label) == 1, True)).alias("pos_with_code"),
        F.count(F.when(F.col(label) == 0, True)).alias("neg_with_code"))
    t = _with_totals(per_code, "pos_with_code", "neg_with_code")
    return t.select(CODE, "pos_with_code", "neg_with_code", F.col("n_pos").cast("long").alias("n_pos"),
                    F.col("n_neg").cast("long").alias("n_neg"))


def code_statistics(table: DataFrame, p_values: bool = True) -> DataFrame:
    """A18 + X1 + X2 over (pos_with_code, neg_with_code, n_pos, n_neg)."""
    a, c = F.col("pos_with_code"), F.col("neg_with_code")
    b, d = F.col("n_pos") - a, F.col("n_neg") - c
    pp = F.when(F.col("n_pos") > 0, a / F.col("n_pos")).otherwise(F.lit(0.0))
    pn = F.when(F.col("n_neg") > 0, c / F.col("n_neg")).otherwise(F.lit(0.0))
    out = table.select(
        CODE,
        pp.alias("prevalence_positive"), pn.alias("prevalence_negative"),
        (pp - pn).alias("prevalence_difference"),
        F.when(pn > 0, pp / pn).otherwise(F.lit(st.INF)).alias("prevalence_ratio"),
        st.odds_ratio(a, b, c, d).alias("odds_ratio"),
        st.yates_chi2(a, b, c, d).alias("chi2"),
        "pos_with_code", "neg_with_code")
    if p_values:
        out = out.withColumn("p_value", st.chi2_pvalue("chi2"))
    return out


def significance_screen(stats: DataFrame, use_p: bool = True, alpha_chi2: float = st.CHI2_CRIT_05,
                        or_hi: float = 2.0, or_lo: float = 0.5, min_diff: float = 0.01) -> DataFrame:
    """Positive (OR > 2, diff > 0.01) or negative (OR < 0.5, diff < -0.01)
    associations with p < 0.05, sorted by odds ratio descending.  With
    ``use_p=False`` the test is the equivalent chi2 > 3.8415 (no UDF)."""
    sig = (F.col("p_value") < 0.05) if use_p else (F.col("chi2") > alpha_chi2)
    pos = (F.col("odds_ratio") > or_hi) & (F.col("prevalence_difference") > min_diff)
    neg = (F.col("odds_ratio") < or_lo) & (F.col("prevalence_difference") < -min_diff)
    return stats.filter(sig & (pos | neg)).orderBy(F.desc("odds_ratio"), F.asc(CODE))
