"""Code-pair screening over person-level flag columns (A19, A20, J11, R4, R5,
U3, X5-X9; Q11).

Pairs are pairs of flag *columns* (a parameter list, column-position order)
that occur together on some person; they are formed within each person's set
of present flags and counted with partial aggregation.  The rankings
(``top_pairs``) also hold the pairs that never occur together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.functions import stats as st
from cohortlens.session import written

PAIR_KEYS = ["code1", "code2", "pos1", "pos2"]


def _classes(prefix: str, label: str) -> list:
    return [F.count(F.when(F.col(label) == cls, True)).alias(f"{prefix}_{name}") for cls, name in ((1, "pos"), (0, "neg"))]


def pair_sums(df: DataFrame, flags: Sequence[str], label: str = S.LABEL) -> DataFrame:
    """(pos1, pos2, n_pos, n_neg): people of each class with both flags, with
    one flag (pos1 = pos2) and at all (both -1).

    ``df`` is read once: each person gives the pairs of the flags they have,
    the flags themselves and one marker to one stream with one aggregate, whose
    result (as many rows as pairs occur) is written and read back."""
    flags = list(flags)
    if len(flags) < 2:
        raise ValueError("need at least two flag columns")
    present = F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(i)) for i, c in enumerate(flags)]), lambda x: x.isNotNull())
    pairs = F.flatten(F.transform("_has", lambda x: F.transform(
        F.filter("_has", lambda y: y >= x), lambda y: F.struct(x.alias("pos1"), y.alias("pos2")))))
    marker = F.array(F.struct(F.lit(-1).alias("pos1"), F.lit(-1).alias("pos2")))
    rows = df.select(label, present.alias("_has")).select(label, F.explode(F.concat(pairs, marker)).alias("p"))
    return written(rows.select(label, "p.*").groupBy("pos1", "pos2").agg(*_classes("n", label)), "pair_sums")


def pair_counts(df: DataFrame, flags: Sequence[str], label: str = S.LABEL) -> DataFrame:
    """J11 + A19 + A20 counts: one row per unordered pair of flags (i < j) that
    some person has both of, with, per class, the people (n), people with
    each flag (n1, n2) and with both (n11).

    Pairs are formed within each person's own set of present flags, so work
    and output follow what occurs together, not the number of flags squared."""
    return counts_of(pair_sums(df, flags, label), flags)


def counts_of(sums: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``pair_counts`` from written ``pair_sums``."""
    names = F.array(*[F.lit(c) for c in flags])
    totals = sums.where("pos1 < 0").agg(F.struct(F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))).scalar()
    both = sums.where("pos1 < pos2").select("pos1", "pos2", F.col("n_pos").alias("n11_pos"), F.col("n_neg").alias("n11_neg"))

    def side(i):
        return sums.where("pos1 = pos2 AND pos1 >= 0").select(F.col("pos1").alias(f"pos{i}"), F.col("n_pos").alias(f"n{i}_pos"),
                                                              F.col("n_neg").alias(f"n{i}_neg"))

    return (both.join(side(1), "pos1").join(side(2), "pos2")
            .select(F.get(names, F.col("pos1")).alias("code1"), F.get(names, F.col("pos2")).alias("code2"), "pos1", "pos2",
                    totals.getField("n_pos").alias("n_pos"), "n1_pos", "n2_pos", "n11_pos",
                    totals.getField("n_neg").alias("n_neg"), "n1_neg", "n2_neg", "n11_neg"))


def cooccurrence(counts: DataFrame) -> DataFrame:
    """People of the positive class with both codes."""
    return counts.select(*PAIR_KEYS, F.col("n11_pos").alias("cooccurrence_count"))


def correlations(counts: DataFrame, both_orders: bool = True) -> DataFrame:
    """X5 + R4: phi correlation in the positive class; with ``both_orders``
    each pair appears as (a, b) and (b, a), self pairs excluded (trap K16)."""
    one = counts.select(*PAIR_KEYS, st.phi("n_pos", "n1_pos", "n2_pos", "n11_pos").alias("correlation"))
    return in_both_orders(one) if both_orders else one


def lower_triangle(counts: DataFrame) -> DataFrame:
    """The heatmap half, rows with pos1 > pos2."""
    return correlations(counts).filter(F.col("pos1") > F.col("pos2"))


def mutual_information(counts: DataFrame) -> DataFrame:
    """X6 between two codes in the positive class."""
    mi = st.mutual_info("n_pos", "n1_pos", "n2_pos", "n11_pos")
    return counts.select(*PAIR_KEYS, mi.alias("mutual_info"))


def _top(df: DataFrame, metric: str, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric), "pos1", "pos2").limit(k)


def _apart_mi(n: int, a: int, b: int) -> float | None:
    """Mutual information of two flags that nobody has both of; it grows with both margins."""
    if not n:
        return None
    cells = [(a, a, n - b), (b, n - a, b), (n - a - b, n - a, n - b)]
    return sum(x / n * math.log(n * x / (p * q)) for x, p, q in cells if x > 0)


def _apart_phi(n: int, a: int, b: int) -> float | None:
    """Correlation of two flags that nobody has both of; it falls with both margins."""
    return -math.sqrt(a * b / ((n - a) * (n - b))) if 0 < a < n and 0 < b < n else None


#: metric -> (of the counted pairs, of a never-together pair, order of the flags in which the latter falls)
_RANKINGS = {
    "correlation": (lambda c: correlations(c, both_orders=False), _apart_phi, lambda n, m, i: (not 0 < m < n, m, i)),
    "cooccurrence_count": (cooccurrence, lambda n, a, b: 0, lambda n, m, i: (i,)),
    "mutual_info": (mutual_information, _apart_mi, lambda n, m, i: (-m, i)),
}


def top_pairs(sums: DataFrame, flags: Sequence[str], metric: str, k: int = 20, width: int = 64) -> DataFrame:
    """The exact top k of all pairs of flags, pairs that no person has both of included.

    Such pairs have no row in ``sums``; with nobody in common the metric
    depends on the two margins only and falls along a list of the flags
    sorted by margin.  So they are generated among the first ``width`` flags
    of that list, and among twice as many as long as a pair with a later flag
    could still reach the k-th value: never all pairs of many flags."""
    spark, flags = sums.sparkSession, list(flags)
    counted, apart, place = _RANKINGS[metric]
    known = counted(counts_of(sums, flags)).select(*PAIR_KEYS, F.col(metric))
    kind = known.schema[metric].dataType.simpleString()
    rows = sums.where("pos1 = pos2").select("pos1", "n_pos").collect()  # one row a flag
    margin = {r["pos1"]: r["n_pos"] for r in rows}
    n = margin.get(-1, 0)
    order = sorted(range(len(flags)), key=lambda i: place(n, margin.get(i, 0), i))
    while True:
        head = sorted(order[:width])
        pairs = [(flags[i], flags[j], i, j, apart(n, margin.get(i, 0), margin.get(j, 0))) for x, i in enumerate(head) for j in head[x + 1:]]
        never = spark.createDataFrame(pairs, f"code1 string, code2 string, pos1 int, pos2 int, {metric} {kind}")
        never = never.join(sums.where("pos1 < pos2").select("pos1", "pos2"), ["pos1", "pos2"], "left_anti").select(*PAIR_KEYS, metric)
        best = _top(known.unionByName(never), metric, k).collect()
        if width >= len(flags):
            break
        later = apart(n, margin.get(order[0], 0), margin.get(order[width], 0))
        if len(best) == k and best[-1][metric] is not None and (later is None or best[-1][metric] > later):
            break
        width *= 2
    return spark.createDataFrame(best, f"code1 string, code2 string, pos1 int, pos2 int, {metric} {kind}")


def in_both_orders(pairs: DataFrame) -> DataFrame:
    """Each pair as (a, b) and (b, a) (trap K16)."""
    swap = {"code1": "code2", "code2": "code1", "pos1": "pos2", "pos2": "pos1"}
    return pairs.unionByName(pairs.select(*[F.col(swap.get(c, c)).alias(c) for c in pairs.columns]))


def top_correlations(sums: DataFrame, flags: Sequence[str], k: int = 20) -> DataFrame:
    """Top k rows of the correlation matrix unstacked, each pair in both orders."""
    return _top(in_both_orders(top_pairs(sums, flags, "correlation", k)), "correlation", k)


def combined_top(sums: DataFrame, flags: Sequence[str], k: int = 20) -> DataFrame:
    """Top-k pairs by correlation, co-occurrence and mutual information,
    deduplicated on (code1, code2), keeping the first method in that order."""
    parts = [(top_correlations(sums, flags, k), "correlation"),
             (top_pairs(sums, flags, "cooccurrence_count", k), "cooccurrence"),
             (top_pairs(sums, flags, "mutual_info", k), "mutual_info")]
    u = None
    for prio, (df, name) in enumerate(parts, 1):
        d = df.select("code1", "code2", F.lit(name).alias("method"), F.lit(prio).alias("_prio"))
        u = d if u is None else u.unionByName(d)
    return (u.groupBy("code1", "code2")
            .agg(F.min_by("method", "_prio").alias("method")))


def pair_table(counts: DataFrame) -> DataFrame:
    """2x2 table of pair presence against the class over all people."""
    return counts.select(*PAIR_KEYS, F.col("n11_pos").alias("tp"), F.col("n11_neg").alias("fp"),
                         (F.col("n_pos") - F.col("n11_pos")).alias("fn"),
                         (F.col("n_neg") - F.col("n11_neg")).alias("tn"))


def pair_statistics(table: DataFrame, p_values: bool = True) -> DataFrame:
    """X7 (+ X6 against the class, + X8 Fisher p)."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    ppv = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(zero)
    ppos = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(zero)
    pneg = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(zero)
    odds_pos = F.when(fn > 0, tp / fn).otherwise(F.lit(st.INF))
    odds_neg = F.when(tn > 0, fp / tn).otherwise(F.lit(st.INF))
    orv = F.when(odds_neg > 0, odds_pos / odds_neg).otherwise(F.lit(st.INF))
    n = tp + fp + fn + tn
    mi = st.mutual_info(n, tp + fp, tp + fn, tp)
    out = table.select("code1", "code2", "tp", "fp", "fn", "tn",
                       ppv.alias("PPV"), ppos.alias("prevalence_pos"), pneg.alias("prevalence_neg"),
                       (ppos - pneg).alias("prevalence_diff"), orv.alias("odds_ratio"),
                       mi.alias("mutual_info"))
    if p_values:
        out = out.withColumn("ln_p", st.fisher_ln_pvalue("tp", "fp", "fn", "tn")).withColumn("p_value", F.exp("ln_p"))
    return out


def select_pairs(stats: DataFrame, k: int = 20) -> DataFrame:
    """(p < 0.05, PPV >= 0.5, OR > 2) union the k smallest p, distinct.

    Ranked by ln p, so pairs whose p underflows keep their order.  The k
    smallest are found by one top-k, whose keys mark the rows to keep; the
    statistics are written first, so the p values are computed once."""
    stats = written(stats, "pair_stats")
    best = stats.orderBy(F.asc("ln_p"), "code1", "code2").limit(k).select("code1", "code2", F.lit(True).alias("_best"))
    good = (F.col("p_value") < 0.05) & (F.col("PPV") >= 0.5) & (F.col("odds_ratio") > 2)
    return stats.join(best, ["code1", "code2"], "left").where(F.col("_best") | good).drop("_best", "ln_p")
