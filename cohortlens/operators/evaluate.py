"""Classifier evaluation on (score, label) rows.

ROC and AUC need running sums in score order.  A window ordered over the
whole table would put every row in one task, so the running sums are
computed over the distinct-score table in range-partitioned slices: slice
totals (one row per slice) give each slice's offset, and a window inside
each slice finishes the sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir

SCORE, LABEL = "score", "label"


def predict(df: DataFrame, threshold: float, score: str = SCORE) -> DataFrame:
    """Predicted label = score >= threshold."""
    return df.withColumn("prediction", (F.col(score) >= F.lit(threshold)).cast("int"))


def score_table(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation)."""
    return (df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias(SCORE))
            .agg(F.count(F.when(F.col(label) == 1, True)).alias("n_pos"),
                 F.count(F.when(F.col(label) == 0, True)).alias("n_neg")))


def cumulative_before(ds: DataFrame, order_col: str, cols: Sequence[str], slices: int | None = None) -> DataFrame:
    """Adds ``before_<c>``: the sum of ``c`` over rows with a smaller
    ``order_col`` (``order_col`` must be unique, e.g. a distinct-score table).

    The table is range-partitioned on ``order_col`` and checkpointed to the
    session's checkpoint folder, so slice ids are fixed even if a task is
    re-run; slice totals are a table of ``slices`` rows (bounded by the
    parameter) whose prefix sums are joined back by slice id.
    """
    spark = ds.sparkSession
    checkpoint_dir(spark)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = (ds.repartitionByRange(n, order_col)
              .withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True))
    totals = sliced.groupBy("_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    prior = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", *[F.coalesce(F.sum(f"_t_{c}").over(prior), F.lit(0)).alias(f"_o_{c}")
                                        for c in cols])
    inside = Window.partitionBy("_slice").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.join(F.broadcast(offsets), "_slice")
    for c in cols:
        out = out.withColumn(f"before_{c}", (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
                             .cast("long"))
    return out.drop("_slice", *[f"_o_{c}" for c in cols])


def auc(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """ROC-AUC by rank sums with mid-ranks for ties:
    sum over scores of n_pos * (negatives below + n_neg / 2) / (P * N)."""
    ds = cumulative_before(score_table(df, score, label), SCORE, ["n_neg"])
    contrib = F.col("n_pos") * (F.col("before_n_neg") + F.col("n_neg") / 2.0)
    return ds.agg(F.try_divide(F.sum(contrib), F.sum("n_pos").cast("double") * F.sum("n_neg"))
                  .alias("roc_auc"))


def roc_curve(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the (0, 0)
    start point at threshold +inf.  Collinear points are kept."""
    ds = cumulative_before(score_table(df, score, label), SCORE, ["n_pos", "n_neg"])
    p_tot, n_tot = (ds.agg(F.sum(c).cast("double")).scalar() for c in ("n_pos", "n_neg"))  # of the checkpointed table
    # at threshold s the positives predicted are those with score >= s
    tp = p_tot - F.col("before_n_pos")
    fp = n_tot - F.col("before_n_neg")
    pts = ds.select(F.col(SCORE).cast("double").alias("threshold"),
                    F.try_divide(fp, n_tot).alias("fpr"), F.try_divide(tp, p_tot).alias("tpr"))
    start = ds.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                            F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def confusion(df: DataFrame, threshold: float, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """Counts per (actual, predicted) on the full 2x2 spine."""
    spine = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted")) for a in (0, 1) for p in (0, 1)]))
        .alias("c")).select("c.*")
    counts = (predict(df, threshold, score).groupBy(F.col(label).alias("actual"), F.col("prediction").alias("predicted"))
              .agg(F.count("*").alias("count")))
    return spine.join(counts, ["actual", "predicted"], "left").fillna(0, ["count"])


def classification_report(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1, support per class, accuracy, macro and
    weighted averages (0 where a denominator is 0)."""
    def cell(a, p):
        return F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("count"))).cast("double")

    z = F.lit(0.0)

    def ratio(x, y):
        return F.when(y > 0, x / y).otherwise(z)

    c = conf.agg(cell(0, 0).alias("c00"), cell(0, 1).alias("c01"), cell(1, 0).alias("c10"),
                 cell(1, 1).alias("c11"))
    rows = []
    for k, (tp, fp, fn) in {0: ("c00", "c10", "c01"), 1: ("c11", "c01", "c10")}.items():
        tp_, fp_, fn_ = F.col(tp), F.col(fp), F.col(fn)
        prec, rec = ratio(tp_, tp_ + fp_), ratio(tp_, tp_ + fn_)
        rows.append((str(k), prec, rec, ratio(2 * prec * rec, prec + rec), tp_ + fn_))
    total = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    structs = [F.struct(F.lit(n).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                        s.alias("support")) for n, p, r, f, s in rows]
    per = c.select(F.inline(F.array(*structs)))
    agg = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    acc = c.select(ratio(F.col("c00") + F.col("c11"), total).alias("acc"), total.alias("n"))
    summary = agg.select(F.inline(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support")))))
    accuracy = acc.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                          F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1_score"),
                          F.col("n").alias("support"))
    return per.unionByName(summary).unionByName(accuracy)


def default_thresholds(start: float = 0.05, stop: float = 0.5, step: float = 0.05) -> list[float]:
    """start, start + step, ... below stop, computed as start + i * step."""
    out, i = [], 0
    while start + i * step < stop - 1e-12:
        out.append(start + i * step)
        i += 1
    return out


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], score: str = SCORE,
                    label: str = LABEL) -> DataFrame:
    """Recall, precision and F1 at each threshold (one conditional
    aggregate, then one row per threshold)."""
    aggs = [F.count(F.when(F.col(label) == 1, True)).alias("pos")]
    for k, t in enumerate(thresholds):
        hit = F.col(score) >= F.lit(t)
        aggs.append(F.count(F.when(hit & (F.col(label) == 1), True)).alias(f"tp{k}"))
        aggs.append(F.count(F.when(hit & (F.col(label) == 0), True)).alias(f"fp{k}"))
    one = df.agg(*aggs)
    rows = one.select("pos", F.inline(F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp{k}").alias("tp"), F.col(f"fp{k}").alias("fp"))
        for k, t in enumerate(thresholds)])))
    tp, fp, pos = (F.col(c).cast("double") for c in ("tp", "fp", "pos"))
    rec = F.when(pos > 0, tp / pos).otherwise(F.lit(0.0))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    return rows.select("threshold", rec.alias("recall"), prec.alias("precision"),
                       F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"))


def best_threshold(sweep: DataFrame, metric: str = "recall") -> DataFrame:
    """T4: the first threshold with the largest metric (trap K12)."""
    return sweep.orderBy(F.desc(metric), F.asc("threshold")).limit(1)
