"""Evaluation queries (M10-M15, T4) on labelled documents.

label = labels.quality; score = a length-based stand-in for a model
probability: least(floor(n_chars / 250), 40) / 40 (exact multiples of 1/40,
so ties occur and both engines compute identical doubles).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import evaluate as ev
from cohortlens.plans.registry import register
from cohortlens.sources import driver

THRESHOLD = 0.5
THRESHOLDS = ev.default_thresholds()
SCORED_SQL = """SELECT l.doc_id, l.quality AS label,
  CAST(least(floor(d.n_chars / 250), 40) AS DOUBLE) / 40.0 AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def scored(spark, sf_dir):
    lab = driver.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    doc = driver.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    s = (F.least(F.floor(F.col("n_chars") / 250), F.lit(40)).cast("double") / 40.0).alias("score")
    return lab.join(doc, "doc_id").select("doc_id", "label", s)


@register("M10_scores", f"""SELECT doc_id, label, score, CAST(score >= {THRESHOLD} AS INTEGER) AS prediction
FROM ({SCORED_SQL}) s""")
def m10_scores(spark, sf_dir):
    return ev.predict(scored(spark, sf_dir), THRESHOLD)


ST_SQL = f"""SELECT score, count(CASE WHEN label = 1 THEN 1 END) AS n_pos,
  count(CASE WHEN label = 0 THEN 1 END) AS n_neg FROM ({SCORED_SQL}) s GROUP BY score"""
CUM_SQL = f"""SELECT score, n_pos, n_neg,
  coalesce(sum(n_pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bp,
  coalesce(sum(n_neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bn
FROM ({ST_SQL}) t"""


@register("M11_auc", f"""SELECT sum(n_pos * (bn + n_neg / 2.0)) / (CAST(sum(n_pos) AS DOUBLE) * sum(n_neg)) AS roc_auc
FROM ({CUM_SQL}) c""")
def m11_auc(spark, sf_dir):
    return ev.auc(scored(spark, sf_dir))


@register("M12_roc", f"""WITH c AS ({CUM_SQL}),
t AS (SELECT CAST(sum(n_pos) AS DOUBLE) AS p, CAST(sum(n_neg) AS DOUBLE) AS n FROM ({ST_SQL}) x)
SELECT score AS threshold, (n - bn) / n AS fpr, (p - bp) / p AS tpr FROM c, t
UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""")
def m12_roc(spark, sf_dir):
    return ev.roc_curve(scored(spark, sf_dir))


CONF_SQL = f"""WITH s AS (SELECT label AS actual, CAST(score >= {THRESHOLD} AS INTEGER) AS predicted FROM ({SCORED_SQL}) x),
spine AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)),
c AS (SELECT actual, predicted, count(*) AS cnt FROM s GROUP BY ALL)
SELECT spine.actual, spine.predicted, coalesce(c.cnt, 0) AS count
FROM spine LEFT JOIN c ON spine.actual = c.actual AND spine.predicted = c.predicted"""


@register("M13_confusion", CONF_SQL)
def m13_confusion(spark, sf_dir):
    return ev.confusion(scored(spark, sf_dir), THRESHOLD)


@register("M14_report", f"""WITH m AS ({CONF_SQL}),
c AS (SELECT CAST(sum(CASE WHEN actual = 0 AND predicted = 0 THEN count END) AS DOUBLE) AS c00,
             CAST(sum(CASE WHEN actual = 0 AND predicted = 1 THEN count END) AS DOUBLE) AS c01,
             CAST(sum(CASE WHEN actual = 1 AND predicted = 0 THEN count END) AS DOUBLE) AS c10,
             CAST(sum(CASE WHEN actual = 1 AND predicted = 1 THEN count END) AS DOUBLE) AS c11 FROM m),
k AS (SELECT '0' AS class, c00 AS tp, c10 AS fp, c01 AS fn FROM c
      UNION ALL SELECT '1', c11, c01, c10 FROM c),
p AS (SELECT class, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, tp + fn AS support FROM k),
per AS (SELECT class, precision, recall,
               CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                 AS f1_score, support FROM p)
SELECT * FROM per
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1_score * support) / sum(support), sum(support) FROM per
UNION ALL SELECT 'accuracy', NULL, NULL,
  CASE WHEN c00 + c01 + c10 + c11 > 0 THEN (c00 + c11) / (c00 + c01 + c10 + c11) ELSE 0.0 END,
  c00 + c01 + c10 + c11 FROM c""")
def m14_report(spark, sf_dir):
    return ev.classification_report(ev.confusion(scored(spark, sf_dir), THRESHOLD))


_THR = " UNION ALL ".join(f"SELECT CAST('{t!r}' AS DOUBLE) AS threshold" for t in THRESHOLDS)
SWEEP_SQL = f"""WITH s AS ({SCORED_SQL}), t AS ({_THR}),
c AS (SELECT t.threshold,
             CAST(count(CASE WHEN s.score >= t.threshold AND s.label = 1 THEN 1 END) AS DOUBLE) AS tp,
             CAST(count(CASE WHEN s.score >= t.threshold AND s.label = 0 THEN 1 END) AS DOUBLE) AS fp,
             CAST(count(CASE WHEN s.label = 1 THEN 1 END) AS DOUBLE) AS pos
      FROM t, s GROUP BY t.threshold),
r AS (SELECT threshold, CASE WHEN pos > 0 THEN tp / pos ELSE 0.0 END AS recall,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision FROM c)
SELECT threshold, recall, precision,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM r"""


@register("M15_sweep", SWEEP_SQL)
def m15_sweep(spark, sf_dir):
    return ev.threshold_sweep(scored(spark, sf_dir), THRESHOLDS)


@register("T4_best_threshold", f"SELECT * FROM ({SWEEP_SQL}) w ORDER BY recall DESC, threshold LIMIT 1")
def t4_best_threshold(spark, sf_dir):
    return ev.best_threshold(ev.threshold_sweep(scored(spark, sf_dir), THRESHOLDS))


@register("T4_best_f1", f"SELECT * FROM ({SWEEP_SQL}) w ORDER BY f1 DESC, threshold LIMIT 1")
def t4_best_f1(spark, sf_dir):
    return ev.best_threshold(ev.threshold_sweep(scored(spark, sf_dir), THRESHOLDS), "f1")
