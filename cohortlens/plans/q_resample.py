"""Resampling queries (M5, M6) over the scaled training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.operators import neighbours as nb
from cohortlens.operators import resample as rs
from cohortlens.plans import params as P
from cohortlens.plans import q_model as qm
from cohortlens.plans.registry import register

K_SMOTE, K_ENN = 5, 3  # the resampling library's defaults


def training_rows(spark, sf_dir):
    data = qm.prepared(spark, sf_dir)
    return data.where(F.col("is_test") == 0), qm.feature_columns(data)


def oversampled(spark, sf_dir):
    train, features = training_rows(spark, sf_dir)
    return rs.oversample(train, features, S.LABEL, S.PERSON, K_SMOTE, P.SEED), features


_ALL = [f.rsplit(" AS ", 1)[1] for f in qm._dummies] + qm.TYPE_COLS + qm.FLAG_COLS


def _draw(text: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {text})), 1, 15))::BIGINT"


def _vector(cols, prefix="") -> str:
    return "[" + ", ".join(f"floor({prefix}{c} * {nb.GRID} + 0.5)" for c in cols) + "]"


_D2 = "list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2 * list_dot_product(a.v, b.v)"
_scaled = [x.replace("round(", "(").replace(", 6) AS", ") AS") for x in qm._scaled_sql]
_NEW = ", ".join(f"b.{c} + g.gap * (n.{c} - b.{c}) AS {c}" for c in _ALL)
OVERSAMPLE_SQL = f"""
WITH s AS MATERIALIZED ({qm.SPLIT_SQL}),
tr AS MATERIALIZED (SELECT person_id, case_ind, {', '.join(f'CAST(({d.rsplit(" AS ", 1)[0]}) AS DOUBLE) AS {d.rsplit(" AS ", 1)[1]}' for d in qm._dummies)},
  {', '.join(_scaled)}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in qm.FLAG_COLS)} FROM s WHERE is_test = 0),
sz AS (SELECT case_ind, count(*) AS n FROM tr GROUP BY case_ind),
sm AS (SELECT (SELECT case_ind FROM sz ORDER BY n, case_ind DESC LIMIT 1) AS small, (SELECT min(n) FROM sz) AS n,
              (SELECT max(n) - min(n) FROM sz) AS new, (SELECT max(person_id) + 1 FROM tr) AS top),
few AS MATERIALIZED (SELECT tr.*, {_vector(_ALL)} AS v FROM tr, sm WHERE case_ind = small),
nn AS MATERIALIZED (SELECT id, list(nid ORDER BY d2, nid) AS near FROM
  (SELECT a.person_id AS id, b.person_id AS nid, {_D2} AS d2,
          row_number() OVER (PARTITION BY a.person_id ORDER BY {_D2}, b.person_id) AS rn
   FROM few a JOIN few b ON a.person_id <> b.person_id) WHERE rn <= {K_SMOTE} GROUP BY id),
rk AS (SELECT person_id, new // n + CASE WHEN row_number() OVER (ORDER BY {_draw(f"person_id, '{P.SEED}'")}, person_id) - 1 < new % n
              THEN 1 ELSE 0 END AS copies FROM few, sm),
cp AS (SELECT person_id, unnest(range(1, copies + 1)) AS copy FROM rk),
g AS (SELECT cp.person_id, cp.copy, near[{_draw(f"cp.person_id, copy, '{P.SEED}'")} % len(near) + 1] AS neighbour,
             ({_draw(f"cp.person_id, copy, '{P.SEED + 1}'")} % {rs.STEPS}) / {rs.STEPS}.0 AS gap
      FROM cp JOIN nn ON cp.person_id = nn.id)
SELECT person_id AS row_id, person_id, 0 AS copy, CAST(NULL AS BIGINT) AS neighbour, CAST(NULL AS DOUBLE) AS gap, case_ind, {', '.join(_ALL)} FROM tr
UNION ALL
SELECT sm.top * g.copy + g.person_id, g.person_id, CAST(g.copy AS INTEGER), g.neighbour, g.gap, b.case_ind, {_NEW}
FROM g JOIN few b ON b.person_id = g.person_id JOIN few n ON n.person_id = g.neighbour, sm"""
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in _ALL)


@register("M5_oversample", f"SELECT * REPLACE ({_ROUNDED}) FROM ({OVERSAMPLE_SQL}) o")
def m5_oversample(spark, sf_dir):
    """Training rows and the interpolated rows of the smaller class."""
    out, features = oversampled(spark, sf_dir)
    return out.select("row_id", S.PERSON, "copy", "neighbour", "gap", S.LABEL, *[F.round(c, 6).alias(c) for c in features])


CLEAN_SQL = f"""
WITH o AS MATERIALIZED (SELECT row_id, person_id, copy, case_ind, {_vector(_ALL)} AS v FROM ({OVERSAMPLE_SQL}) x),
nn AS (SELECT a.row_id, b.case_ind = a.case_ind AS agrees,
              row_number() OVER (PARTITION BY a.row_id ORDER BY {_D2}, b.row_id) AS rn
       FROM o a JOIN o b ON a.row_id <> b.row_id)
SELECT row_id, person_id, copy, case_ind FROM o
WHERE row_id IN (SELECT row_id FROM nn WHERE rn <= {K_ENN} GROUP BY row_id HAVING bool_and(agrees))"""


@register("M6_clean", CLEAN_SQL)
def m6_clean(spark, sf_dir):
    """Rows of the over-sampled training set whose three nearest rows all share their label."""
    out, features = oversampled(spark, sf_dir)
    return rs.clean(out, features, S.LABEL, "row_id", K_ENN).select("row_id", S.PERSON, "copy", S.LABEL)
