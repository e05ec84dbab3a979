"""Pair counts and evaluation metrics against brute force on small fixtures."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import enrich as en
from cohortlens.operators import evaluate as ev
from cohortlens.operators import pairs as pr
from cohortlens.operators import prepare as pp


def test_pair_counts_brute_force(spark):
    rnd = random.Random(7)
    flags = ["f0", "f1", "f2", "f3"]
    rows = [(i, rnd.randint(0, 1), *[rnd.randint(0, 1) for _ in flags]) for i in range(300)]
    df = spark.createDataFrame(rows, "pid int, case_ind int, " + ", ".join(f"{f} int" for f in flags))
    got = {(r.code1, r.code2): r for r in pr.pair_counts(df, flags).collect()}
    for (i, a), (j, b) in itertools.combinations(enumerate(flags), 2):
        for cls, suffix in ((1, "pos"), (0, "neg")):
            sub = [r for r in rows if r[1] == cls]
            r = got[(a, b)]
            assert getattr(r, f"n_{suffix}") == len(sub)
            assert getattr(r, f"n1_{suffix}") == sum(x[2 + i] for x in sub)
            assert getattr(r, f"n11_{suffix}") == sum(x[2 + i] * x[2 + j] for x in sub)


def test_correlation_matches_spark_corr(spark):
    rnd = random.Random(3)
    rows = [(1, rnd.randint(0, 1), rnd.randint(0, 1), 0) for _ in range(200)]
    df = spark.createDataFrame(rows, "case_ind int, a int, b int, c int")
    corr = {(r.code1, r.code2): r.correlation for r in pr.correlations(pr.pair_counts(df, ["a", "b", "c"])).collect()}
    assert corr[("a", "b")] == pytest.approx(df.stat.corr("a", "b"), rel=1e-9)
    assert corr[("b", "a")] == corr[("a", "b")]
    assert ("a", "c") not in corr  # never together


def _phi(n, a, b, c):
    den = (a * (n - a) * b * (n - b)) ** 0.5
    return (n * c - a * b) / den if den > 0 else None


def _mi(n, a, b, c):
    cells = [(c, a, b), (a - c, a, n - b), (b - c, n - a, b), (n - a - b + c, n - a, n - b)]
    return sum(x / n * math.log(n * x / (p * q)) for x, p, q in cells if x > 0)


@pytest.mark.parametrize("width", [2, 3, 64])
@pytest.mark.parametrize("k", [3, 10, 200])
def test_rankings_hold_pairs_never_together(spark, width, k):
    """f0 and f1 are each held by half the positives and never together: their mutual information is ln 2, the highest."""
    rnd = random.Random(2)
    rows = []
    for i in range(240):
        y, half = int(i % 3 > 0), i % 2
        rest = [int(rnd.random() < p) for p in (0.3, 0.2, 0.1, 0.05, 0.02)]
        rows.append((y, 1 - half, half, *rest, 0))
    flags = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame(rows, "case_ind int, " + ", ".join(f"{f} int" for f in flags))
    sums, pos = pr.pair_sums(df, flags), [r[1:] for r in rows if r[0] == 1]
    n, m = len(pos), [sum(c) for c in zip(*pos)]
    for metric, value in (("correlation", _phi), ("mutual_info", _mi), ("cooccurrence_count", lambda n, a, b, c: c)):
        every = []
        for i, j in itertools.combinations(range(8), 2):
            v = value(n, m[i], m[j], sum(r[i] * r[j] for r in pos))
            every.append((v is None, -round(v, 9) if v is not None else 0, i, j))
        got = [(r.pos1, r.pos2) for r in pr.top_pairs(sums, flags, metric, k, width).collect()]
        assert got == [(i, j) for _, _, i, j in sorted(every)[:k]], metric
    first = pr.top_pairs(sums, flags, "mutual_info", 1, width).first()
    assert (first.code1, first.code2) == ("f0", "f1") and first.mutual_info == pytest.approx(math.log(2))


def test_pair_sums_of_no_rows(spark):
    df = spark.createDataFrame([], "case_ind int, a int, b int")
    assert pr.pair_counts(df, ["a", "b"]).collect() == []
    assert [(r.pos1, r.pos2, r.mutual_info) for r in pr.top_pairs(pr.pair_sums(df, ["a", "b"]), ["a", "b"], "mutual_info", 5).collect()] == [(0, 1, None)]


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_and_roc_brute_force(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 20) / 20.0, rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = ev.auc(df, "score", "label").first().roc_auc
    assert got == pytest.approx(_brute_auc(rows), rel=1e-12)
    roc = {r.threshold: (r.fpr, r.tpr) for r in ev.roc_curve(df).collect()}
    npos = sum(y for _, y in rows)
    nneg = len(rows) - npos
    for t, (fpr, tpr) in roc.items():
        if t == float("inf"):
            assert (fpr, tpr) == (0.0, 0.0)
            continue
        assert tpr == pytest.approx(sum(1 for s, y in rows if y == 1 and s >= t) / npos)
        assert fpr == pytest.approx(sum(1 for s, y in rows if y == 0 and s >= t) / nneg)


def test_report_and_sweep(spark):
    rows = [(0.9, 1), (0.8, 0), (0.3, 1), (0.1, 0), (0.6, 1)]
    df = spark.createDataFrame(rows, "score double, label int")
    conf = {(r.actual, r.predicted): r["count"] for r in ev.confusion(df, 0.5).collect()}
    assert conf == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    rep = {r["class"]: r for r in ev.classification_report(ev.confusion(df, 0.5)).collect()}
    assert rep["1"].precision == pytest.approx(2 / 3) and rep["1"].recall == pytest.approx(2 / 3)
    assert rep["accuracy"].f1_score == pytest.approx(3 / 5) and rep["accuracy"].support == 5
    sweep = ev.threshold_sweep(df, ev.default_thresholds())
    assert sweep.count() == 9
    assert ev.best_threshold(sweep).first().threshold == pytest.approx(0.05)  # trap K12


def test_stratified_split_exact(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(500)]
    df = spark.createDataFrame(rows, "pid int, case_ind int")
    s = pp.stratified_split(df, "case_ind", "pid", 0.2, 42)
    counts = {(r.case_ind, r.is_test): r["count"] for r in s.groupBy("case_ind", "is_test").count().collect()}
    assert counts[(1, 1)] == 10 and counts[(0, 1)] == 90  # ceil(0.2 * 50), ceil(0.2 * 450)
    again = pp.stratified_split(df.repartition(7), "case_ind", "pid", 0.2, 42)
    a = {r.pid for r in s.filter(F.col("is_test") == 1).collect()}
    b = {r.pid for r in again.filter(F.col("is_test") == 1).collect()}
    assert a == b  # independent of partitioning


def test_melt_and_pivot(spark):
    from cohortlens.operators import enrich as en
    df = spark.createDataFrame([("P", 1, "A", "", "None"), ("Q", 0, "B", "A", None)],
                               "person_id string, case_ind int, s1 string, s2 string, s3 string")
    long = en.melt_slots(df, ["s1", "s2", "s3"])
    assert sorted((r.person_id, r.code) for r in long.collect()) == [("P", "A"), ("Q", "A"), ("Q", "B")]
    wide = {r.person_id: r for r in en.pivot_wide(long, ["A", "B", "C"]).collect()}
    assert (wide["P"].A, wide["P"].B, wide["P"].C) == (1, 0, 0) and (wide["Q"].A, wide["Q"].B) == (1, 1)


def test_summary_approx_close_to_exact(spark):
    from cohortlens.operators import profile as pf
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "x double")
    ex, ap = pf.numeric_summary(df, "x").first(), pf.numeric_summary(df, "x", approx=True).first()
    assert ex.q50 == 500.0 and abs(ap.q50 - 500.0) <= 1.0 and ex["count"] == ap["count"] == 1001


@pytest.mark.parametrize("value,twice", [("presence", 1), ("frequency", 2)])
def test_pivot_keeps_every_code(spark, value, twice):
    long = spark.createDataFrame([(1, 1, "A"), (1, 1, "250.00"), (1, 1, "250.00"), (2, 0, "Z`9"), (3, 0, None)],
                                 "person_id int, case_ind int, code string")
    wide = en.pivot_wide(long, value=value)
    assert wide.columns == ["person_id", "case_ind", "250.00", "A", "Z`9"]
    assert sorted(map(tuple, wide.collect())) == [(1, 1, twice, 1, 0), (2, 0, 0, 0, 1), (3, 0, 0, 0, 0)]
    assert en.code_levels(long, ["B", "A"]) == ["B", "A", "250.00", "Z`9"]
    assert en.pivot_wide(long.limit(0)).columns == ["person_id", "case_ind"]


def test_a13_queries_keep_codes_outside_the_list(spark, monkeypatch):
    from cohortlens.plans import params, q_enrich
    want = set(q_enrich.a13_pivot_presence(spark, "/root/testdata/sf0.001").columns)
    monkeypatch.setattr(params, "ICD_CODES", params.ICD_CODES[:3])
    got = q_enrich.a13_pivot_presence(spark, "/root/testdata/sf0.001").columns
    assert len(got) > 5 and set(got) <= want


def test_sparse_pivot_of_many_codes(spark):
    """50,000 codes: no column a code."""
    rows = spark.range(50_000).select((F.col("id") % 70).alias("person_id"), (F.col("id") % 2).cast("int").alias("case_ind"),
                                      F.format_string("c%05d", F.col("id")).alias("code"))
    rows = rows.unionByName(rows.where("person_id = 3")).unionByName(rows.limit(1).withColumn("code", F.lit(None).cast("string")))
    levels, sparse = en.pivot_sparse(rows)
    assert levels.count() == 50_000 and levels.where("code <> format_string('c%05d', level)").count() == 0
    got = {r.person_id: r for r in sparse.collect()}
    assert len(got) == 70 and {r["size"] for r in got.values()} == {50_000}
    assert got[3].indices == list(range(3, 50_000, 70)) and set(got[3]["values"]) == {2}
    assert got[4].indices == list(range(4, 50_000, 70)) and set(got[4]["values"]) == {1}
    assert en.pivot_sparse(rows.limit(0))[1].collect() == []
