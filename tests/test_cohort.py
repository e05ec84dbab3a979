"""Cohort, lookback and feature edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.operators import cohort as co
from cohortlens.operators import dashboard as db
from cohortlens.operators import features as fe

D = dt.date


def _claims(spark, rows):
    return spark.createDataFrame(rows, "person_id string, claim_id string, claim_date date, claim_amt double, "
                                       "file_type string, icd_codes array<string>, hcpcs_codes array<string>")


def test_lookback_edges(spark):
    idx = spark.createDataFrame([("P", 1, D(2009, 3, 31))], "person_id string, case_ind int, index_date date")
    claims = _claims(spark, [
        ("P", "a", D(2009, 3, 1), 10.0, "inpatient", ["X"], []),    # exactly 30 days before: in
        ("P", "b", D(2009, 2, 28), 20.0, "inpatient", ["Y"], []),   # 31 days before: out
        ("P", "c", D(2009, 3, 31), 30.0, "carrier", ["Z"], []),     # on the index date: out
        ("Q", "d", D(2009, 3, 30), 40.0, "carrier", ["X"], []),     # other person: out
    ])
    got = [r.claim_id for r in fe.lookback(idx, claims, 30).collect()]
    assert got == ["a"]


def test_features_zero_fill_and_pairs(spark):
    idx = spark.createDataFrame([("P", 1, D(2009, 6, 1)), ("Q", 0, D(2009, 6, 1)), ("R", 0, D(2009, 6, 1))],
                                "person_id string, case_ind int, index_date date")
    claims = _claims(spark, [
        ("P", "1", D(2009, 5, 20), 10.0, "inpatient", ["A", "B"], ["H"]),  # A and B on one claim
        ("Q", "2", D(2009, 5, 20), 5.0, "carrier", ["A"], []),              # A and B on two claims
        ("Q", "3", D(2009, 5, 21), 7.5, "carrier", ["B"], []),
    ])
    demo = spark.createDataFrame([("P", "1"), ("Q", "2")], "person_id string, sex string")
    out = {r.person_id: r for r in fe.engineer_features(idx, claims, demo, 30, ["A", "B"], ["H"], [("A", "B")])
           .collect()}
    assert out["P"].icd9_A_and_B_30d == 1 and out["Q"].icd9_A_and_B_30d == 0  # same-claim only (trap K9)
    assert out["Q"].carrier_count_30d == 2 and out["Q"].carrier_amt_30d == 12.5
    assert out["P"].hcpcs_H_30d == 1
    r = out["R"]  # no claims in the window: zero row, no demographics
    assert r.inpatient_count_30d == 0 and r.inpatient_amt_30d == 0.0 and r.icd9_A_30d == 0 and r.sex is None


def test_cases_and_index_dates(spark):
    claims = _claims(spark, [
        ("P", "1", D(2009, 2, 1), 1.0, "inpatient", ["0389"], []),
        ("P", "2", D(2009, 5, 1), 1.0, "inpatient", ["0389", "x"], []),
        ("P", "3", D(2008, 12, 20), 1.0, "inpatient", ["0389"], []),  # not the case year
        ("Q", "4", D(2009, 7, 1), 1.0, "outpatient", ["x"], []),
        ("Q", "5", D(2009, 8, 1), 1.0, "carrier", ["y"], []),
        ("U", "6", D(2009, 7, 1), 1.0, "carrier", ["y"], []),          # not covered
        ("V", "7", D(2009, 12, 28), 1.0, "carrier", ["y"], []),        # only after the control window
    ])
    cases = co.find_cases(claims, "0389", 2009)
    assert [(r.person_id, str(r.latest_case_date)) for r in cases.collect()] == [("P", "2009-05-01")]
    persons = spark.createDataFrame([("Q",), ("V",)], "person_id string")
    idx = {r.person_id: r for r in co.assign_index_dates(cases, claims, persons, 2009, "2009-01-01",
                                                          "2009-12-25").collect()}
    assert set(idx) == {"P", "Q"}  # a case need not be covered (trap K7)
    assert idx["P"].case_ind == 1 and idx["Q"].case_ind == 0
    assert str(idx["Q"].index_date) in ("2009-07-01", "2009-08-01")
    again = co.assign_index_dates(cases, claims.repartition(3), persons, 2009, "2009-01-01", "2009-12-25")
    assert {r.person_id: r.index_date for r in again.collect()}["Q"] == idx["Q"].index_date  # seeded


def test_week_53_and_spine(spark):
    claims = _claims(spark, [("P", "1", D(2009, 12, 29), 5.0, "carrier", [], []),
                             ("P", "2", D(2009, 1, 5), 3.0, "inpatient", [], [])])
    s52 = db.period_series(claims, "week", 2009, max_week=52)
    assert s52.count() == 52 * 3 and s52.agg(F.sum(S.AMOUNT)).first()[0] == 3.0  # week 53 not shown (K5)
    s53 = db.period_series(claims, "week", 2009)  # complete by default
    assert s53.filter((F.col("week") == 53) & (F.col(S.FILE_TYPE) == "carrier")).first()[S.AMOUNT] == 5.0
    months = db.period_series(claims, "month", 2009)
    assert months.count() == 36 and months.filter(F.col("month") == "2009-12").agg(F.sum(S.AMOUNT)).first()[0] == 5.0


def test_lookup_leading_zeros_collide(spark):
    lk = spark.createDataFrame([("0389", "b desc"), ("389", "a desc"), ("4019", "hyp")], "code string, description string")
    agg = spark.createDataFrame([("389", 10.0), ("999", 1.0)], "primary_dx string, total_payment double")
    got = {r.primary_dx: r.description for r in db.describe(agg, lk).collect()}
    assert got == {"389": "a desc", "999": "999"}  # one row per code (K6), code fallback (J7)


def test_pair_presence_per_person_vs_per_claim(spark):
    """A9 needs both codes on one claim; A20 needs both on the person (trap K9)."""
    from cohortlens.operators import pairs as pr
    idx = spark.createDataFrame([("Q", 1, D(2009, 6, 1)), ("Z", 0, D(2009, 6, 1))],
                                "person_id string, case_ind int, index_date date")
    claims = _claims(spark, [("Q", "2", D(2009, 5, 20), 5.0, "carrier", ["A"], []),
                             ("Q", "3", D(2009, 5, 21), 7.5, "carrier", ["B"], []),
                             ("Z", "4", D(2009, 5, 21), 7.5, "carrier", ["A"], [])])
    f = fe.engineer_features(idx, claims, None, 30, ["A", "B"], pairs=[("A", "B")])
    assert f.filter(F.col("person_id") == "Q").first().icd9_A_and_B_30d == 0
    t = pr.pair_table(pr.pair_counts(f, ["icd9_A_30d", "icd9_B_30d"])).first()
    assert (t.tp, t.fp, t.fn, t.tn) == (1, 0, 0, 1)


def test_enrichment_with_an_empty_class(spark):
    from cohortlens.operators import enrich as en
    long = spark.createDataFrame([("P", 0, "A"), ("Q", 0, "B")], "person_id string, case_ind int, code string")
    means = {r.code: r for r in en.class_means(long).collect()}
    assert means["A"].prev_pos is None and means["A"].prev_neg == 0.5  # no positives: NULL, not an error
    window = spark.createDataFrame([("P", 0), ("Q", 0)], "person_id string, case_ind int")
    st = {r.code: r for r in en.code_statistics(en.contingency(window, long), p_values=False).collect()}
    assert st["A"].prevalence_positive == 0.0 and st["A"].chi2 is None
