"""The reference's preprocessing tests, re-expressed on Spark."""

import os

from pyspark.sql import functions as F

from cohortlens.operators import clean as cn
from cohortlens.operators import summary as sm


def test_convert_types_inpatient(spark):
    df = spark.createDataFrame([("ID1", "CLM1", "20090101", "100.0", "250.00", "870"),
                                ("ID2", "CLM2", "2009-13-45", "x", None, "871")],
                               "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_PMT_AMT string, "
                               "ICD9_DGNS_CD_1 string, CLM_DRG_CD string")
    out = cn.convert_types(df, "inpatient")
    types = dict(out.dtypes)
    assert types["CLM_FROM_DT"] == "date" and types["CLM_PMT_AMT"] == "double"
    assert types["DESYNPUF_ID"] == "string" and types["CLM_DRG_CD"] == "string"
    rows = out.orderBy("CLM_ID").collect()
    assert str(rows[0].CLM_FROM_DT) == "2009-01-01" and rows[0].CLM_PMT_AMT == 100.0
    assert rows[1].CLM_FROM_DT is None and rows[1].CLM_PMT_AMT is None  # bad values become NULL


def test_convert_types_outpatient(claim_frames):
    types = dict(claim_frames["outpatient"].dtypes)
    assert types["CLM_FROM_DT"] == "date" and types["CLM_PMT_AMT"] == "double"
    assert types["HCPCS_CD_1"] == "string"


def test_convert_types_errors(spark):
    import pytest
    df = spark.createDataFrame([("a",)], "DESYNPUF_ID string")
    with pytest.raises(ValueError, match="Invalid file_type"):
        cn.convert_types(df, "pharmacy")
    with pytest.raises(ValueError, match="Missing columns"):
        cn.convert_types(df, "inpatient")


def test_missing_data_inpatient(claim_frames):
    rows = claim_frames["inpatient"].orderBy("CLM_ID").collect()
    assert len(rows) == 2
    assert rows[1].ICD9_DGNS_CD_1 == "Unknown"
    assert rows[1].CLM_DRG_CD == "871"


def test_missing_data_outpatient_and_none_text(spark, claim_frames):
    rows = claim_frames["outpatient"].orderBy("CLM_ID").collect()
    assert len(rows) == 2
    assert rows[1].ICD9_DGNS_CD_1 == "Unknown" and rows[1].HCPCS_CD_1 == "Unknown"
    df = spark.createDataFrame([("ID9", "C9", "20090101", 1.0, "None", " 99 ")],
                               "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_PMT_AMT double, "
                               "ICD9_DGNS_CD_1 string, HCPCS_CD_1 string")
    r = cn.handle_missing(cn.convert_types(df, "outpatient"), "outpatient").first()
    assert r.ICD9_DGNS_CD_1 == "Unknown"


def test_missing_keys_dropped(spark):
    df = spark.createDataFrame([(None, "C1", "20090101", 1.0, "x", "y"), ("P", "C2", "20090101", None, "x", "y")],
                               "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_PMT_AMT double, "
                               "ICD9_DGNS_CD_1 string, HCPCS_CD_1 string")
    assert cn.handle_missing(cn.convert_types(df, "outpatient"), "outpatient").count() == 0


def test_filter_year_2009(claim_frames):
    f = sm.filter_year(claim_frames, 2009)
    assert f["inpatient"].count() == 1
    assert [r.DESYNPUF_ID for r in f["outpatient"].collect()] == ["ID1"]
    assert [r.DESYNPUF_ID for r in f["carrier"].collect()] == ["ID1"]
    assert f["beneficiary"].count() == 2  # not a claim type


def test_filter_year_2010(claim_frames):
    f = sm.filter_year(claim_frames, 2010)
    assert [r.DESYNPUF_ID for r in f["carrier"].collect()] == ["ID2"]
    assert f["outpatient"].count() == 0  # kept as an empty frame (trap K3)


def test_top_n(claim_frames):
    stacked = sm.stack_claims(sm.filter_year(claim_frames, 2009))
    top = sm.top_persons(stacked, 1).collect()
    assert [(r.person_id, r.total_payment) for r in top] == [("ID1", 225.0)]


def test_top_n_ties_by_key(spark):
    df = spark.createDataFrame([("B", 10.0), ("A", 10.0), ("C", 5.0)], "person_id string, claim_amt double")
    assert [r.person_id for r in sm.top_persons(df, 2).collect()] == ["A", "B"]


def test_no_frames_raises(spark):
    import pytest
    with pytest.raises(ValueError, match="No valid claims"):
        sm.stack_claims({})


def test_merge_claims(claim_frames, tmp_path):
    stacked = sm.stack_claims(sm.filter_year(claim_frames, 2009))
    out = str(tmp_path / "processed" / "claims_2009")
    merged = sm.summary_pipeline(stacked, 2009, n=1, output_path=out, fmt="csv")
    rows = merged.collect()
    assert len(rows) == 3
    assert {r.file_type for r in rows} == {"inpatient", "outpatient", "carrier"}
    assert all(r.claim_amt is not None and r.primary_dx is not None for r in rows)
    assert os.path.exists(out)
    assert sorted(merged.columns) == sorted(["person_id", "claim_id", "claim_date", "claim_amt", "primary_dx",
                                             "prcdr_drg_cd", "file_type"])


def test_semi_join_plans_broadcast(claim_frames):
    stacked = sm.stack_claims(sm.filter_year(claim_frames, 2009))
    merged = sm.merge_claims(stacked, sm.top_persons(stacked, 1))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    assert merged.filter(F.col("person_id") != "ID1").count() == 0
