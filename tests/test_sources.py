"""Sources and sinks (S1-S7): the reference's ingestion tests and round trips."""

import pytest

from cohortlens.sources import files


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_load_file(spark, tmp_path):
    p = _write(tmp_path / "test_inpatient.csv",
               "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,ICD9_DGNS_CD_1\n"
               "ID1,CLM1,2008-01-01,100.0,250.00\nID2,CLM2,2008-01-02,200.0,401.9\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("CLM_PMT_AMT", T.DoubleType())])
    df = files.load_file(spark, p, ["DESYNPUF_ID", "CLM_ID"], schema=schema)
    assert df.count() == 2
    assert dict(df.dtypes)["CLM_PMT_AMT"] == "double"


def test_load_file_missing_columns(spark, tmp_path):
    p = _write(tmp_path / "x.csv", "DESYNPUF_ID,CLM_ID\nA,B\n")
    with pytest.raises(ValueError, match="Missing required columns"):
        files.load_file(spark, p, ["DESYNPUF_ID", "CLM_FROM_DT"])


def test_load_file_not_found(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_file(spark, str(tmp_path / "nope.csv"))


def test_load_all(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    # lacks CLM_DRG_CD, so it is skipped as inpatient (as in the reference)
    _write(d / "test_inpatient.csv", "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,ICD9_DGNS_CD_1\nA,B,20090101,1,x\n")
    _write(d / "sample_outpatient_1.csv",
           "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,HCPCS_CD_1,ICD9_DGNS_CD_1\nA,C1,20090101,5.5,h,x\n")
    _write(d / "sample_outpatient_2.csv",
           "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,HCPCS_CD_1,ICD9_DGNS_CD_1\nB,C2,20090102,1.5,h,y\n")
    out = files.load_all(spark, str(d))
    assert "inpatient" not in out and "beneficiary" not in out
    assert out["outpatient"].count() == 2  # several files of one type are unioned (trap K1)
    assert dict(out["outpatient"].dtypes)["CLM_PMT_AMT"] == "double"


def test_load_all_no_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_all(spark, str(tmp_path))


def test_lookup_and_sinks(spark, tmp_path):
    p = _write(tmp_path / "dx.tsv", "ICD9_CD\tICD9_DESC_LONG\n0389\tInfection NOS\n4019\tHypertension NOS\n")
    lk = files.load_lookup(spark, p)
    assert lk.columns == ["code", "description"] and lk.count() == 2
    out = files.write_table(lk, str(tmp_path / "out_csv"), fmt="csv", single_file=True)
    back = files.load_processed(spark, out, "code string, description string")
    assert sorted(r.code for r in back.collect()) == ["0389", "4019"]
    pq = files.write_table(lk, str(tmp_path / "out_pq"))
    assert files.load_processed(spark, pq, "code string, description string", fmt="parquet").count() == 2


def test_fixed_width(spark, tmp_path):
    p = _write(tmp_path / "fw.txt", "0389 Infection NOS    \n4019 Hypertension NOS\n")
    df = files.load_fixed_width(spark, p, [("code", 1, 4), ("description", 6, 17)])
    assert sorted((r.code, r.description) for r in df.collect()) == [("0389", "Infection NOS"),
                                                                    ("4019", "Hypertension NOS")]


def test_columns_are_bound_by_name(spark, tmp_path):
    """Extra columns, reversed order, two headers of one type."""
    d = tmp_path / "raw"
    d.mkdir()
    _write(d / "a_outpatient.csv", "X,ICD9_DGNS_CD_1,HCPCS_CD_1,CLM_PMT_AMT,CLM_FROM_DT,CLM_ID,DESYNPUF_ID\n"
           "9,i1,h1,5.5,20090101,C1,A\n")
    _write(d / "b_outpatient.csv", "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,HCPCS_CD_1,ICD9_DGNS_CD_1\nB,C2,20090102,1.5,h2,i2\n")
    out = files.load_all(spark, str(d))["outpatient"]
    got = {r.CLM_ID: (r.DESYNPUF_ID, r.CLM_PMT_AMT, r.HCPCS_CD_1, r.ICD9_DGNS_CD_1, r.X) for r in out.collect()}
    assert got == {"C1": ("A", 5.5, "h1", "i1", "9"), "C2": ("B", 1.5, "h2", "i2", None)}
    typed = files.load_typed(spark, str(d / "a_outpatient.csv"), "outpatient", ["CLM_ID", "CLM_PMT_AMT", "HCPCS_CD_2"])
    assert [tuple(r) for r in typed.collect()] == [("C1", 5.5, None)]
    p = _write(tmp_path / "swapped.tsv", "ICD9_DESC_LONG\tOTHER\tICD9_CD\nInfection NOS\tz\t0389\n")
    assert [tuple(r) for r in files.load_lookup(spark, p).collect()] == [("0389", "Infection NOS")]
    back = files.load_processed(spark, _write(tmp_path / "st.csv", "b,a\n2009-01-02,1\n"), "a int, b string", ["b"])
    assert [(r.a, str(r.b)) for r in back.collect()] == [(1, "2009-01-02")]


def test_ragged_file_is_skipped(spark, tmp_path):
    head = "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,HCPCS_CD_1,ICD9_DGNS_CD_1\n"
    _write(tmp_path / "a_outpatient.csv", head + "A,C1,20090101,5.5,h,x\nA,C9,20090101,5.5,h,x,too,many\n")
    _write(tmp_path / "b_outpatient.csv", head + "B,C2,20090102,1.5,h,y\n")
    assert [r.CLM_ID for r in files.load_all(spark, str(tmp_path))["outpatient"].collect()] == ["C2"]


def test_bad_value_and_missing_column_are_skipped(spark, tmp_path):
    """A value of another type, a ragged row, a missing column: each such file is left out whole, with one scan a file."""
    head = "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,HCPCS_CD_1,ICD9_DGNS_CD_1\n"
    _write(tmp_path / "a_outpatient.csv", head + "A,C1,20090101,5.5,h,x\nA,C2,20090101,lots,h,x\n")
    _write(tmp_path / "b_outpatient.csv", head + "B,C3,20090102,1.5,h,y\nB,C4,20090102\n")
    _write(tmp_path / "c_outpatient.csv", "DESYNPUF_ID,CLM_ID\nC,C5\n")
    _write(tmp_path / "d_outpatient.csv", head + "D,C6,20090102,,h,y\n")
    folder = tmp_path / "e_outpatient.csv"  # a folder of data files, as Spark writes them
    folder.mkdir()
    _write(folder / "part-0.csv", head + "E,C7,20090102,2,h,y\n")
    _write(folder / "_SUCCESS", "")
    out = files.load_all(spark, str(tmp_path))["outpatient"]
    assert sorted((r.CLM_ID, r.CLM_PMT_AMT) for r in out.collect()) == [("C3", 1.5), ("C4", None), ("C6", None), ("C7", 2.0)]
    assert "FileScan csv" not in out._jdf.queryExecution().executedPlan().toString()
    rows = files._checked(spark, [str(tmp_path / "a_outpatient.csv")], None)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_counts_come_with_the_load(spark, tmp_path):
    from cohortlens.operators import profile as pf
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    table, seen = pf.written_with_nulls(df, "t")
    assert seen == {"rows": 3, "a": 1, "b": 2} and table.count() == 3
