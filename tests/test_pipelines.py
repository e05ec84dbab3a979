"""File-based pipelines (Q1, Q2, Q3, Q8) on small CSV fixtures with dirty values."""

from pyspark.sql import functions as F

from cohortlens import schemas as S
from cohortlens.plans import pipelines as pl


def _csv(path, header, rows):
    path.write_text(",".join(header) + "\n" + "\n".join(",".join(r) for r in rows) + "\n")
    return str(path)


def _inst_header(drg):
    h = ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT"] + (["CLM_DRG_CD"] if drg else [])
    h += ["ADMTNG_ICD9_DGNS_CD"] + [f"ICD9_DGNS_CD_{i}" for i in range(1, 11)]
    return h + [f"HCPCS_CD_{i}" for i in range(1, 46)]


def _inst_row(pid, clm, date, amt, icds, hcpcs=(), drg=True, adm=""):
    icd = list(icds) + [""] * (10 - len(icds))
    hc = list(hcpcs) + [""] * (45 - len(hcpcs))
    return [pid, clm, date, amt] + (["870"] if drg else []) + [adm] + icd + hc


def test_cohort_pipeline_from_files(spark, tmp_path):
    ben_h = ["DESYNPUF_ID", "BENE_BIRTH_DT", "BENE_SEX_IDENT_CD", "SP_STATE_CODE", "BENE_HI_CVRAGE_TOT_MONS",
             "BENE_ESRD_IND"] + S.CHRONIC_COLUMNS
    ben = _csv(tmp_path / "beneficiary.csv", ben_h, [
        ["P1", "19400101", "1", "05", "12", "Y"] + ["1"] * 3 + ["2"] * 8,
        ["P2", "19500615", "2", "10", "12", "N"] + ["2"] * 11,
        ["P3", "bad", "1", "05", "0", "N"] + ["2"] * 11,           # not covered
    ])
    inp = _csv(tmp_path / "inpatient.csv", _inst_header(True), [
        _inst_row("P1", "C1", "20090601.0", "500", ["0389", "4019"]),       # case, trailing '.0'
        _inst_row("P1", "C2", "20090520", "100", ["4019", " 2762 "]),       # in window, padded code
        _inst_row("P2", "C3", "20090301", "80", ["2762"]),
        _inst_row("P2", "C4", "2009-03-02", "80", ["2762"]),                # invalid date: dropped
    ])
    outp = _csv(tmp_path / "outpatient.csv", _inst_header(False), [
        _inst_row("P2", "C5", "20090215", "30", ["4019"], ["99213"], drg=False),
        _inst_row("P4", "C6", "20090215", "30", ["4019"], ["99213"], drg=False),  # no beneficiary row
    ])
    car_h = (["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT"] + [f"ICD9_DGNS_CD_{i}" for i in range(1, 9)]
             + [f"LINE_ICD9_DGNS_CD_{i}" for i in range(1, 14)] + [f"HCPCS_CD_{i}" for i in range(1, 14)]
             + [f"LINE_NCH_PMT_AMT_{i}" for i in range(1, 14)])
    car = _csv(tmp_path / "carrier.csv", car_h, [
        ["P1", "C7", "20090515", "4019"] + [""] * 7 + [""] * 13 + ["99214"] + [""] * 12 + ["10", "", "5.5"]
        + [""] * 10,
    ])
    out = pl.cohort_from_files(spark, ben, {"inpatient": inp, "outpatient": outp, "carrier": car},
                               str(tmp_path / "out"), icd_codes=["4019", "2762"], hcpcs_codes=["99214"],
                               pairs=[("4019", "2762")])
    rows = {r.person_id: r for r in out.collect()}
    assert set(rows) == {"P1", "P2"}
    p1 = rows["P1"]
    assert p1.case_ind == 1 and str(p1.index_date) == "2009-06-01"
    assert p1.inpatient_count_30d == 1 and p1.inpatient_amt_30d == 100.0
    assert p1.carrier_count_30d == 1 and p1.carrier_amt_30d == 15.5       # line amounts summed, NULL as 0
    assert p1.icd9_4019_30d == 1 and p1.icd9_2762_30d == 1 and p1.icd9_4019_and_2762_30d == 1
    assert p1.hcpcs_99214_30d == 1
    assert p1.age == 69 and p1.BENE_ESRD_IND == 1 and p1.chronic_condition_count == 3
    p2 = rows["P2"]
    assert p2.case_ind == 0 and str(p2.index_date) in ("2009-03-01", "2009-02-15")
    assert dict(out.dtypes)[S.LABEL] == "tinyint"


def test_summary_pipeline_from_files(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    _csv(d / "DE1_0_inpatient.csv", ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "CLM_DRG_CD",
                                      "ICD9_DGNS_CD_1"],
         [["ID1", "C1", "20090101", "100", "870", "250.00"], ["ID2", "C2", "20100101", "200", "871", ""]])
    _csv(d / "DE1_0_carrier.csv", ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "LINE_NCH_PMT_AMT_1", "HCPCS_CD_1",
                                    "ICD9_DGNS_CD_1"],
         [["ID1", "C5", "20090101", "75", "99214", "272.4"], ["ID2", "C6", "20090105", "25", "None", "None"]])
    merged = pl.summary_from_files(spark, str(d), 2009, 1, str(tmp_path / "claims_2009"))
    rows = merged.collect()
    assert {r.claim_id for r in rows} == {"C1", "C5"}
    assert merged.filter(F.col("primary_dx").isNull()).count() == 0
