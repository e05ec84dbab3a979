import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortlens.session import build_session
    # Tests run on one machine, so a local folder may stand for the shared one.
    folder = tempfile.mkdtemp(prefix="cohortlens-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="cohortlens-tests",
                      extra={"spark.checkpoint.dir": f"file://{folder}"})
    yield s
    s.stop()


@pytest.fixture()
def claim_frames(spark):
    """The reference's unit-test frames (beneficiary, inpatient, outpatient, carrier)."""
    from cohortlens.operators import clean as cn
    ben = spark.createDataFrame([("ID1", "19500101", "1"), ("ID2", "19600101", "2")],
                                "DESYNPUF_ID string, BENE_BIRTH_DT string, BENE_SEX_IDENT_CD string")
    inp = spark.createDataFrame(
        [("ID1", "CLM1", "20090101", 100.0, "250.00", "870"), ("ID2", "CLM2", "20100101", 200.0, None, "871")],
        "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_PMT_AMT double, "
        "ICD9_DGNS_CD_1 string, CLM_DRG_CD string")
    outp = spark.createDataFrame(
        [("ID1", "CLM3", "20090101", 50.0, "401.9", "99213"), ("ID3", "CLM4", "20081231", 150.0, None, None)],
        "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_PMT_AMT double, "
        "ICD9_DGNS_CD_1 string, HCPCS_CD_1 string")
    car = spark.createDataFrame(
        [("ID1", "CLM5", "20090101", 75.0, "272.4", "99214"), ("ID2", "CLM6", "20100101", 125.0, None, None)],
        "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, LINE_NCH_PMT_AMT_1 double, "
        "ICD9_DGNS_CD_1 string, HCPCS_CD_1 string")
    raw = {"beneficiary": ben, "inpatient": inp, "outpatient": outp, "carrier": car}
    return {t: cn.handle_missing(cn.convert_types(df, t), t) for t, df in raw.items()}
