"""A person holding a third of all claims: the lookback join is split by AQE
and the per-person features stay exact."""

import datetime as dt

import pytest

from cohortlens.operators import features as fe


@pytest.fixture()
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_person_split_and_exact(spark, skew_conf):
    base = dt.date(2009, 6, 30)
    rows = []
    for i in range(6000):  # the hot person: a third of all claims
        rows.append(("H", f"h{i}", base - dt.timedelta(days=1 + i % 40), 1.0, "carrier"))
    for p in range(300):
        for j in range(40):
            rows.append((f"P{p}", f"c{p}_{j}", base - dt.timedelta(days=1 + j), 2.0, "inpatient"))
    claims = spark.createDataFrame(rows, "person_id string, claim_id string, claim_date date, claim_amt double, "
                                         "file_type string").repartition(8)
    idx = spark.createDataFrame([("H", 1, base)] + [(f"P{p}", 0, base) for p in range(300)],
                                "person_id string, case_ind int, index_date date")
    window = fe.lookback(idx, claims, 30)
    out = fe.features_from_window(idx, window, None, 30)
    got = {r.person_id: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan  # the hot person's partition was split
    assert got["H"].carrier_count_30d == sum(1 for i in range(6000) if 1 + i % 40 <= 30)
    assert got["H"].carrier_amt_30d == float(got["H"].carrier_count_30d)
    assert got["P7"].inpatient_count_30d == 30 and got["P7"].inpatient_amt_30d == 60.0
