"""Staged claims layout: no exchange of claims, pruned months, hot people apart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import features as fe
from cohortlens.sources import layout as ly


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _claims(spark):
    base = dt.date(2009, 6, 30)
    rows = [("H", f"h{i}", base - dt.timedelta(days=i % 100), 1.0, "carrier", ["A"] if i % 2 else None) for i in range(400)]
    rows += [(f"P{p}", f"c{p}_{j}", base - dt.timedelta(days=9 * j), 2.0, "inpatient", ["A", "B"][:j % 3]) for p in range(40) for j in range(30)]
    rows += [(None, "x", base, 1.0, "carrier", None)]
    claims = spark.createDataFrame(rows, "person_id string, claim_id string, claim_date date, claim_amt double, file_type string, "
                                         "icd_codes array<string>").withColumn("hcpcs_codes", F.col("icd_codes"))
    index = spark.createDataFrame([("H", 1, base), ("nobody", 0, base)] + [(f"P{p}", p % 2, base) for p in range(40)],
                                  "person_id string, case_ind int, index_date date")
    return claims, index


def test_features_equal_and_claims_stay_in_their_buckets(spark, no_broadcast):
    claims, index = _claims(spark)
    built = ly.stage_index(ly.stage_claims(claims, buckets=4, hot_rows=100), index)
    assert {r.person_id for r in spark.read.parquet(built.hot).select("person_id").distinct().collect()} == {"H"}
    want = fe.engineer_features(index, claims, None, 30, ["A", "B"], ["A"], [("A", "B")])
    got = ly.staged_features(built, None, 30, ["A", "B"], ["A"], [("A", "B")])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    window, _ = ly.staged_window(built, 30)
    plan = window.groupBy(*fe.KEYS).agg(*fe.feature_aggregates(30, ["A"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2


def test_only_the_months_of_the_windows_are_read(spark):
    claims, index = _claims(spark)
    built = ly.stage_index(ly.stage_claims(claims, buckets=4), index)
    window, _ = ly.staged_window(built, 30)
    scan = [x for x in window._jdf.queryExecution().executedPlan().toString().splitlines() if "service_month" in x and "PartitionFilters" in x]
    assert scan and all("2009-05" in x and "2009-06" in x for x in scan)
    files = [f for f in window.inputFiles() if "service_month=" in f]
    assert files and all("service_month=2009-05" in f or "service_month=2009-06" in f for f in files)


def test_no_claims(spark):
    claims, index = _claims(spark)
    built = ly.stage_index(ly.stage_claims(claims.limit(0), buckets=2), index)
    got = ly.staged_features(built, None, 30, ["A"])
    assert got.count() == 42 and got.agg(F.sum("carrier_count_30d")).first()[0] == 0
