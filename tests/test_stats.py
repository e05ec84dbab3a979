"""Statistics against published values (fixed values quoted from the
reference's saved enrichment tables and pair printout)."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import enrich as en
from cohortlens.functions import stats as st
from cohortlens.operators import pairs as pr

# Code, prevalence_positive, prevalence_negative, prevalence_difference,
# prevalence_ratio, odds_ratio, p_value, pos_with_code, neg_with_code; totals 691 / 39609.
ICD_GOLDEN = [
    ("99673", 0.015918958031837915, 0.001969249413012194, 0.013949708618825721, 8.083769342090616,
     8.198359728506787, 2.2064271035772278e-13, 11, 78),
    ("V053", 0.013024602026049204, 0.0016915347522027822, 0.011333067273846422, 7.699872561937059,
     7.78828730249048, 1.9496105062546082e-10, 9, 67),
    ("585", 0.01881331403762663, 0.0028276401827867404, 0.01598567385483989, 6.653362104610296,
     6.761759903076275, 8.884102107054555e-13, 13, 112),
]
HCPCS_GOLDEN = [
    ("83970", 0.023154848046309694, 0.010022974576485143, 0.013131873469824551, 2.310177270192143,
     2.3412333240041048, 0.0013389130526527038, 16, 397),
    ("98941", 0.010130246020260492, 0.02597894417935318, -0.015848698159092685, 0.38994063616763636,
     0.3836973385845566, 0.01282633990492161, 7, 1029),
    ("92135", 0.004341534008683068, 0.014693630235552526, -0.010352096226869459, 0.29547048204454923,
     0.29239840565811553, 0.03615450681878706, 3, 582),
]
# Tp, fp, PPV, prevalence_pos, prevalence_neg, prevalence_diff, odds ratio,
# Fisher p, mutual information (6 printed digits); totals 1073 / 81259.
PAIR_GOLDEN = [
    (1, 1, 0.500000, 0.000932, 0.000012, 0.000920, 75.800373, 0.025896, 0.000036),
    (2, 1, 0.666667, 0.001864, 0.000012, 0.001852, 151.742297, 0.000505, 0.000082),
    (1, 0, 1.000000, 0.000932, 0.000000, 0.000932, math.inf, 0.013033, 0.000053),
    (2, 2, 0.500000, 0.001864, 0.000025, 0.001839, 75.870215, 0.001001, 0.000072),
    (3, 3, 0.500000, 0.002796, 0.000037, 0.002759, 75.940187, 0.000043, 0.000108),
    (2, 0, 1.000000, 0.001864, 0.000000, 0.001864, math.inf, 0.000170, 0.000105),
]


@pytest.mark.parametrize("golden", [ICD_GOLDEN, HCPCS_GOLDEN])
def test_code_statistics_match_published(spark, golden):
    table = spark.createDataFrame([(g[0], g[7], g[8], 691, 39609) for g in golden],
                                  "code string, pos_with_code long, neg_with_code long, n_pos long, n_neg long")
    got = {r.code: r for r in en.code_statistics(table).collect()}
    for g in golden:
        r = got[g[0]]
        assert r.prevalence_positive == pytest.approx(g[1], rel=1e-14)
        assert r.prevalence_negative == pytest.approx(g[2], rel=1e-14)
        assert r.prevalence_difference == pytest.approx(g[3], rel=1e-12)
        assert r.prevalence_ratio == pytest.approx(g[4], rel=1e-12)
        assert r.odds_ratio == pytest.approx(g[5], rel=1e-12)
        assert r.p_value == pytest.approx(g[6], rel=1e-12)


def test_significance_screen_both_directions(spark):
    rows = [(g[0], g[7], g[8], 691, 39609) for g in ICD_GOLDEN + HCPCS_GOLDEN]
    table = spark.createDataFrame(rows, "code string, pos_with_code long, neg_with_code long, n_pos long, n_neg long")
    kept = [r.code for r in en.significance_screen(en.code_statistics(table)).collect()]
    assert kept == ["99673", "V053", "585", "83970", "98941", "92135"]  # sorted by odds ratio, desc


def test_infinite_and_undefined_cases(spark):
    table = spark.createDataFrame([("a", 5, 0, 10, 100), ("b", 0, 0, 10, 100)],
                                  "code string, pos_with_code long, neg_with_code long, n_pos long, n_neg long")
    got = {r.code: r for r in en.code_statistics(table).collect()}
    assert math.isinf(got["a"].odds_ratio) and math.isinf(got["a"].prevalence_ratio)
    assert got["b"].chi2 is None and got["b"].p_value is None  # an expected count is 0


def test_pair_statistics_match_published(spark):
    rows = [(f"c{i}", f"d{i}", g[0], g[1], 1073 - g[0], 81259 - g[1]) for i, g in enumerate(PAIR_GOLDEN)]
    table = spark.createDataFrame(rows, "code1 string, code2 string, tp long, fp long, fn long, tn long")
    got = {r.code1: r for r in pr.pair_statistics(table).collect()}
    for i, g in enumerate(PAIR_GOLDEN):
        r = got[f"c{i}"]
        assert round(r.PPV, 6) == g[2]
        assert round(r.prevalence_pos, 6) == g[3] and round(r.prevalence_neg, 6) == g[4]
        assert round(r.prevalence_diff, 6) == g[5]
        assert (math.isinf(r.odds_ratio) and math.isinf(g[6])) or round(r.odds_ratio, 6) == g[6]
        assert round(r.p_value, 6) == g[7]
        assert round(r.mutual_info, 6) == g[8]


def test_fisher_small_table():
    from cohortlens.functions.stats import _ln_fisher
    # classic tea-tasting table [[3, 1], [1, 3]]: two-sided p = 34/70
    assert math.exp(_ln_fisher(3, 1, 1, 3)) == pytest.approx(34 / 70, rel=1e-12)
    assert math.exp(_ln_fisher(0, 5, 5, 0)) == pytest.approx(2 / 252, rel=1e-12)


def _plain_ln_fisher(a, b, c, d):
    """Every table of the support, as rationals."""
    import math
    from fractions import Fraction
    r1, c1, n = a + b, a + c, a + b + c + d
    p = {k: Fraction(math.comb(r1, k) * math.comb(n - r1, c1 - k), math.comb(n, c1)) for k in range(max(0, r1 + c1 - n), min(r1, c1) + 1)}
    return math.log(sum(v for v in p.values() if v <= p[a] * Fraction(10000001, 10000000)))


def test_fisher_against_every_table():
    import random
    rng = random.Random(8)
    for _ in range(400):
        cells = [rng.randint(0, rng.choice((3, 12, 60))) for _ in range(4)]
        assert st._ln_fisher(*cells) == pytest.approx(_plain_ln_fisher(*cells), rel=1e-9, abs=1e-11), cells


def test_fisher_large_margins_and_ranking(spark):
    """Margins of 1e7 take a short sum; p far below the smallest double keeps its order by ln p."""
    from cohortlens.operators import pairs as pr
    assert st._ln_fisher(10_000_000, 0, 0, 10_000_000) < -1e7
    rows = [("a", "z", 3000, 10, 10, 3000), ("b", "y", 3100, 10, 10, 3100), ("c", "x", 5, 5, 5, 5)]
    table = spark.createDataFrame(rows, "code1 string, code2 string, tp long, fp long, fn long, tn long")
    stats = pr.pair_statistics(table)
    assert [r.code1 for r in stats.orderBy("ln_p").collect()] == ["b", "a", "c"]
    assert {r.code1 for r in pr.select_pairs(stats.where("code1 <> 'c'").withColumn("PPV", F.lit(0.0)), 1).collect()} == {"b"}
