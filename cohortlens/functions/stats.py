"""Statistics as Column expressions over aggregated count tables.

Everything except the Fisher p-value is a JVM-side expression.  That one
sums tails of unknown length; it is a pandas UDF applied to aggregated rows
(one row per pair), never per claim.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The UDFs below (and the helpers they call) are shipped by value, so
# executors need only pandas and numpy, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INF = float("inf")
# chi-square(1) critical value at 0.05, i.e. erfc(sqrt(x/2)) = 0.05.
CHI2_CRIT_05 = 3.841458820694124


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_ratio(num, den, when_zero=None) -> Column:
    """num / den, ``when_zero`` (a literal, default NULL) when den = 0."""
    fallback = F.lit(when_zero).cast("double")
    return F.when(_d(den) == 0, fallback).otherwise(_d(num) / _d(den))


def odds_ratio(a, b, c, d) -> Column:
    """a*d / (b*c) for [[a, b], [c, d]]; infinite when b = 0 or c = 0."""
    return F.when((_d(b) > 0) & (_d(c) > 0), (_d(a) * _d(d)) / (_d(b) * _d(c))).otherwise(F.lit(INF))


def yates_chi2(a, b, c, d) -> Column:
    """X2 statistic for a 2x2 table with Yates' continuity correction.

    Expected counts E = row * col / N; every cell is |ad - bc| / N away from
    its expectation, shrunk by 0.5 (not past zero).  NULL when any E is 0."""
    a, b, c, d = (_d(x) for x in (a, b, c, d))
    n = a + b + c + d
    r1, r2, c1, c2 = a + b, c + d, a + c, b + d
    delta = F.abs(a * d - b * c) / n
    adj = F.greatest(delta - F.lit(0.5), F.lit(0.0))
    s = adj * adj
    stat = s / (r1 * c1 / n) + s / (r1 * c2 / n) + s / (r2 * c1 / n) + s / (r2 * c2 / n)
    return F.when((r1 > 0) & (r2 > 0) & (c1 > 0) & (c2 > 0), stat)


def chi2_pvalue(chi2) -> Column:
    """Upper tail of chi-square(1): erfc(z) with z = sqrt(x / 2), as a Column.

    For z < 2.5 one minus the all-positive series
    2 z / sqrt(pi) exp(-z^2) sum (2 z^2)^n / (1 3 5 ... (2n + 1)); above it the
    continued fraction exp(-z^2) / (z sqrt(pi)) / (1 + q / (1 + 2 q / (1 + ...))), q = 1 / (2 z^2)."""
    z2 = _d(chi2) / 2.0
    z = F.sqrt(z2)
    term = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(80)), term, lambda a, n: F.struct(
        (a["t"] * (2.0 * z2) / (2.0 * n + 1.0)).alias("t"), (a["s"] + a["t"] * (2.0 * z2) / (2.0 * n + 1.0)).alias("s")),
        lambda a: a["s"])
    tail = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), F.lit(1.0), lambda a, n: 1.0 + n / (2.0 * z2) / a)
    root_pi = math.sqrt(math.pi)
    return (F.when(z2 <= 0, F.lit(1.0)).when(z < 2.5, 1.0 - 2.0 * z / root_pi * F.exp(-z2) * series)
            .otherwise(F.exp(-z2) / (z * root_pi) / tail))


HALF_LN_2PI = 0.9189385332046728  # ln(2 pi) / 2
LN_TOL = 9.999999500000033e-08  # ln(1 + 1e-7), relative tolerance for "not more likely"


def log_factorial(n: float) -> float:
    """ln(n!) for integer n >= 0: exact product for n <= 18, else the Stirling
    series of ln Gamma(n + 1) to the z^-7 term (error below 2e-15)."""
    if n <= 18:
        return math.log(float(math.factorial(int(n))))
    z = n + 1.0
    return ((z - 0.5) * math.log(z) - z + HALF_LN_2PI + 1.0 / (12.0 * z) - 1.0 / (360.0 * (z * z * z))
            + 1.0 / (1260.0 * (z * z * z * z * z)) - 1.0 / (1680.0 * (z * z * z * z * z * z * z)))


def log_factorial_sql(n: str) -> str:
    """The same formula as ``log_factorial`` in DuckDB SQL."""
    z = f"(CAST({n} AS DOUBLE) + 1.0)"
    return (f"(CASE WHEN {n} <= 18 THEN ln(CAST(factorial(CAST({n} AS INTEGER)) AS DOUBLE)) ELSE "
            f"(({z} - 0.5) * ln({z}) - {z} + {HALF_LN_2PI!r} + 1.0 / (12.0 * {z}) "
            f"- 1.0 / (360.0 * ({z} * {z} * {z})) + 1.0 / (1260.0 * ({z} * {z} * {z} * {z} * {z})) "
            f"- 1.0 / (1680.0 * ({z} * {z} * {z} * {z} * {z} * {z} * {z}))) END)")


def _ln_fisher(a: int, b: int, c: int, d: int) -> float:
    """ln of the two-sided Fisher exact p: the hypergeometric probabilities of
    all tables with the same margins that are not more likely than the
    observed one (relative tolerance 1e-7).

    The probabilities rise to the mode and fall after it, so the tables
    counted are two tails.  Each is summed outward by the ratio of neighbours
    until a term no longer changes the sum: the work follows the spread of
    the distribution, not the size of the margins."""
    r1, c1, n = a + b, a + c, a + b + c + d
    lo, hi = max(0, r1 + c1 - n), min(r1, c1)
    lf = log_factorial
    const = lf(r1) + lf(n - r1) + lf(c1) + lf(n - c1) - lf(n)

    def logp(k):
        return const - (lf(k) + lf(r1 - k) + lf(c1 - k) + lf(n - r1 - c1 + k))

    def outward(k, step):
        """Sum of the probabilities from k on, as a multiple of that of k."""
        total = term = 1.0
        while lo <= k + step <= hi:
            up = (r1 - k) * (c1 - k) / ((k + 1.0) * (n - r1 - c1 + k + 1.0)) if step > 0 else \
                k * (n - r1 - c1 + k + 0.0) / ((r1 - k + 1.0) * (c1 - k + 1.0))
            term *= up
            if total + term == total:
                break
            total += term
            k += step
        return total

    obs = logp(a)
    cut = obs + LN_TOL
    mode = min(max((r1 + 1) * (c1 + 1) // (n + 2), lo), hi)
    if logp(mode) <= cut:
        return 0.0
    own = -1 if a < mode else 1
    # the first table beyond the mode, on the other side, that is not more likely
    near, far = mode, (hi if own < 0 else lo)
    if logp(far) > cut:
        other = None
    else:
        while abs(far - near) > 1:
            mid = (near + far) // 2
            near, far = (near, mid) if logp(mid) <= cut else (mid, far)
        other = far
    total = outward(a, own)
    # tables between the observed one and the mode may tie with it
    k = a - own
    while k != mode and logp(k) <= cut:
        total += math.exp(logp(k) - obs)
        k -= own
    if other is not None:
        total += math.exp(logp(other) - obs) * outward(other, -own)
    return min(obs + math.log(total), 0.0)


@F.pandas_udf(T.DoubleType())
def fisher_ln_pvalue(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """ln p of X8 over rows of 2x2 counts [[a, b], [c, d]]."""
    return pd.Series([_ln_fisher(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d)], dtype="float64")


def fisher_pvalue(a, b, c, d) -> Column:
    """X8 over rows of 2x2 counts [[a, b], [c, d]]."""
    return F.exp(fisher_ln_pvalue(a, b, c, d))


def phi(n, n1, n2, n11) -> Column:
    """Pearson correlation of two 0/1 variables from counts; NULL when
    either is constant."""
    n, n1, n2, n11 = (_d(x) for x in (n, n1, n2, n11))
    den = F.sqrt(n1 * (n - n1) * n2 * (n - n2))
    return F.when(den > 0, (n * n11 - n1 * n2) / den)


def mutual_info(n, n1, n2, n11) -> Column:
    """Mutual information (natural log) of two 0/1 variables from counts;
    empty cells contribute 0."""
    n, n1, n2, n11 = (_d(x) for x in (n, n1, n2, n11))
    cells = [(n11, n1, n2), (n1 - n11, n1, n - n2), (n2 - n11, n - n1, n2),
             (n - n1 - n2 + n11, n - n1, n - n2)]
    total = F.lit(0.0)
    for nxy, nx, ny in cells:
        total = total + F.when(nxy > 0, (nxy / n) * F.log((n * nxy) / (nx * ny))).otherwise(F.lit(0.0))
    return F.when(n > 0, total)
