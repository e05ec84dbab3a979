"""Scalar cleaning expressions (C4, C6, C10-C13, C16-C20), all JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnLike, fmt: str = "yyyyMMdd") -> Column:
    """C4: drop a trailing '.0', trim, parse; unparseable text becomes NULL."""
    text = F.trim(F.regexp_replace(_c(c).cast("string"), r"\.0$", ""))
    return F.try_to_date(text, fmt)


def impute_code(c: ColumnLike, fill: str = "Unknown") -> Column:
    """NULL or the text 'None' becomes ``fill``."""
    return F.coalesce(F.nullif(_c(c), F.lit("None")), F.lit(fill))


def clean_code(c: ColumnLike) -> Column:
    """Trimmed code; blank or NULL becomes ''."""
    return F.coalesce(F.trim(_c(c)), F.lit(""))


def normalize_key(c: ColumnLike) -> Column:
    """Text, trimmed, leading zeros removed (both sides of a lookup)."""
    return F.regexp_replace(F.trim(_c(c).cast("string")), "^0+", "")


def remove_dots(c: ColumnLike) -> Column:
    """C17."""
    return F.regexp_replace(_c(c), r"[.]", "")


def feature_code(c: ColumnLike, prefix: str = "icd9_") -> Column:
    """Strip a feature-name prefix and a '_<n>d' suffix."""
    return F.regexp_extract(_c(c), "^" + prefix + r"(.*)_\d+d$", 1)


def age_in_year(birth: ColumnLike, year: int) -> Column:
    """Year minus birth year, NULL becomes 0."""
    return F.coalesce(F.lit(year) - F.year(_c(birth)), F.lit(0)).cast("int")


def flag_equals(c: ColumnLike, value) -> Column:
    """C11: 1 when equal to ``value`` else 0 (NULL gives 0)."""
    return F.when(_c(c) == F.lit(value), 1).otherwise(0).cast("int")


def row_sum(cols: Sequence[ColumnLike], as_type: str = "double") -> Column:
    """Row-wise sum with NULL as 0 (left to right), cast to ``as_type``."""
    zero = F.lit(0).cast(as_type)
    terms = [F.coalesce(_c(c).cast(as_type), zero) for c in cols]
    if not terms:
        return zero
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast(as_type)


def code_slots(cols: Sequence[ColumnLike], drop=("", "None")) -> Column:
    """Slot columns as one array, NULL / blank / listed junk removed."""
    arr = F.array(*[F.trim(_c(c)) for c in cols])
    junk = F.array(*[F.lit(x) for x in drop])
    return F.filter(arr, lambda x: x.isNotNull() & ~F.array_contains(junk, x))


def any_slot_equals(cols: Sequence[ColumnLike], code: str) -> Column:
    """C20: any of the slot columns equals ``code`` (NULL slots ignored)."""
    return F.coalesce(F.array_contains(F.array(*[_c(c) for c in cols]), F.lit(code)), F.lit(False))


def money(c: ColumnLike) -> Column:
    """Amounts as decimal(18,2) so sums do not depend on summation order."""
    return _c(c).cast("decimal(18,2)")


def money_sum(c: ColumnLike) -> Column:
    """Order-independent sum of an amount, returned as double."""
    return F.sum(money(c)).cast("double")


def year_range(c: ColumnLike, year: int) -> Column:
    """C7 as a date range, so Parquet min/max statistics can prune."""
    return (_c(c) >= F.lit(f"{year}-01-01").cast("date")) & (_c(c) <= F.lit(f"{year}-12-31").cast("date"))
