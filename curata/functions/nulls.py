"""Null-aware predicates that reproduce the profiling rules.

Spark's three-valued logic differs from the pandas masks the checks were
written with. Each helper states which null rule it follows; all return
native Column expressions so that they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NA tokens that pandas.read_csv turns into null by default
# (public pandas behaviour); Spark's CSV reader keeps them as text.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def truthy(pred: Column) -> Column:
    """A comparison that is null counts as no violation."""
    return F.coalesce(pred, F.lit(False))


def differs(a, b) -> Column:
    """``a != b`` where null on either or both sides counts as different."""
    return ~F.coalesce(_c(a) == _c(b), F.lit(False))


def any_of(cols: Iterable, pred) -> Column:
    """F8: ``(df[cols] <pred>).any(axis=1)``; a null comparison counts as False."""
    out = F.lit(False)
    for c in cols:
        out = out | truthy(pred(_c(c)))
    return out


def outside(x, lo, hi) -> Column:
    """``~x.between(lo, hi)``; a null value counts as out of range."""
    return ~F.coalesce(_c(x).between(lo, hi), F.lit(False))


def not_in_domain(x, allowed: Iterable) -> Column:
    """Value present and not in the allowed set; null is ignored."""
    col = _c(x)
    return col.isNotNull() & ~col.isin(list(allowed))


def blank(x) -> Column:
    """Null, empty or whitespace-only text."""
    return F.trim(F.coalesce(_c(x), F.lit(""))) == ""


def not_full_match(x, pattern: str) -> Column:
    """Text that does not fully match ``pattern``; null counts as violation."""
    return ~F.coalesce(_c(x).rlike(f"^(?:{pattern})$"), F.lit(False))


def share(pred: Column) -> Column:
    """Mean of a boolean where null rows stay in the denominator."""
    return F.avg(F.coalesce(pred, F.lit(False)).cast("int"))


def pct_of(pred: Column, digits: int | None = None) -> Column:
    """100 x share(pred), optionally rounded half-up."""
    out = F.lit(100.0) * share(pred)
    return F.round(out, digits) if digits is not None else out


def safe_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0``, else null (never a division error)."""
    return F.when(_c(den) > 0, _c(num) / _c(den))



def na_to_null(x, tokens: Iterable[str] = PANDAS_NA_TOKENS) -> Column:
    """Map pandas' default NA tokens (after a CSV read) to null."""
    col = _c(x)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)



def null_if_negative(x) -> Column:
    """A negative delay becomes null; null and zero stay."""
    return F.when(~truthy(F.col(x) < 0), F.col(x))
