"""Scalar helpers (X1-X23) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0

# Weekday names in calendar order (Monday first) and the
# severity ranks of the anomaly register.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEVERITY_ORDER = {"High": 0, "Medium": 1, "Info": 2}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_ts(x, fmt: str | None = None) -> Column:
    """Text -> timestamp in the session zone (UTC); bad text -> null."""
    col = _c(x).cast("string")
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def days_between(later, earlier) -> Column:
    """Signed (later - earlier) in fractional days (zone-free, works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)) / F.lit(MICROS_PER_DAY)



def month_label(ts) -> Column:
    """``YYYY-MM``."""
    return F.date_format(_c(ts), "yyyy-MM")


def quarter_label(ts) -> Column:
    """``YYYYQn`` as pandas' ``to_period('Q')`` prints it."""
    return F.concat(F.year(_c(ts)).cast("string"), F.lit("Q"), F.quarter(_c(ts)).cast("string"))


def weekday_name(ts) -> Column:
    """Full English weekday name."""
    return F.date_format(_c(ts), "EEEE")


def weekday_rank(ts) -> Column:
    """K3: 0 for Monday .. 6 for Sunday."""
    return F.weekday(_c(ts))




def clip_upper(x, n) -> Column:
    """``clip(upper=n)`` keeping nulls."""
    return F.when(_c(x).isNull(), None).otherwise(F.least(_c(x), F.lit(n)))


def severity_rank(x) -> Column:
    """K3: custom order of the register's severity labels; unknown last."""
    m = F.create_map(*[F.lit(v) for kv in SEVERITY_ORDER.items() for v in kv])
    return F.coalesce(m[_c(x)], F.lit(len(SEVERITY_ORDER)))


def hist_bin(x, lo: float, hi: float, width: float = 1.0) -> Column:
    """Left edge of an equal-width bin on [lo, hi]; last bin closed.

    Values outside [lo, hi] give null (they are dropped by the histogram).
    """
    col = _c(x)
    nbins = int(round((hi - lo) / width))
    idx = F.least(F.floor((col - F.lit(lo)) / F.lit(width)), F.lit(nbins - 1))
    return F.when(col.between(lo, hi), F.lit(lo) + idx * F.lit(width))


def salted_sha256(x, salt: str) -> Column:
    """Hex SHA-256 of salt || value; null stays null."""
    return F.sha2(F.concat(F.lit(salt), _c(x).cast("string")), 256)
