"""Column roles: the plans of ``marts`` name what a column means, a role map says which column that is.

``bind`` renames the columns of one table to their roles and fails, naming
them, if a column or a required role is missing. ``Retail`` holds the bound
frames and the values with a meaning ("cancelled", "captured"); a table set
is used by the plans as soon as it can build one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.specs import TableSpec

#: The roles that every frame must have; a frame may have more.
ROLES = {
    "orders": ("order", "customer", "ordered_at", "status", "channel", "country", "currency", "total"),
    "visits": ("at",),
    "lines": ("order", "product", "seller", "quantity"),
    "catalogue": ("product", "category"),
    "products": ("product", "brand", "price", "cost"),
    "customers": ("customer", "segment", "tier"),
    "payments": ("payment", "paid_at", "status", "amount", "method", "reference"),
    "deliveries": ("carrier", "status", "cost", "attempts", "delay_days", "area"),
    "order_checks": ("order", "n_lines", "sum_valid_lines", "no_lines", "total_mismatch"),
    "payment_facts": ("total", "has_capture", "captured_amount", "is_partial", "is_overcapture", "is_multi_capture"),
    "paid_orders": ("total",),
    "line_flags": ("is_duplicate", "is_orphan", "formula_mismatch"),
}


def bind(df: DataFrame, columns: Mapping[str, str], frame: str, spec: TableSpec | None = None, keep_others: bool = False) -> DataFrame:
    """``df`` with ``columns`` (role -> column) renamed to their roles.

    With a ``spec`` the columns must stand in its schema; the frame's required
    roles must all be bound. ``keep_others`` keeps unbound columns whose names
    are no roles.
    """
    known = set(df.columns) if spec is None or spec.schema is None else set(spec.schema.names) & set(df.columns)
    lacking = sorted(c for c in columns.values() if c not in known)
    if lacking:
        raise ValueError(f"{frame}: no columns {', '.join(lacking)}{f' in table {spec.name}' if spec else ''}")
    unbound = [r for r in ROLES.get(frame, ()) if r not in columns]
    if unbound:
        raise ValueError(f"{frame}: nothing plays {', '.join(unbound)}")
    rest = [c for c in df.columns if c not in columns.values() and c not in columns] if keep_others else []
    return df.select(*[F.col(c).alias(r) for r, c in columns.items()], *rest)


@dataclass
class Retail:
    """Bound frames by name, and the values that carry a meaning."""

    frames: dict[str, DataFrame]
    pay_key: tuple[str, ...] = ("order",)       # what identifies the order a payment pays
    cancelled: str = "CANCELLED"
    captured: str = "CAPTURED"
    failed: str = "FAILED"
    delivery_failed: str = "FAILED"
    delivery_returned: str = "RETURNED_TO_WAREHOUSE"
    late_days: int = 7
    shares: dict[str, tuple[str, str]] = field(default_factory=dict)     # headline name -> (order role, value)
    bias: dict[str, tuple[str, str]] = field(default_factory=dict)       # the same per country

    def __post_init__(self):
        for name, df in self.frames.items():
            missing = [r for r in ROLES[name] if r not in df.columns]
            if missing:
                raise ValueError(f"{name}: nothing plays {', '.join(missing)}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]
