"""Table, key and rule specifications: names are data, not code."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    timestamps: tuple[str, ...] = ()
    schema: StructType | None = None
    role: str = ""


@dataclass(frozen=True)
class ForeignKey:
    child: str
    fk: tuple[str, ...]
    parent: str
    pk: tuple[str, ...]
    label: str = ""

    @property
    def name(self) -> str:
        return self.label or f"{self.child}.{','.join(self.fk)} -> {self.parent}.{','.join(self.pk)}"


@dataclass
class Rule:
    """A validity check: rows where ``predicate`` is true are violations.

    ``population`` restricts the rows counted in the base (default: all rows).
    """

    name: str
    table: str
    predicate: Column
    population: Column | None = None
    note: str = ""
    meta: dict = field(default_factory=dict)


def as_tuple(key) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)
