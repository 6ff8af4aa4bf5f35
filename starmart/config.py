"""Names and choices that every layer of the mart shares."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

# Schema overrides per deployment target.
TARGETS = {
    "dev": {"silver_schema": "silver_dev", "gold_schema": "gold_dev"},
    "prod": {},
}

# Fixed value: the only order status that counts as a sale.
SALE_STATUS = "sale"

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,3)"
UNIT_PRICE = "decimal(18,4)"
DISCOUNT = "decimal(9,4)"


@dataclass(frozen=True)
class MartConfig:
    """Namespaces and semantics of one mart.

    ``currency`` selects the companies whose books are kept in it. ``locales`` is the
    fallback order for translatable text. ``as_of`` replaces the clock wherever a question
    reads it; ``None`` means the current date. ``strict_casts=False`` turns text that does
    not parse, and ratios that overflow, into NULL instead of failing the job.
    """

    catalog: str | None = None
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    currency: str = "HNL"
    locales: tuple[str, ...] = ("es_ES", "es_419", "en_US")
    as_of: dt.date | None = None
    strict_casts: bool = True

    def __post_init__(self) -> None:
        named = {
            "bronze_schema": self.bronze_schema,
            "silver_schema": self.silver_schema,
            "gold_schema": self.gold_schema,
        }
        if self.catalog is not None:
            named["catalog"] = self.catalog
        for field, value in named.items():
            if not _IDENTIFIER.fullmatch(value):
                raise ValueError(f"{field} is not a plain identifier: {value!r}")
        if not re.fullmatch(r"[A-Z]{3}", self.currency):
            raise ValueError(f"currency must be a three-letter code: {self.currency!r}")
        if not self.locales or not all(re.fullmatch(r"\w+", loc) for loc in self.locales):
            raise ValueError(f"locales must be locale codes: {self.locales!r}")

    @classmethod
    def for_target(cls, target: str, **overrides) -> MartConfig:
        if target not in TARGETS:
            raise ValueError(f"unknown target {target!r}, expected one of {sorted(TARGETS)}")
        return cls(**{**TARGETS[target], **overrides})

    def schema(self, layer: str) -> str:
        name = {
            "bronze": self.bronze_schema,
            "silver": self.silver_schema,
            "gold": self.gold_schema,
        }[layer]
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"


def today(as_of: dt.date | None) -> Column:
    """The reference date of clock-based questions as a DATE column."""
    return F.current_date() if as_of is None else F.lit(as_of)


def current_year(as_of: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The period to use when a question names none."""
    day = as_of or dt.date.today()
    return dt.date(day.year, 1, 1), dt.date(day.year, 12, 31)


def current_quarter(as_of: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar quarter of ``as_of``."""
    day = as_of or dt.date.today()
    first = 3 * ((day.month - 1) // 3) + 1
    following = dt.date(day.year + first // 10, (first + 2) % 12 + 1, 1)
    return dt.date(day.year, first, 1), following - dt.timedelta(days=1)
