"""A semantic layer: named dimensions and measures over the star.

A :class:`MetricView` is data. ``query`` turns a choice of names into one lazy DataFrame:

1. the fact is filtered (global filter, conditions on its own columns);
2. it is aggregated by the foreign keys and fact columns that the question needs, so a
   key that holds a third of the fact shrinks to one row per task before any shuffle;
3. only the dimension tables the question names are joined, at that reduced grain;
4. the result is aggregated again by the business names, which may merge several keys.

Order counts stay exact through both steps. An order has one header, hence one customer,
seller, zone, currency and date, so its distinct count adds up over those keys. Products
differ within an order: with a product dimension only the product table is joined to fact rows.
Every group is then brought down to one row per order, next to the keys of whole orders with a
plain count, and the other tables are joined at that grain. No fact row is expanded for several distinct counts; rows already reduced
by key may be, where names of customers and currencies are counted together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import current_year
from starmart.functions.numbers import change_pct
from starmart.operators.gold import Dimension as Table
from starmart.plans.mart import Star


#: Columns of the fact that say when a sale was.
PERIODS = ("sale_date", "sale_year", "month_start")


class MetricError(ValueError):
    """A question that the metric view does not answer, such as a measure in a filter."""


@dataclass(frozen=True)
class Dimension:
    """A business name for a column of the fact (``table`` is None) or of a dimension table.

    ``within_order`` marks columns that may differ between the lines of one order.
    """

    name: str
    column: str
    table: Table | None = None
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    within_order: bool = False
    match_values: bool = False


@dataclass(frozen=True)
class Total:
    """SUM of a fact column, cast to ``data_type``, the type of a one-step sum."""

    column: str
    data_type: str


@dataclass(frozen=True)
class Orders:
    """COUNT(DISTINCT order_id)."""


@dataclass(frozen=True)
class DistinctNames:
    """COUNT(DISTINCT column) of a dimension table: names, not ids.

    The table must describe whole orders, as customers do, not their lines.
    """

    column: str
    table: Table


@dataclass(frozen=True)
class Measure:
    """A named aggregate, defined once as a combination of parts."""

    name: str
    parts: tuple[Total | Orders | DistinctNames, ...]
    combine: Callable[..., Column]
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    format: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Between:
    """Inclusive range condition on a dimension; either end may be open (None)."""

    low: object = None
    high: object = None


def _condition(column: Column, wanted) -> Column:
    if isinstance(wanted, Between):
        tests = []
        if wanted.low is not None:
            tests.append(column >= wanted.low)
        if wanted.high is not None:
            tests.append(column <= wanted.high)
        if not tests:
            return F.lit(True)
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, (list, tuple, set, frozenset)):
        named = column.isin(*[w for w in wanted if w is not None])
        return named | column.isNull() if None in wanted else named
    return column.isNull() if wanted is None else column == wanted


def _ends(wanted) -> tuple[object, object]:
    """Lowest and highest value a condition admits; None where it does not say."""
    if isinstance(wanted, Between):
        return wanted.low, wanted.high
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return (None, None) if not wanted or None in wanted else (min(wanted), max(wanted))
    return (wanted, wanted) if isinstance(wanted, (dt.date, str)) else (None, None)


@dataclass(frozen=True)
class MetricView:
    """Dimensions, measures and a filter that always applies."""

    name: str
    filter: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    comment: str = ""

    def dimension(self, name: str) -> Dimension:
        for d in self.dimensions:
            if d.name == name:
                return d
        if any(m.name == name for m in self.measures):
            raise MetricError(f"{name!r} is a measure: it cannot group or filter")
        raise MetricError(f"no dimension {name!r} in {self.name}")

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        if any(d.name == name for d in self.dimensions):
            raise MetricError(f"{name!r} is a dimension: it cannot be measured")
        raise MetricError(f"no measure {name!r} in {self.name}")

    def query(
        self,
        star: Star,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Mapping[str, object] | None = None,
        order_by: Sequence[tuple[str, str]] = (),
        limit: int | None = None,
        currencies: str | None = "flag",
        this_year: bool = False,
    ) -> DataFrame:
        """Measures at the grain of ``dimensions``.

        ``where`` maps a dimension to a value, a list of values, a :class:`Between` or a
        function of its column. ``order_by`` lists ``(name, "asc" | "desc")``; the
        dimensions follow as tie-breakers. Amounts of several currencies are never added up
        silently: ``currencies="flag"`` adds the number of distinct currencies in each group, with
        ``"raise"`` the job fails if a group mixes them, and None, which adds them up, must be asked for.
        With ``this_year`` a question without a condition on the period is about the calendar
        year of the star's reference date (M13).
        """
        if not dimensions and not measures:
            raise MetricError("name at least one dimension or measure")
        groups = [self.dimension(n) for n in dimensions]
        chosen = [self.measure(n) for n in measures]
        conditions = [(self.dimension(n), wanted) for n, wanted in (where or {}).items()]
        if this_year and not any(d.column in PERIODS for d, _ in conditions):
            day = next(d for d in self.dimensions if d.column == "sale_date")
            conditions.append((day, Between(*current_year(star.cfg.as_of))))
        if currencies not in (None, "flag", "raise"):
            raise MetricError(f"currencies must be None, 'flag' or 'raise', not {currencies!r}")
        known = {*dimensions, *measures}
        for name, direction in order_by:
            if name not in known or direction not in ("asc", "desc"):
                raise MetricError(f"cannot order by {name!r} {direction!r}")

        parts = list(dict.fromkeys(p for m in chosen for p in m.parts))
        question = _Question(star, groups, conditions, parts, currencies is not None)
        rows = question.answer(self.filter)
        values = [F.col(f"g{i}").alias(d.name, metadata=_about(d)) for i, d in enumerate(groups)]
        for m in chosen:
            value = m.combine(*[F.col(f"p{parts.index(p)}") for p in m.parts])
            about = {**_about(m), "format": dict(m.format)}
            values.append(value.alias(m.name, metadata=about))
        if currencies == "raise":
            # in the one plan: nothing runs before the result is asked for
            mixed = F.raise_error(F.lit("a group adds up amounts of different currencies"))
            rows = rows.filter(F.when(F.col("currencies") > 1, mixed.cast("boolean")).otherwise(True))
        result = rows.select(*values, *(["currencies"] if currencies == "flag" else []))
        if order_by or limit is not None:
            keys = [
                F.col(f"`{n}`").desc() if direction == "desc" else F.col(f"`{n}`").asc()
                for n, direction in order_by
            ]
            keys += [F.col(f"`{n}`") for n in dimensions if n not in {n for n, _ in order_by}]
            result = result.orderBy(*keys) if keys else result
        return result if limit is None else result.limit(limit)


@dataclass(frozen=True)
class _Question:
    """A query resolved to columns: group i becomes ``g<i>`` and part i ``p<i>``."""

    star: Star
    groups: list[Dimension]
    conditions: list[tuple[Dimension, object]]
    parts: list[Total | Orders | DistinctNames]
    currencies: bool

    def answer(self, view_filter: str) -> DataFrame:
        fact = self._filtered(self.star.fact_sales.filter(view_filter))
        if not self._tables and not self.currencies:
            return _aggregate(fact, self._names, self._numbered(_direct))
        counts_orders = any(isinstance(p, Orders) for p in self.parts)
        if counts_orders and any(d.within_order for d in self._touched):
            return self._by_order(fact)
        return self._by_key(fact)

    @property
    def _names(self) -> list[Column]:
        return [F.col(d.column).alias(f"g{i}") for i, d in enumerate(self.groups)]

    @property
    def _outer(self) -> list[tuple[Dimension, object]]:
        """Conditions on dimension tables."""
        return [(d, wanted) for d, wanted in self.conditions if d.table is not None]

    @property
    def _touched(self) -> list[Dimension]:
        return [*self.groups, *[d for d, _ in self._outer]]

    @property
    def _tables(self) -> list[Table]:
        named = [d.table for d in self._touched if d.table is not None]
        counted = [p.table for p in self.parts if isinstance(p, DistinctNames)]
        return list(dict.fromkeys(named + counted))

    @property
    def _fact_keys(self) -> list[str]:
        keys = [t.key for t in self._tables]
        keys += [d.column for d in self.groups if d.table is None]
        if self.currencies:
            keys.append("currency")
        return list(dict.fromkeys(keys))

    def _numbered(self, aggregate, kinds=(Total, Orders, DistinctNames)) -> list[Column]:
        return [
            aggregate(p).alias(f"p{i}") for i, p in enumerate(self.parts) if isinstance(p, kinds)
        ]

    def _currency_count(self) -> list[Column]:
        return [F.count_distinct("currency").alias("currencies")] if self.currencies else []

    def _filtered(self, fact: DataFrame) -> DataFrame:
        """Conditions on the fact's own columns, and the months a date range implies."""
        for dimension, wanted in self.conditions:
            if dimension.table is not None:
                continue
            fact = fact.filter(_condition(F.col(dimension.column), wanted))
            if dimension.column in ("sale_date", "month_start"):
                fact = fact.filter(months_between_dates(*_ends(wanted)))
        return fact

    def _joined(self, rows: DataFrame, tables: list[Table]) -> DataFrame:
        """Rows with the columns of these dimension tables that the question names."""
        for table in tables:
            columns = [d.column for d in self._touched if d.table == table]
            columns += [
                p.column for p in self.parts if isinstance(p, DistinctNames) and p.table == table
            ]
            named = getattr(self.star, table.table).select(table.key, *dict.fromkeys(columns))
            rows = rows.join(named, table.key, "left")
        for dimension, wanted in self._outer:
            if dimension.table in tables:
                rows = rows.filter(_condition(F.col(dimension.column), wanted))
        return rows

    def _by_key(self, fact: DataFrame) -> DataFrame:
        """Reduce to foreign keys, join, merge by name."""
        reduced = _aggregate(fact, self._fact_keys, self._numbered(_direct, (Total, Orders)))
        return self._by_name(self._joined(reduced, self._tables))

    def _by_order(self, fact: DataFrame) -> DataFrame:
        """Some names vary within an order: join those, reduce to orders, then as by key."""
        varying = [d.table for d in self._touched if d.within_order]
        lines = [t for t in self._tables if t in varying]
        whole = [t for t in self._tables if t not in varying]
        keys = [k for k in self._fact_keys if k not in {t.key for t in lines}]
        names = [d.column for d in self.groups if d.table in lines]
        amounts = [p.column for p in self.parts if isinstance(p, Total)]
        rows = fact.select(*dict.fromkeys([*self._fact_keys, "order_id", *amounts]))
        grain = list(dict.fromkeys([*names, *keys]))
        per_order = _aggregate(
            self._joined(rows, lines), [*grain, "order_id"], self._numbered(_direct, (Total,))
        )
        counted = [
            (F.count("order_id") if isinstance(p, Orders) else _merged(p, "", f"p{i}")).alias(f"p{i}")
            for i, p in enumerate(self.parts)
            if isinstance(p, (Total, Orders))
        ]
        return self._by_name(self._joined(_aggregate(per_order, grain, counted), whole))

    def _by_name(self, rows: DataFrame) -> DataFrame:
        """Merge rows reduced by key whose names are equal."""
        merged = [
            _merged(p, getattr(p, "column", ""), f"p{i}").alias(f"p{i}")
            for i, p in enumerate(self.parts)
        ]
        return _aggregate(rows, self._names, merged + self._currency_count())


def _about(member: Dimension | Measure) -> dict[str, str]:
    return {"comment": member.comment}


def _aggregate(df: DataFrame, groups: list, aggregates: list[Column]) -> DataFrame:
    if not aggregates:
        return df.select(*groups).distinct()
    return df.groupBy(*groups).agg(*aggregates)


def _direct(part) -> Column:
    """The part over fact rows."""
    if isinstance(part, Total):
        return F.sum(part.column).cast(part.data_type)
    return F.count_distinct("order_id")


def _merged(part, name: str, partial: str) -> Column:
    """The part over rows that were already aggregated by key."""
    if isinstance(part, Total):
        return F.sum(partial).cast(part.data_type)
    if isinstance(part, DistinctNames):
        return F.count_distinct(name)
    return F.coalesce(F.sum(partial), F.lit(0)).cast("bigint")


def months_between_dates(low, high) -> Column:
    """The condition on the fact's partition columns that a date range implies.

    Spark does not derive it from ``sale_date``; with it, months outside the range are
    never listed or read. Ends may be dates, DATE columns or None.
    """
    month = F.col("sale_year") * 12 + F.col("sale_month")
    tests = []
    for end, at_least in ((low, True), (high, False)):
        if end is None:
            continue
        day = end if isinstance(end, Column) else F.lit(end)
        bound = F.year(day) * 12 + F.month(day)
        tests.append(month >= bound if at_least else month <= bound)
    if not tests:
        return F.lit(True)
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def compare_periods(
    base: DataFrame, group: str, period: str, value: str, current: int, previous: int
) -> DataFrame:
    """Pivot an aggregated result into two periods side by side.

    ``base`` has one row per group and period: measures are aggregated first and compared
    afterwards, never the other way round.
    """
    wide = base.groupBy(group).agg(
        *[
            F.max(F.when(F.col(f"`{period}`") == at, F.col(f"`{value}`"))).alias(alias)
            for alias, at in (("current", current), ("previous", previous))
        ]
    )
    change = change_pct(F.col("current"), F.col("previous"))
    return wide.select(
        group, "current", "previous", F.round(change, 1).alias("change_pct")
    ).orderBy(group)
