"""Data-quality expectations of the Silver views."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"

# The order states the source is known to use.
KNOWN_STATES = ("draft", "sent", "sale", "cancel", "done")


@dataclass(frozen=True)
class Expectation:
    """A predicate every row of a view should satisfy.

    ``drop`` removes rows that fail, ``warn`` keeps and counts them. A predicate that
    evaluates to NULL has failed.
    """

    view: str
    name: str
    predicate: str
    action: str = DROP

    def failed(self) -> Column:
        holds = F.coalesce(F.expr(self.predicate), F.lit(False))
        return F.coalesce(F.sum(F.when(holds, 0).otherwise(1)), F.lit(0)).cast("bigint")


EXPECTATIONS = (
    Expectation("silver_salespeople", "salesperson_has_id", "salesperson_id IS NOT NULL"),
    Expectation("silver_territories", "territory_has_id", "territory_id IS NOT NULL"),
    Expectation("silver_customers", "customer_has_id", "customer_id IS NOT NULL"),
    Expectation("silver_products", "product_has_id", "product_id IS NOT NULL"),
    Expectation("silver_orders", "order_has_id", "order_id IS NOT NULL"),
    Expectation("silver_orders", "status_is_known", f"order_status IN {KNOWN_STATES}", WARN),
    Expectation("silver_order_lines", "line_has_order", "order_id IS NOT NULL"),
)


def expectations(view: str) -> list[Expectation]:
    return [e for e in EXPECTATIONS if e.view == view]


def enforce(df: DataFrame, view: str, observation: Observation | None = None) -> DataFrame:
    """Apply a view's expectations.

    With an ``observation`` the failures are counted while the view is being written, at
    no extra pass: ``observation.get`` then maps each expectation to its failed rows.
    """
    rules = expectations(view)
    if observation is not None:
        df = df.observe(
            observation,
            F.count("*").alias("evaluated"),
            *[rule.failed().alias(rule.name) for rule in rules],
        )
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(F.expr(rule.predicate))
    return df


def report(unchecked: Mapping[str, DataFrame]) -> DataFrame:
    """One row per expectation over views as they are before any row is dropped.

    Each view is aggregated once for all its expectations.
    """
    parts = []
    for view in dict.fromkeys(e.view for e in EXPECTATIONS):
        rules = expectations(view)
        totals = unchecked[view].agg(
            F.count("*").alias("evaluated"), *[rule.failed().alias(rule.name) for rule in rules]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("constraint_name"),
                    F.lit(rule.action).alias("action"),
                    F.col(rule.name).alias("failed"),
                )
                for rule in rules
            ]
        )
        parts.append(
            totals.select("evaluated", F.inline(rows)).select(
                F.lit(view).alias("view_name"), "constraint_name", "action", "evaluated", "failed"
            )
        )
    return reduce(DataFrame.unionByName, parts)
