"""Key constraints of the star, checked as Spark jobs (K1-K3).

Parquet tables take no key declarations. These checks are what makes the join pruning of
the metric layer valid: it relies on unique dimension keys and on one header per order.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.gold import DIMENSIONS, REFERENCES
from starmart.session import small_table

# Tables whose key must be present and unique: name in the constraint, table, key. The key
# of the order headers is checked so that the order-line join cannot multiply lines.
KEYED = [(d.table.removeprefix("dim_"), d.table, d.key) for d in DIMENSIONS]
KEYED.append(("order", "silver_orders", "order_id"))

CONSTRAINTS = [
    *[(t, f"{prefix}_{s}", kind) for s, t, _ in KEYED
      for prefix, kind in (("nn", "not_null"), ("pk", "primary_key"))],
    *[(r.fact, r.name, "foreign_key") for r in REFERENCES],
]


class ConstraintViolation(ValueError):
    """Some key constraint does not hold; the message lists the failing ones."""


def _key_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per key value of every keyed table, counted in one aggregation."""
    return (
        reduce(
            DataFrame.unionByName,
            [
                tables[table].select(
                    F.lit(suffix).alias("subject"),
                    F.lit(table).alias("keyed"),
                    F.col(key).alias("value"),
                )
                for suffix, table, key in KEYED
            ],
        )
        .groupBy("subject", "keyed", "value")
        .agg(F.count("*").alias("n"))
    )


def _keys(counts: DataFrame) -> DataFrame:
    """NOT NULL counts rows without a key; PRIMARY KEY counts values that repeat."""
    totals = counts.groupBy("subject").agg(
        F.sum("n").alias("checked"),
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("nulls"),
        F.count(F.when(F.col("value").isNotNull() & (F.col("n") > 1), 1)).alias("repeated"),
    )
    checks = F.array(
        *[
            F.struct(
                F.concat(F.lit(prefix), "subject").alias("constraint_name"),
                F.col(found).alias("violations"),
            )
            for prefix, found in (("nn_", "nulls"), ("pk_", "repeated"))
        ]
    )
    return totals.select("checked", F.inline(checks)).select(
        "constraint_name", "checked", "violations"
    )


def _foreign_keys(tables: Mapping[str, DataFrame], counts: DataFrame) -> DataFrame:
    """Every foreign key, from one scan of each fact.

    Key values are counted before the lookup, so a value that holds a third of the fact
    travels as one row. NULL keys are allowed and never looked up.
    """

    def pairs(fact: str) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("constraint_name"),
                    F.lit(r.dimension.table).alias("keyed"),
                    F.col(r.dimension.key).alias("value"),
                )
                for r in REFERENCES
                if r.fact == fact
            ]
        )

    used = (
        reduce(
            DataFrame.unionByName,
            [
                tables[fact].select(F.inline(pairs(fact)))
                for fact in dict.fromkeys(r.fact for r in REFERENCES)
            ],
        )
        .groupBy("constraint_name", "keyed", "value")
        .agg(F.count("*").alias("n"))
    )
    # no foreign key looks up order headers, the largest set of keys
    known = counts.filter(F.col("keyed").isin([d.table for d in DIMENSIONS])).select(
        "keyed", "value", F.lit(True).alias("known")
    )
    orphan = F.col("value").isNotNull() & F.col("known").isNull()
    return (
        used.join(known, ["keyed", "value"], "left")
        .groupBy("constraint_name")
        .agg(F.sum("n").alias("checked"), F.sum(F.when(orphan, F.col("n"))).alias("violations"))
    )


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per constraint with the rows checked and the violations found.

    ``tables`` holds the Gold tables and ``silver_orders``.
    """
    counts = _key_counts(tables)
    found = _keys(counts).unionByName(_foreign_keys(tables, counts))
    declared = small_table(
        counts.sparkSession,
        CONSTRAINTS,
        "table_name string, constraint_name string, kind string",
    )
    return declared.join(found, "constraint_name", "left").select(
        "table_name",
        "constraint_name",
        "kind",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("checked", "violations")],
    )


def enforce(constraint_report: DataFrame) -> None:
    """Raise if any constraint of the report is violated."""
    broken = constraint_report.filter("violations > 0").orderBy("constraint_name").collect()
    if broken:
        raise ConstraintViolation(
            "; ".join(f"{r.constraint_name} on {r.table_name}: {r.violations}" for r in broken)
        )
