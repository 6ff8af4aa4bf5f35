"""Rows that Silver could not type, or would drop, set aside with the reason.

Bronze is text and Silver casts it strictly: one bad value fails the job, and a row without
its key is dropped. With a quarantine, each table is inspected in one pass that writes good
and failed rows apart; Silver reads the good ones, in which every cast holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import contract
from starmart.config import DISCOUNT, MONEY, QUANTITY, UNIT_PRICE

# The types that Silver gives to Bronze columns.
TYPES: dict[str, dict[str, str]] = {
    "sale_order": {
        "id": "bigint", "partner_id": "bigint", "user_id": "bigint", "team_id": "bigint",
        "date_order": "timestamp", "amount_untaxed": MONEY, "amount_tax": MONEY,
        "amount_total": MONEY,
    },
    "sale_order_line": {
        "id": "bigint", "order_id": "bigint", "product_id": "bigint",
        "product_uom_qty": QUANTITY, "qty_delivered": QUANTITY, "price_unit": UNIT_PRICE,
        "discount": DISCOUNT, "price_subtotal": MONEY, "price_total": MONEY,
    },
    "res_partner": {
        "id": "bigint", "is_company": "boolean", "customer_rank": "int", "active": "boolean",
    },
    "res_users": {"id": "bigint", "active": "boolean"},
    "crm_team": {"id": "bigint", "user_id": "bigint"},
    "product_product": {"id": "bigint"},
    "product_template": {
        "list_price": UNIT_PRICE, "sale_ok": "boolean", "active": "boolean",
    },
    "stock_quant": {"product_id": "bigint", "quantity": QUANTITY, "reserved_quantity": QUANTITY},
}

#: Columns without which a view drops the row, and the expectation that does.
NEEDED: dict[str, dict[str, str]] = {
    "sale_order": {"id": "order_has_id"},
    "sale_order_line": {"order_id": "line_has_order"},
    "res_partner": {"id": "customer_has_id"},
    "res_users": {"id": "salesperson_has_id"},
    "crm_team": {"id": "territory_has_id"},
    "product_product": {"id": "product_has_id"},
}

#: Rows that Silver leaves out before it types them are good as they are.
TYPED_ONLY = {"sale_order_line": "coalesce(display_type, '') = ''"}

PROBLEMS = "problems array<struct<rule: string, column_name: string, raw: string>>"


def problems(table: str) -> Column:
    """What is wrong with a Bronze row: rule, column and raw text of each failure, in order."""

    def failure(when: Column, rule: str, column: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(column).alias("raw"),
            ),
        )

    found = [
        failure(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), f"is {kind}", c)
        for c, kind in TYPES.get(table, {}).items()
    ]
    found += [failure(F.col(c).isNull(), rule, c) for c, rule in NEEDED.get(table, {}).items()]
    if not found:
        return F.array().cast(PROBLEMS.partition(" ")[2])
    every = F.array_compact(F.array(*found))
    if table not in TYPED_ONLY:
        return every
    return F.when(F.expr(TYPED_ONLY[table]), every).otherwise(F.slice(every, 1, 0))


class Quarantine(Mapping):
    """Bronze tables without their failed rows, which are kept under ``folder``.

    A table is inspected when it is first asked for, in one pass over its rows; tables that
    Silver neither types nor filters are passed on unread. ``folder`` must be new, or hold an
    inspection of the same Bronze: it is written once per object.
    """

    def __init__(self, spark: SparkSession, bronze: Mapping[str, DataFrame], folder: str) -> None:
        self._spark, self._bronze, self._folder = spark, bronze, folder
        self._written: set[str] = set()
        self._locks = {table: Lock() for table in contract.TABLE_NAMES}

    def _inspected(self, table: str) -> DataFrame:
        path = f"{self._folder}/{table}"
        with self._locks[table]:
            if table not in self._written:
                rows = self._bronze[table].select(*contract.TABLES[table], problems(table).alias("problems"))
                (
                    rows.withColumn("failed", F.size("problems") > 0)
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "static")
                    .partitionBy("failed")
                    .parquet(path)
                )
                self._written.add(table)
        columns = ", ".join(f"`{c}` STRING" for c in contract.TABLES[table])
        return self._spark.read.schema(f"{columns}, {PROBLEMS}, failed BOOLEAN").parquet(path)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in TYPES:
            return self._bronze[table].select(*contract.TABLES[table])
        return self._inspected(table).where("NOT failed").select(*contract.TABLES[table])

    def __iter__(self) -> Iterator[str]:
        return iter(contract.TABLE_NAMES)

    def __len__(self) -> int:
        return len(contract.TABLE_NAMES)

    def failed(self, table: str) -> DataFrame:
        """The rows set aside, as they came, with ``problems``."""
        return self._inspected(table).where("failed").drop("failed")

    def report(self, tables=tuple(TYPES)) -> DataFrame:
        """One row per failure: ``table_name, id, rule, column_name, raw``."""
        parts = [
            self.failed(t).select(F.lit(t).alias("table_name"), "id", F.inline("problems")) for t in tables
        ]
        return reduce(DataFrame.unionByName, parts)

    def counts(self, tables=tuple(TYPES)) -> DataFrame:
        """One row per table: ``table_name, good_rows, failed_rows``."""
        parts = [
            self._inspected(t)
            .agg(F.count_if(~F.col("failed")).alias("good_rows"), F.count_if("failed").alias("failed_rows"))
            .select(F.lit(t).alias("table_name"), "*")
            for t in tables
        ]
        return reduce(DataFrame.unionByName, parts)
