"""The seven business questions as functions of a star.

Each returns a lazy DataFrame with the documented columns and types. The fact is first
aggregated by foreign key and only then joined with dimensions and regrouped by name: the
shuffle carries one row per key and task however many rows a key has. Ties are ordered by
the group keys, so results are reproducible.

``period`` arguments are inclusive at both ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import MONEY, QUANTITY, SALE_STATUS, current_year, today
from starmart.functions.numbers import change_pct, ratio, typed
from starmart.plans.mart import Star
from starmart.plans.metrics import months_between_dates


def confirmed(star: Star) -> DataFrame:
    """Fact rows that count as sales: confirmed orders only."""
    return star.fact_sales.filter(F.col("order_status") == SALE_STATUS)


def _sold(star: Star, p_from: dt.date | None, p_to: dt.date | None) -> DataFrame:
    """Sales of a period; without one, of the star's current year."""
    if p_from is None or p_to is None:
        first, last = current_year(star.cfg.as_of)
        p_from, p_to = p_from or first, p_to or last
    return confirmed(star).filter(
        F.col("sale_date").between(p_from, p_to) & months_between_dates(p_from, p_to)
    )


def _orders() -> Column:
    return F.count_distinct("order_id").alias("orders")


def _sales() -> Column:
    return F.sum("subtotal").alias("sales")


def _total(column: str, data_type: str) -> Column:
    return F.sum(column).cast(data_type).alias(column)


def _count(column: str) -> Column:
    return F.sum(column).cast("bigint").alias(column)


def sales_by_territory(
    star: Star, p_from: dt.date | None = None, p_to: dt.date | None = None
) -> DataFrame:
    """T1. Orders and sales by zone and manager; sales without a zone are left out."""
    by_zone = _sold(star, p_from, p_to).groupBy("territory_id").agg(_orders(), _sales())
    return (
        by_zone.join(star.dim_territory, "territory_id")
        .groupBy("territory", "manager")
        .agg(_count("orders"), _total("sales", MONEY))
        .orderBy(F.desc("sales"), "territory", "manager")
    )


def top_salespeople(
    star: Star,
    p_from: dt.date | None = None,
    p_to: dt.date | None = None,
    p_limit: int = 10,
) -> DataFrame:
    """T2. Best sellers with their average ticket; one row per seller and zone sold in."""
    by_ids = (
        _sold(star, p_from, p_to).groupBy("salesperson_id", "territory_id").agg(_orders(), _sales())
    )
    zones = star.dim_territory.select("territory_id", "territory")
    return (
        by_ids.join(star.dim_salesperson.select("salesperson_id", "salesperson"), "salesperson_id")
        .join(zones, "territory_id", "left")
        .groupBy("salesperson", "territory")
        .agg(_count("orders"), F.sum("sales").cast("decimal(28,2)").alias("sales"))
        .select(
            "salesperson",
            "territory",
            "orders",
            F.col("sales").cast(MONEY).alias("sales"),
            ratio(F.col("sales"), F.col("orders")).cast(MONEY).alias("avg_ticket"),
        )
        .orderBy(F.desc("sales"), "salesperson", "territory")
        .limit(p_limit)
    )


def top_products(
    star: Star,
    p_from: dt.date | None = None,
    p_to: dt.date | None = None,
    p_limit: int = 15,
) -> DataFrame:
    """T3. Best-selling products by amount; products of equal name and category merge."""
    by_product = (
        _sold(star, p_from, p_to)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"), _sales())
    )
    return (
        by_product.join(star.dim_product.select("product_id", "product", "category"), "product_id")
        .groupBy("product", "category")
        .agg(_total("units", QUANTITY), _total("sales", MONEY))
        .orderBy(F.desc("sales"), "product", "category")
        .limit(p_limit)
    )


def sales_year_over_year(star: Star, p_year: int) -> DataFrame:
    """T4. Monthly sales against the year before.

    One aggregation with a conditional sum per year gives what a full outer join of two
    aggregates gives: a month without sales in one year is NULL there, as is its change.
    """
    years = confirmed(star).filter(F.col("sale_year").isin(p_year, p_year - 1))

    def sales_of(year: int) -> Column:
        return F.sum(F.when(F.col("sale_year") == year, F.col("subtotal")))

    current, previous = F.col("sales_current"), F.col("sales_previous")
    strict = star.cfg.strict_casts
    return (
        years.groupBy("sale_month")
        .agg(
            sales_of(p_year).alias("sales_current"), sales_of(p_year - 1).alias("sales_previous")
        )
        .select(
            "sale_month",
            current.cast(MONEY).alias("sales_current"),
            previous.cast(MONEY).alias("sales_previous"),
            typed(change_pct(current, previous), "decimal(9,2)", strict).alias("change_pct"),
        )
        .orderBy("sale_month")
    )


def sales_by_state(
    star: Star, p_from: dt.date | None = None, p_to: dt.date | None = None
) -> DataFrame:
    """T5. Buying customers and sales by customer state; an unknown state is a group."""
    by_customer = _sold(star, p_from, p_to).groupBy("customer_id").agg(_sales())
    return (
        by_customer.join(star.dim_customer.select("customer_id", "state"), "customer_id")
        .groupBy("state")
        .agg(F.count_distinct("customer_id").alias("customers"), _total("sales", MONEY))
        .orderBy(F.desc("sales"), "state")
    )


def stockout_risk(star: Star, p_days: int = 30) -> DataFrame:
    """T6. Stock against recent sales, shortest cover first.

    Demand is per product and repeats on each of its locations. Products without net
    sales in the window are left out. The window has no upper end.
    """
    if p_days <= 0:
        raise ValueError(f"p_days must be positive, not {p_days}")
    since = F.date_sub(today(star.cfg.as_of), p_days)
    recent = (
        confirmed(star)
        .filter((F.col("sale_date") >= since) & months_between_dates(since, None))
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"))
        .filter(F.col("units") > 0)
    )
    # An INT parameter divides as DECIMAL(10,0); a literal would narrow to its own digits.
    per_day = F.col("units") / F.lit(p_days).cast("decimal(10,0)")
    cover = F.col("available") / F.nullif(per_day, F.lit(0).cast("decimal(38,13)"))
    return (
        star.fact_inventory.join(recent, "product_id")
        .join(star.dim_product.select("product_id", "product"), "product_id")
        .select(
            "product",
            "warehouse",
            F.col("available").cast(QUANTITY).alias("available"),
            F.col("units").cast(QUANTITY).alias("sold_in_period"),
            typed(cover, "decimal(9,1)", star.cfg.strict_casts).alias("days_of_cover"),
            "product_id",
            "location",
        )
        .orderBy(
            F.asc_nulls_last("days_of_cover"), "product", "warehouse", "product_id", "location"
        )
        .drop("product_id", "location")
    )


def lapsed_customers(star: Star, p_days: int = 60) -> DataFrame:
    """T7. Customers whose last confirmed order is more than ``p_days`` days ago."""
    by_customer = (
        confirmed(star)
        .groupBy("customer_id")
        .agg(F.max("sale_date").alias("last_order"), F.sum("subtotal").alias("lifetime_sales"))
    )
    named = star.dim_customer.select("customer_id", "customer", "state")
    return (
        by_customer.join(named, "customer_id")
        .groupBy("customer", "state")
        .agg(F.max("last_order").alias("last_order"), _total("lifetime_sales", MONEY))
        .withColumn("days_since_order", F.datediff(today(star.cfg.as_of), "last_order"))
        .filter(F.col("days_since_order") > p_days)
        .select("customer", "state", "last_order", "days_since_order", "lifetime_sales")
        .orderBy(F.desc("lifetime_sales"), "customer", "state")
    )
