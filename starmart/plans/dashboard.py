"""Datasets behind the sales dashboard (D1-D6) and the stock lists."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.config import MONEY, QUANTITY
from starmart.functions.numbers import change_pct, ratio, typed
from starmart.operators.assets import confirmed, stockout_risk, top_salespeople
from starmart.plans.mart import Star
from starmart.plans.metrics import Between, compare_periods, months_between_dates
from starmart.plans.ventas import VENTAS


def kpi_month(star: Star, as_of: dt.date | None = None) -> DataFrame:
    """D1. One row for the calendar month of ``as_of``: sales, change against the same
    month a year before, orders and average ticket."""
    day = as_of or star.cfg.as_of or dt.date.today()

    def bounds(year: int) -> tuple[dt.date, dt.date]:
        last = calendar.monthrange(year, day.month)[1]
        return dt.date(year, day.month, 1), dt.date(year, day.month, last)

    now, before = bounds(day.year), bounds(day.year - 1)
    this_month = F.col("sale_date").between(*now)
    rows = confirmed(star).filter(
        (this_month & months_between_dates(*now))
        | (F.col("sale_date").between(*before) & months_between_dates(*before))
    )
    totals = rows.agg(
        F.sum(F.when(this_month, F.col("subtotal"))).alias("sales"),
        F.sum(F.when(~this_month, F.col("subtotal"))).alias("sales_last_year"),
        F.count_distinct(F.when(this_month, F.col("order_id"))).alias("orders"),
    )
    change = change_pct(F.col("sales"), F.col("sales_last_year"))
    return totals.select(
        F.lit(now[0]).alias("month"),
        F.col("sales").cast(MONEY).alias("sales"),
        F.col("sales_last_year").cast(MONEY).alias("sales_last_year"),
        typed(change, "decimal(9,2)", star.cfg.strict_casts).alias("change_pct"),
        "orders",
        ratio(F.col("sales"), F.col("orders")).cast(MONEY).alias("avg_ticket"),
    )


def monthly_two_years(star: Star, year: int) -> DataFrame:
    """D2. Monthly sales of a year over those of the year before."""
    years = {"Anio": [year, year - 1]}
    base = VENTAS.query(star, ["Mes", "Anio"], ["Venta"], where=years, currencies=None)
    return compare_periods(base, "Mes", "Anio", "Venta", year, year - 1)


def sales_by_zone(star: Star, period: Between | None = None) -> DataFrame:
    """D3. Sales by zone with its manager, best first."""
    return VENTAS.query(
        star,
        ["Zona", "Gerente"],
        ["Pedidos", "Venta"],
        where=None if period is None else {"Fecha": period},
        order_by=[("Venta", "desc")],
    )


def sales_by_department(star: Star, period: Between | None = None) -> DataFrame:
    """D4. Sales by customer state, best first."""
    return VENTAS.query(
        star,
        ["Departamento"],
        ["Clientes", "Pedidos", "Venta"],
        where=None if period is None else {"Fecha": period},
        order_by=[("Venta", "desc")],
    )


def seller_ranking(star: Star, p_from: dt.date, p_to: dt.date, p_limit: int = 10) -> DataFrame:
    """D5. The ranking of sellers."""
    return top_salespeople(star, p_from, p_to, p_limit)


def products_at_risk(star: Star, p_days: int = 30) -> DataFrame:
    """D6. Products whose stock may run out."""
    return stockout_risk(star, p_days)


def lowest_stock(star: Star) -> DataFrame:
    """M11. Products by free stock, scarcest first (unknown stock leads)."""
    return (
        star.fact_inventory.select("product_id", "warehouse", "available")
        .join(star.dim_product.select("product_id", "product"), "product_id")
        .select("product", "warehouse", F.col("available").cast(QUANTITY).alias("available"))
        .orderBy("available", "product", "warehouse")
    )


def pending_delivery(star: Star) -> DataFrame:
    """A18. Units sold but not yet delivered, per product; over-delivery does not offset."""
    open_units = F.greatest(
        F.col("quantity") - F.col("quantity_delivered"), F.lit(0).cast("decimal(19,3)")
    )
    return (
        confirmed(star)
        .groupBy("product_id")
        .agg(F.sum(open_units).alias("pending"))
        .join(star.dim_product.select("product_id", "product"), "product_id")
        .select("product_id", "product", F.col("pending").cast(QUANTITY).alias("pending"))
        .filter(F.col("pending") > 0)
    )
