"""Silver: Bronze text typed, cleaned and joined into seven views (V1-V7).

The functions return a view before its expectations; :class:`starmart.plans.mart.Mart`
applies them. Bronze ids join as text and are cast on projection. Names that need parsing
are resolved in the small or narrow table before a join, not once per joined row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.config import DISCOUNT, MONEY, QUANTITY, UNIT_PRICE, MartConfig
from starmart.functions.numbers import typed
from starmart.functions.text import txt


def _localised(table: DataFrame, column: str, alias: str, locales: Sequence[str]) -> DataFrame:
    """Id of a lookup table with one resolved name."""
    return table.select(F.col("id").alias(f"{alias}_id"), txt(column, locales).alias(alias))


def _companies(companies: DataFrame, currencies: DataFrame, currency: str) -> DataFrame:
    """Ids of the companies that keep their books in ``currency``."""
    books = currencies.filter(F.col("name") == currency).select(F.col("id").alias("currency_id"))
    return companies.join(books, "currency_id").select(F.col("id").alias("company_id"))


def salespeople(users: DataFrame, partners: DataFrame, cfg: MartConfig) -> DataFrame:
    """V1. A user has no name of its own; it is the name of its partner.

    Partners are cut down to those that are users first. While the user ids are few enough
    to broadcast, the partner table is then not shuffled, which a left join alone would do.
    """
    strict = cfg.strict_casts
    referenced = users.select(F.col("partner_id").alias("id"))
    named = partners.select("id", "name").join(referenced, "id", "left_semi")
    return users.join(
        named.select(F.col("id").alias("partner_id"), F.col("name").alias("salesperson")),
        "partner_id",
        "left",
    ).select(
        typed("id", "bigint", strict).alias("salesperson_id"),
        "salesperson",
        F.col("login").alias("email"),
        typed("active", "boolean", strict).alias("is_active"),
    )


def territories(teams: DataFrame, salespeople_view: DataFrame, cfg: MartConfig) -> DataFrame:
    """V2. Sales team with its manager's name, read from the salespeople view."""
    managers = salespeople_view.select(
        F.col("salesperson_id").alias("manager_id"), F.col("salesperson").alias("manager")
    )
    return (
        teams.select(
            typed("id", "bigint", cfg.strict_casts).alias("territory_id"),
            txt("name", cfg.locales).alias("territory"),
            typed("user_id", "bigint", cfg.strict_casts).alias("manager_id"),
        )
        .join(managers, "manager_id", "left")
        .select("territory_id", "territory", "manager_id", "manager")
    )


def customers(
    partners: DataFrame, states: DataFrame, countries: DataFrame, cfg: MartConfig
) -> DataFrame:
    """V3. Every partner with its geography; nothing filters out users or suppliers."""
    strict = cfg.strict_casts
    return (
        partners.join(
            states.select(F.col("id").alias("state_id"), F.col("name").alias("state")),
            "state_id",
            "left",
        )
        .join(_localised(countries, "name", "country", cfg.locales), "country_id", "left")
        .select(
            typed("id", "bigint", strict).alias("customer_id"),
            F.col("name").alias("customer"),
            F.col("vat").alias("tax_id"),
            "city",
            "state",
            "country",
            typed("is_company", "boolean", strict).alias("is_company"),
            typed("customer_rank", "int", strict).alias("customer_rank"),
            typed("active", "boolean", strict).alias("is_active"),
        )
    )


def products(
    variants: DataFrame,
    templates: DataFrame,
    categories: DataFrame,
    units: DataFrame,
    cfg: MartConfig,
) -> DataFrame:
    """V4. Variants named, priced and flagged by their template; no template, no product."""
    strict = cfg.strict_casts
    category_names = _localised(categories, "complete_name", "category", cfg.locales)
    described = (
        templates.select(
            F.col("id").alias("product_tmpl_id"),
            txt("name", cfg.locales).alias("product"),
            typed("list_price", UNIT_PRICE, strict).alias("list_price"),
            typed("sale_ok", "boolean", strict).alias("is_sellable"),
            typed("active", "boolean", strict).alias("is_active"),
            F.col("categ_id").alias("category_id"),
            "uom_id",
        )
        .join(category_names, "category_id", "left")
        .join(_localised(units, "name", "uom", cfg.locales), "uom_id", "left")
    )
    return (
        variants.select("id", "product_tmpl_id", "default_code", "barcode")
        .join(described, "product_tmpl_id")
        .select(
            typed("id", "bigint", strict).alias("product_id"),
            "product",
            F.col("default_code").alias("product_code"),
            "barcode",
            "category",
            "list_price",
            "uom",
            "is_sellable",
            "is_active",
        )
    )


def orders(
    headers: DataFrame, currencies: DataFrame, companies: DataFrame, cfg: MartConfig
) -> DataFrame:
    """V5. Order headers of the companies that keep their books in ``cfg.currency``.

    The filter is on the company, not on the order: its orders in other currencies stay.
    """
    strict = cfg.strict_casts
    names = currencies.select(F.col("id").alias("currency_id"), F.col("name").alias("currency"))
    return (
        headers.join(_companies(companies, currencies, cfg.currency), "company_id")
        .join(names, "currency_id", "left")
        .select(
            typed("id", "bigint", strict).alias("order_id"),
            F.col("name").alias("order_ref"),
            F.col("client_order_ref").alias("external_ref"),
            typed("partner_id", "bigint", strict).alias("customer_id"),
            typed("user_id", "bigint", strict).alias("salesperson_id"),
            typed("team_id", "bigint", strict).alias("territory_id"),
            typed("date_order", "timestamp", strict).alias("ordered_at"),
            F.col("state").alias("order_status"),
            "currency",
            typed("amount_untaxed", MONEY, strict).alias("amount_untaxed"),
            typed("amount_tax", MONEY, strict).alias("tax_amount"),
            typed("amount_total", MONEY, strict).alias("amount_total"),
        )
    )


def order_lines(lines: DataFrame, cfg: MartConfig) -> DataFrame:
    """V6. Product lines only; section and note rows carry a display type (F1)."""
    strict = cfg.strict_casts
    return lines.filter(F.coalesce("display_type", F.lit("")) == "").select(
        typed("id", "bigint", strict).alias("line_id"),
        typed("order_id", "bigint", strict).alias("order_id"),
        typed("product_id", "bigint", strict).alias("product_id"),
        typed("product_uom_qty", QUANTITY, strict).alias("quantity"),
        typed("qty_delivered", QUANTITY, strict).alias("quantity_delivered"),
        typed("price_unit", UNIT_PRICE, strict).alias("unit_price"),
        typed("discount", DISCOUNT, strict).alias("discount_pct"),
        typed("price_subtotal", MONEY, strict).alias("subtotal"),
        typed("price_total", MONEY, strict).alias("total_with_tax"),
    )


def inventory(
    quants: DataFrame,
    locations: DataFrame,
    warehouses: DataFrame,
    companies: DataFrame,
    currencies: DataFrame,
    cfg: MartConfig,
) -> DataFrame:
    """V7. Stock in internal locations, by product, warehouse name and location name.

    ``available`` adds up row differences, so a row without a reserved quantity counts
    on hand but not as available. Locations of equal name merge.

    Nearly every row is a group of its own, so adding up where rows are read shortens nothing
    and holds all groups of a file, which may be one task's, in memory. Rows are dealt by
    product first, and both halves of the aggregation see one part of the products.
    """
    strict = cfg.strict_casts
    places = (
        locations.filter(F.col("usage") == "internal")
        .select(
            F.col("id").alias("location_id"),
            txt("complete_name", cfg.locales).alias("location"),
            "warehouse_id",
        )
        .join(_localised(warehouses, "name", "warehouse", cfg.locales), "warehouse_id", "left")
        .select("location_id", "warehouse", "location")
    )
    stocked = typed("quantity", QUANTITY, strict)
    held = typed("reserved_quantity", QUANTITY, strict)
    return (
        quants.join(_companies(companies, currencies, cfg.currency), "company_id")
        .join(places, "location_id")
        .select(
            typed("product_id", "bigint", strict).alias("product_id"),
            "warehouse",
            "location",
            stocked.alias("stocked"),
            held.alias("held"),
        )
        .repartition("product_id")
        .groupBy("product_id", "warehouse", "location")
        .agg(
            F.sum("stocked").alias("on_hand"),
            F.sum("held").alias("reserved"),
            F.sum(F.col("stocked") - F.col("held")).alias("available"),
        )
    )
