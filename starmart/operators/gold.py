"""Gold: the star schema as DataFrames, with the comments the business reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the star, in order.
DIM_CUSTOMER = [
    "customer_id", "customer", "tax_id", "city", "state", "country", "is_company", "is_active",
]
DIM_TERRITORY = ["territory_id", "territory", "manager_id", "manager"]
DIM_SALESPERSON = ["salesperson_id", "salesperson", "email", "is_active"]
DIM_PRODUCT = [
    "product_id", "product", "product_code", "barcode", "category", "list_price", "uom",
    "is_sellable", "is_active",
]
FACT_SALES = [
    "line_id", "order_id", "order_ref", "ordered_at", "sale_date", "sale_year", "sale_month",
    "month_start", "order_status", "currency", "customer_id", "salesperson_id", "territory_id",
    "product_id", "quantity", "quantity_delivered", "unit_price", "discount_pct", "subtotal",
    "total_with_tax",
]
FACT_INVENTORY = ["product_id", "warehouse", "location", "on_hand", "reserved", "available"]
SALES_METRICS = [
    "sale_date", "sale_year", "sale_month", "month_start", "order_status", "currency",
    "customer", "state", "city", "territory", "manager", "salesperson", "product", "category",
    "quantity", "subtotal", "total_with_tax", "order_id",
]


@dataclass(frozen=True)
class Dimension:
    """A dimension table and the key by which facts point at it."""

    table: str
    key: str


@dataclass(frozen=True)
class Reference:
    """A nullable foreign key from a fact to a dimension."""

    name: str
    fact: str
    dimension: Dimension


CUSTOMER = Dimension("dim_customer", "customer_id")
TERRITORY = Dimension("dim_territory", "territory_id")
SALESPERSON = Dimension("dim_salesperson", "salesperson_id")
PRODUCT = Dimension("dim_product", "product_id")

DIMENSIONS = (CUSTOMER, TERRITORY, SALESPERSON, PRODUCT)
REFERENCES = (
    Reference("fk_sales_customer", "fact_sales", CUSTOMER),
    Reference("fk_sales_salesperson", "fact_sales", SALESPERSON),
    Reference("fk_sales_territory", "fact_sales", TERRITORY),
    Reference("fk_sales_product", "fact_sales", PRODUCT),
    Reference("fk_inventory_product", "fact_inventory", PRODUCT),
)

FACT_PARTITIONS = ["sale_year", "sale_month"]

# Comments are metadata that people and question-answering tools search by, in Spanish.
TABLE_COMMENTS = {
    "dim_customer": "Un renglón por cliente, con su ubicación: ciudad, departamento y país.",
    "dim_territory": "Zonas comerciales (equipos de ventas) y el gerente a cargo de cada una.",
    "dim_salesperson": "Personas que venden, con su correo.",
    "dim_product": "Productos con categoría, unidad de medida y precio de lista.",
    "fact_sales": "Detalle de ventas, una fila por línea de pedido. Venta es solo el estado "
    "'sale'; el monto por defecto es subtotal.",
    "fact_inventory": "Foto actual de existencias por producto, almacén y ubicación interna.",
    "sales_metrics": "Ventas con todas las dimensiones unidas, para preguntas de negocio.",
}
COLUMN_COMMENTS = {
    "dim_customer": {
        "customer": "Nombre del cliente.",
        "state": "Departamento del cliente (geografía); no es el estado del pedido.",
        "tax_id": "RTN, identificador fiscal del cliente.",
    },
    "dim_territory": {
        "territory": "Nombre de la zona comercial.",
        "manager": "Gerente a cargo de la zona; sirve para ventas por gerente.",
    },
    "dim_salesperson": {"salesperson": "Nombre del vendedor."},
    "dim_product": {
        "product": "Nombre del producto.",
        "category": "Categoría a la que pertenece el producto.",
    },
    "fact_sales": {
        "subtotal": "Monto de la línea con descuento y sin impuesto; sumado es la venta.",
        "order_status": "Estado del pedido: draft es cotización, sent enviada, sale confirmado, "
        "cancel cancelado.",
        "quantity_delivered": "Cantidad entregada; quantity menos esta es lo pendiente.",
        "currency": "Moneda del pedido; no se suman monedas distintas sin avisar.",
        "sale_date": "Día del pedido.",
    },
    "fact_inventory": {"available": "Existencia libre: en mano menos reservada."},
}


def described(df: DataFrame, table: str) -> DataFrame:
    """Attach the column comments, which a saved table keeps in the catalog."""
    for column, comment in COLUMN_COMMENTS.get(table, {}).items():
        if column in df.columns:
            df = df.withMetadata(column, {"comment": comment})
    return df


def dimension(view: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return described(view.select(*columns), table)


def fact_headers(orders: DataFrame) -> DataFrame:
    """Order headers with the date and its parts, as the fact has them."""
    at = F.col("ordered_at")
    return orders.select(
        "order_id",
        "order_ref",
        "ordered_at",
        F.to_date(at).alias("sale_date"),
        F.year(at).alias("sale_year"),
        F.month(at).alias("sale_month"),
        F.date_trunc("month", at).alias("month_start"),
        "order_status",
        "currency",
        "customer_id",
        "salesperson_id",
        "territory_id",
    )


def fact_sales(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """G5. One row per order line; lines of orders that Silver left out disappear."""
    return described(lines.join(fact_headers(orders), "order_id").select(*FACT_SALES), "fact_sales")


def fact_inventory(inventory: DataFrame) -> DataFrame:
    """G6. Current stock; the view has no date."""
    return described(inventory.select(*FACT_INVENTORY), "fact_inventory")


def sales_metrics(
    fact: DataFrame,
    customer: DataFrame,
    territory: DataFrame,
    salesperson: DataFrame,
    product: DataFrame,
) -> DataFrame:
    """G7. Row-level sales with every dimension joined.

    For aggregates use :mod:`starmart.plans.metrics`, which joins only what a question
    names: Spark keeps an unused left join, because it cannot know that keys are unique.
    """
    customers = customer.select("customer_id", "customer", "state", "city")
    return (
        fact.join(customers, "customer_id", "left")
        .join(territory.select("territory_id", "territory", "manager"), "territory_id", "left")
        .join(salesperson.select("salesperson_id", "salesperson"), "salesperson_id", "left")
        .join(product.select("product_id", "product", "category"), "product_id", "left")
        .select(*SALES_METRICS)
    )


def sales_metrics_by_order(
    lines: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    territory: DataFrame,
    salesperson: DataFrame,
    product: DataFrame,
) -> DataFrame:
    """G7 from Silver: the same rows, each name joined at the grain it belongs to.

    Customers, zones and sellers are joined to orders and products to lines, so that a line is
    moved twice, and without the names of its order. On the written fact, where orders are
    lines already, each large dimension moves all that was joined before.
    """
    named = (
        fact_headers(orders)
        .join(customer.select("customer_id", "customer", "state", "city"), "customer_id", "left")
        .join(territory.select("territory_id", "territory", "manager"), "territory_id", "left")
        .join(salesperson.select("salesperson_id", "salesperson"), "salesperson_id", "left")
        .drop("customer_id", "territory_id", "salesperson_id", "order_ref", "ordered_at")
    )
    sold = lines.select("order_id", "product_id", "quantity", "subtotal", "total_with_tax").join(
        product.select("product_id", "product", "category"), "product_id", "left"
    )
    return described(sold.join(named, "order_id").select(*SALES_METRICS), "fact_sales")
