"""The sales metric view in the vocabulary of the business (M2, M3, M6-M8)."""

from __future__ import annotations

from starmart.config import SALE_STATUS
from starmart.functions.numbers import ratio
from starmart.operators.gold import CUSTOMER, PRODUCT, SALESPERSON, TERRITORY
from starmart.plans.metrics import (
    Dimension,
    DistinctNames,
    Measure,
    MetricView,
    Orders,
    Total,
)

SALES = Total("subtotal", "decimal(28,2)")
SALES_WITH_TAX = Total("total_with_tax", "decimal(28,2)")
UNITS = Total("quantity", "decimal(28,3)")
ORDERS = Orders()
CUSTOMERS = DistinctNames("customer", CUSTOMER)

LEMPIRAS = {"type": "currency", "currency_code": "HNL"}

# Names and synonyms are the words people use to ask.
VENTAS = MetricView(
    name="ventas",
    filter=f"order_status = '{SALE_STATUS}'",
    comment="Ventas confirmadas con vocabulario de negocio; fuente única de sus definiciones.",
    dimensions=(
        Dimension(
            "Zona", "territory", TERRITORY,
            ("zona comercial", "territorio", "region", "equipo comercial", "equipo de ventas"),
            "Equipo comercial al que pertenece el pedido.", match_values=True,
        ),
        Dimension(
            "Gerente", "manager", TERRITORY,
            ("jefe de zona", "responsable de zona", "jefe comercial"),
            "Persona a cargo de la zona.", match_values=True,
        ),
        Dimension(
            "Vendedor", "salesperson", SALESPERSON,
            ("ejecutivo", "asesor", "ejecutivo de ventas", "representante"),
            "Persona que tomó el pedido.", match_values=True,
        ),
        Dimension(
            "Cliente", "customer", CUSTOMER, ("comprador", "cuenta"), match_values=True,
        ),
        Dimension(
            "Departamento", "state", CUSTOMER,
            ("departamento de Honduras", "region geografica", "provincia"),
            "Geografía del cliente; ni área de la empresa ni estado del pedido.",
            match_values=True,
        ),
        Dimension("Ciudad", "city", CUSTOMER, ("municipio", "localidad"), match_values=True),
        Dimension(
            "Producto", "product", PRODUCT, ("articulo", "item", "sku"),
            within_order=True, match_values=True,
        ),
        Dimension(
            "Categoria", "category", PRODUCT, ("familia", "linea de producto", "rubro"),
            within_order=True, match_values=True,
        ),
        Dimension("Moneda", "currency", synonyms=("divisa",)),
        Dimension("Fecha", "sale_date", synonyms=("fecha del pedido", "dia")),
        Dimension("Anio", "sale_year", synonyms=("año", "ejercicio")),
        Dimension("Mes", "sale_month"),
        Dimension("Mes inicio", "month_start", synonyms=("mes", "periodo mensual")),
    ),
    measures=(
        Measure(
            "Venta", (SALES,), lambda sales: sales,
            ("ventas", "monto vendido", "importe", "facturacion", "ingresos"),
            "Suma de subtotal de pedidos confirmados, sin impuesto.", LEMPIRAS,
        ),
        Measure(
            "Venta con impuesto", (SALES_WITH_TAX,), lambda sales: sales,
            ("venta bruta", "total con impuesto"), format=LEMPIRAS,
        ),
        Measure(
            "Pedidos", (ORDERS,), lambda orders: orders,
            ("ordenes", "cantidad de pedidos", "numero de pedidos"),
            "Pedidos distintos, porque cada línea repite su pedido.",
        ),
        Measure("Unidades", (UNITS,), lambda units: units, ("cantidad", "volumen", "piezas")),
        Measure(
            "Clientes", (CUSTOMERS,), lambda names: names,
            ("cantidad de clientes", "compradores distintos"),
        ),
        Measure(
            "Ticket promedio", (SALES, ORDERS), ratio,
            ("ticket medio", "venta promedio por pedido", "valor promedio"), format=LEMPIRAS,
        ),
    ),
)
