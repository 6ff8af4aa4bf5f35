"""The seven questions as SQL table functions over the registered Gold views.

``SELECT * FROM top_products(DATE'1997-01-01', DATE'1997-12-31', p_limit => 5)`` answers
like the Python function of the same name. Functions and parameters carry Spanish
comments, because tools choose a function by them. A SQL function cannot take its row
limit as a parameter of LIMIT, so rankings number their rows, in two steps: within hashed
parts first, then what each part's first rows leave. The last task sees ``RANK_PARTS`` times
the limit, however many rows there are. Nor may a parameter stand inside an aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from starmart.config import SALE_STATUS
from starmart.plans.mart import Star


@dataclass(frozen=True)
class Parameter:
    name: str
    data_type: str
    comment: str
    default: str | None = None

    def ddl(self) -> str:
        default = f" DEFAULT {self.default}" if self.default else ""
        return f"{self.name} {self.data_type}{default} COMMENT '{self.comment}'"


@dataclass(frozen=True)
class TableFunction:
    name: str
    parameters: tuple[Parameter, ...]
    returns: str
    comment: str
    body: str

    def ddl(self) -> str:
        parameters = ", ".join(p.ddl() for p in self.parameters)
        return (
            f"CREATE OR REPLACE TEMPORARY FUNCTION {self.name}({parameters}) "
            f"RETURNS TABLE ({self.returns}) COMMENT '{self.comment}' RETURN {self.body}"
        )


RANK_PARTS = 64
# Names, parameters, their types and defaults, and columns of the functions below.

FROM = Parameter("p_from", "DATE", "Primer día del período, incluido; para un mes, su día 1")
TO = Parameter("p_to", "DATE", "Último día del período, incluido; para un mes, su último día")
SOLD = (
    f"order_status = '{SALE_STATUS}' AND sale_date BETWEEN p_from AND p_to "
    "AND sale_year * 12 + sale_month BETWEEN year(p_from) * 12 + month(p_from) "
    "AND year(p_to) * 12 + month(p_to)"
)


def table_functions(today: str = "current_date()") -> tuple[TableFunction, ...]:
    """Definitions; ``today`` is the SQL expression of the reference date."""
    return (
        TableFunction(
            "sales_by_territory",
            (FROM, TO),
            "territory STRING, manager STRING, orders BIGINT, sales DECIMAL(18,2)",
            "Ventas y pedidos por zona comercial y gerente en un período. Úsala cuando pregunten por "
            "zonas, territorios o gerentes; para la geografía del cliente, sales_by_state",
            f"""
            WITH zone AS (
              SELECT territory_id, count(DISTINCT order_id) AS n, sum(subtotal) AS amount
              FROM fact_sales WHERE {SOLD} GROUP BY territory_id)
            SELECT territory, manager, sum(n) AS orders, sum(amount) AS sales
            FROM zone JOIN dim_territory USING (territory_id)
            GROUP BY territory, manager ORDER BY sales DESC, territory, manager""",
        ),
        TableFunction(
            "top_salespeople",
            (FROM, TO, Parameter("p_limit", "INT", "Cuántos vendedores devolver; sin pedirlo, 10", "10")),
            "salesperson STRING, territory STRING, orders BIGINT, sales DECIMAL(18,2), "
            "avg_ticket DECIMAL(18,2)",
            "Mejores vendedores por monto en un período, con zona y ticket promedio. Úsala cuando "
            "pregunten quién vendió más o por el desempeño de los vendedores",
            f"""
            WITH seller AS (
              SELECT salesperson_id, territory_id,
                     count(DISTINCT order_id) AS n, sum(subtotal) AS amount
              FROM fact_sales WHERE {SOLD} GROUP BY salesperson_id, territory_id),
            named AS (
              SELECT salesperson, territory, CAST(sum(n) AS BIGINT) AS n,
                     CAST(sum(amount) AS DECIMAL(28,2)) AS amount
              FROM seller JOIN dim_salesperson USING (salesperson_id)
              LEFT JOIN dim_territory USING (territory_id)
              GROUP BY salesperson, territory),
            dealt AS (
              SELECT *, row_number() OVER (
                PARTITION BY pmod(hash(salesperson, territory), {RANK_PARTS})
                ORDER BY amount DESC, salesperson, territory) AS near
              FROM named),
            ranked AS (
              SELECT *, row_number() OVER (ORDER BY amount DESC, salesperson, territory) AS place
              FROM dealt WHERE near <= p_limit)
            SELECT salesperson, territory, n AS orders, amount AS sales,
                   CAST(amount / nullif(n, 0) AS DECIMAL(18,2)) AS avg_ticket
            FROM ranked WHERE place <= p_limit ORDER BY place""",
        ),
        TableFunction(
            "top_products",
            (FROM, TO, Parameter("p_limit", "INT", "Cuántos productos devolver; sin pedirlo, 15", "15")),
            "product STRING, category STRING, units DECIMAL(18,3), sales DECIMAL(18,2)",
            "Productos de mayor venta en un período, con unidades y categoría. Úsala para lo más "
            "vendido; para lo que queda en bodega, stockout_risk",
            f"""
            WITH item AS (
              SELECT product_id, sum(quantity) AS pieces, sum(subtotal) AS amount
              FROM fact_sales WHERE {SOLD} GROUP BY product_id),
            named AS (
              SELECT product, category, sum(pieces) AS pieces, sum(amount) AS amount
              FROM item JOIN dim_product USING (product_id) GROUP BY product, category),
            dealt AS (
              SELECT *, row_number() OVER (
                PARTITION BY pmod(hash(product, category), {RANK_PARTS})
                ORDER BY amount DESC, product, category) AS near
              FROM named),
            ranked AS (
              SELECT *, row_number() OVER (ORDER BY amount DESC, product, category) AS place
              FROM dealt WHERE near <= p_limit)
            SELECT product, category, pieces AS units, amount AS sales
            FROM ranked WHERE place <= p_limit ORDER BY place""",
        ),
        TableFunction(
            "sales_year_over_year",
            (Parameter("p_year", "INT", "Año que se compara con el anterior, en cuatro cifras"),),
            "sale_month INT, sales_current DECIMAL(18,2), sales_previous DECIMAL(18,2), "
            "change_pct DECIMAL(9,2)",
            "Ventas por mes de un año contra el año anterior y su variación porcentual. Úsala cuando "
            "pregunten por crecimiento o comparen años",
            f"""
            WITH rows AS (
              SELECT sale_month, if(sale_year = p_year, subtotal, NULL) AS this_year,
                     if(sale_year < p_year, subtotal, NULL) AS last_year
              FROM fact_sales
              WHERE order_status = '{SALE_STATUS}' AND sale_year IN (p_year, p_year - 1)),
            months AS (
              SELECT sale_month, sum(this_year) AS now, sum(last_year) AS before
              FROM rows GROUP BY sale_month)
            SELECT sale_month, now AS sales_current, before AS sales_previous,
                   CAST(100.0 * (now - before) / nullif(before, 0) AS DECIMAL(9,2)) AS change_pct
            FROM months ORDER BY sale_month""",
        ),
        TableFunction(
            "sales_by_state",
            (FROM, TO),
            "state STRING, customers BIGINT, sales DECIMAL(18,2)",
            "Ventas por departamento del cliente y número de clientes que compraron. Úsala para la "
            "geografía; departamento no es un área de la empresa",
            f"""
            WITH buyer AS (
              SELECT customer_id, sum(subtotal) AS amount
              FROM fact_sales WHERE {SOLD} GROUP BY customer_id)
            SELECT state, count(DISTINCT customer_id) AS customers, sum(amount) AS sales
            FROM buyer JOIN dim_customer USING (customer_id)
            GROUP BY state ORDER BY sales DESC, state""",
        ),
        TableFunction(
            "stockout_risk",
            (Parameter("p_days", "INT", "Días de venta reciente con que se mide la demanda; sin pedirlo, 30", "30"),),
            "product STRING, warehouse STRING, available DECIMAL(18,3), "
            "sold_in_period DECIMAL(18,3), days_of_cover DECIMAL(9,1)",
            "Productos con poca existencia frente a su venta reciente, con días de cobertura. Úsala "
            "cuando pregunten qué se va a agotar o qué reponer",
            f"""
            WITH recent AS (
              SELECT product_id, sum(quantity) AS pieces
              FROM fact_sales
              WHERE order_status = '{SALE_STATUS}' AND sale_date >= date_sub({today}, p_days)
                AND sale_year * 12 + sale_month >=
                    year(date_sub({today}, p_days)) * 12 + month(date_sub({today}, p_days))
              GROUP BY product_id HAVING sum(quantity) > 0)
            SELECT product, warehouse, available, pieces AS sold_in_period,
                   CAST(available / nullif(pieces / p_days, 0) AS DECIMAL(9,1)) AS days_of_cover
            FROM fact_inventory JOIN recent USING (product_id) JOIN dim_product USING (product_id)
            ORDER BY days_of_cover ASC NULLS LAST, product, warehouse""",
        ),
        TableFunction(
            "lapsed_customers",
            (Parameter("p_days", "INT", "Días sin comprar a partir de los que un cliente cuenta; sin pedirlo, 60", "60"),),
            "customer STRING, state STRING, last_order DATE, days_since_order INT, "
            "lifetime_sales DECIMAL(18,2)",
            "Clientes que dejaron de comprar hace más de N días. Úsala para clientes inactivos o por "
            "recuperar",
            f"""
            WITH buyer AS (
              SELECT customer_id, max(sale_date) AS latest, sum(subtotal) AS amount
              FROM fact_sales WHERE order_status = '{SALE_STATUS}' GROUP BY customer_id),
            named AS (
              SELECT customer, state, max(latest) AS latest, sum(amount) AS amount
              FROM buyer JOIN dim_customer USING (customer_id) GROUP BY customer, state)
            SELECT customer, state, latest AS last_order,
                   datediff({today}, latest) AS days_since_order, amount AS lifetime_sales
            FROM named WHERE datediff({today}, latest) > p_days
            ORDER BY lifetime_sales DESC, customer, state""",
        ),
    )


def register(spark: SparkSession, star: Star) -> None:
    """Register the Gold views of ``star`` and the table functions over them."""
    star.register_views()
    as_of = star.cfg.as_of
    today = "current_date()" if as_of is None else f"DATE'{as_of.isoformat()}'"
    for function in table_functions(today):
        spark.sql(function.ddl())
