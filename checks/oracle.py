"""Plain SQL that answers each registered query from the given tables alone.

The common table expressions build the layers anew, typed from the start, so a mistake in
the text round trip, a cast or a join on the Spark side shows up as a difference. Ratios
are computed on integer cents, because the SQL engine divides decimals as doubles.
"""

from __future__ import annotations

#: The id of an order line as text, see the source's rule.
LINE_ID = """CAST(CAST('0x' || substr(md5(concat_ws('|', l_orderkey,
  l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,3)),
  CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_discount AS DECIMAL(4,2)),
  CAST(l_tax AS DECIMAL(4,2)), l_returnflag, l_linestatus, CAST(l_shipdate AS DATE))), 1, 15)
  AS BIGINT) AS VARCHAR)"""

LAYERS = """
WITH b_order AS (
  SELECT o_orderkey AS id, 'S' || o_orderkey AS name,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS client_order_ref,
    o_custkey AS partner_id, (o_orderkey // 10) % 10 AS user_id,
    CASE WHEN o_orderkey % 50 <> 7 THEN o_custkey % 5 END AS team_id,
    o_orderdate AS date_order,
    CASE WHEN o_orderkey % 997 = 0 THEN 'locked' WHEN o_orderstatus = 'F' THEN 'sale'
         WHEN o_orderstatus = 'O' THEN 'draft' WHEN o_orderkey % 4 = 0 THEN 'cancel'
         WHEN o_orderkey % 4 = 1 THEN 'sent' WHEN o_orderkey % 4 = 2 THEN 'done'
         ELSE 'sale' END AS state,
    CASE WHEN o_orderkey % 100 = 5 THEN 2 ELSE 1 END AS currency_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount_untaxed,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.15' AS DECIMAL(3,2)) AS DECIMAL(18,2))
      AS amount_tax,
    CASE WHEN o_orderkey % 1000 = 500 THEN NULL WHEN o_orderkey % 10 = 9 THEN 2 ELSE 1 END
      AS company_id
  FROM orders),
b_order_text AS (
  SELECT CAST(id AS VARCHAR) AS id, name, client_order_ref,
    CAST(partner_id AS VARCHAR) AS partner_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(team_id AS VARCHAR) AS team_id,
    strftime(date_order, '%Y-%m-%d %H:%M:%S') AS date_order, state,
    CAST(currency_id AS VARCHAR) AS currency_id,
    CAST(amount_untaxed AS VARCHAR) AS amount_untaxed, CAST(amount_tax AS VARCHAR) AS amount_tax,
    CAST(CAST(amount_untaxed + amount_tax AS DECIMAL(18,2)) AS VARCHAR) AS amount_total,
    CAST(company_id AS VARCHAR) AS company_id
  FROM b_order),
s_order AS (
  SELECT id AS order_id, name AS order_ref, client_order_ref AS external_ref,
    partner_id AS customer_id, CAST(user_id AS BIGINT) AS salesperson_id,
    CAST(team_id AS BIGINT) AS territory_id, CAST(date_order AS TIMESTAMP) AS ordered_at,
    state AS order_status, CASE currency_id WHEN 1 THEN 'HNL' ELSE 'USD' END AS currency,
    amount_untaxed, amount_tax AS tax_amount,
    CAST(amount_untaxed + amount_tax AS DECIMAL(18,2)) AS amount_total,
    CASE company_id WHEN 1 THEN 'HNL' ELSE 'USD' END AS tenant
  FROM b_order WHERE company_id IS NOT NULL),
silver_orders AS (SELECT * EXCLUDE (tenant) FROM s_order WHERE tenant = 'HNL'),
priced AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                 * (CAST(1 AS DECIMAL(1,0)) - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,2)) AS net
  FROM lineitem),
silver_order_lines AS (
  SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(l_quantity AS DECIMAL(18,3)), CAST(l_extendedprice AS DECIMAL(18,2)),
      CAST(l_discount AS DECIMAL(4,2)), CAST(l_tax AS DECIMAL(4,2)), l_returnflag, l_linestatus,
      CAST(l_shipdate AS DATE))), 1, 15) AS BIGINT) AS line_id,
    l_orderkey AS order_id, l_partkey AS product_id,
    CAST(l_quantity AS DECIMAL(18,3)) AS quantity,
    CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS DECIMAL(18,3))
      AS quantity_delivered,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(9,4)) AS discount_pct,
    net AS subtotal,
    CAST(net * (CAST(1 AS DECIMAL(1,0)) + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2))
      AS total_with_tax
  FROM priced WHERE l_linenumber <> 7),
silver_salespeople AS (
  SELECT s_suppkey AS salesperson_id, CASE WHEN s_suppkey % 10 <> 3 THEN s_name END AS salesperson,
    'user' || s_suppkey || '@example.com' AS email, s_suppkey % 7 <> 6 AS is_active
  FROM supplier),
silver_territories AS (
  SELECT CAST(r_regionkey AS BIGINT) AS territory_id,
    CASE WHEN r_regionkey IN (0, 1) THEN 'Zona ' || r_name WHEN r_regionkey IN (2, 3) THEN r_name
         ELSE '{"fr_FR":"' || r_name || '"}' END AS territory,
    CAST(r_regionkey AS BIGINT) AS manager_id, salesperson AS manager
  FROM region LEFT JOIN silver_salespeople ON salesperson_id = r_regionkey),
party AS (
  SELECT c_custkey AS customer_id, c_name AS customer, 'RTN' || c_custkey AS tax_id,
    c_mktsegment AS city, c_nationkey AS nation_id, c_custkey % 2 = 0 AS is_company,
    1 AS customer_rank, c_custkey % 10 <> 9 AS is_active FROM customer
  UNION ALL
  SELECT -1 - s_suppkey, s_name, NULL, NULL, s_nationkey, FALSE, 0, TRUE FROM supplier),
silver_customers AS (
  SELECT customer_id, customer, tax_id, city, n_name AS state,
    CASE WHEN n_nationkey <> 24 THEN 'País ' || r_name END AS country,
    is_company, customer_rank, is_active
  FROM party LEFT JOIN nation ON n_nationkey = nation_id
  LEFT JOIN region ON r_regionkey = n_regionkey),
silver_products AS (
  SELECT p_partkey AS product_id, p_name AS product, 'P' || p_partkey AS product_code,
    CASE WHEN p_partkey % 4 <> 0 THEN '750' || p_partkey END AS barcode,
    'Todo / ' || p_brand AS category,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS list_price,
    'Unidades' AS uom, p_partkey % 11 <> 10 AS is_sellable, p_partkey % 9 <> 8 AS is_active
  FROM part),
quant AS (
  SELECT p_partkey AS product_id, place,
    CASE WHEN place < 3 THEN 'Almacén central' END AS warehouse,
    CASE WHEN place < 3 THEN 'WH/Stock' ELSE 'Tránsito' END AS location,
    CAST(p_size * place AS DECIMAL(18,3)) AS quantity,
    CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size // 2 AS DECIMAL(18,3)) END AS reserved
  FROM part, (VALUES (1), (2), (3)) AS places(place) WHERE p_partkey % 7 <> 0),
silver_inventory AS (
  SELECT product_id, warehouse, location, CAST(sum(quantity) AS DECIMAL(28,3)) AS on_hand,
    CAST(sum(reserved) AS DECIMAL(28,3)) AS reserved,
    CAST(sum(quantity - reserved) AS DECIMAL(29,3)) AS available
  FROM quant GROUP BY product_id, warehouse, location),
dim_customer AS (SELECT * EXCLUDE (customer_rank) FROM silver_customers),
dim_territory AS (SELECT * FROM silver_territories),
dim_salesperson AS (SELECT * FROM silver_salespeople),
dim_product AS (SELECT * FROM silver_products),
all_sales AS (
  SELECT tenant, line_id, o.order_id, order_ref, ordered_at, CAST(ordered_at AS DATE) AS sale_date,
    CAST(year(ordered_at) AS INTEGER) AS sale_year,
    CAST(month(ordered_at) AS INTEGER) AS sale_month,
    CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS month_start, order_status, currency,
    customer_id, salesperson_id, territory_id, product_id, quantity, quantity_delivered,
    unit_price, discount_pct, subtotal, total_with_tax
  FROM silver_order_lines l JOIN s_order o ON o.order_id = l.order_id),
fact_sales AS (SELECT * EXCLUDE (tenant) FROM all_sales WHERE tenant = 'HNL'),
fact_inventory AS (SELECT * FROM silver_inventory),
sales_metrics AS (
  SELECT sale_date, sale_year, sale_month, month_start, order_status, currency, customer, state,
    city, territory, manager, salesperson, product, category, quantity, subtotal,
    total_with_tax, order_id
  FROM fact_sales LEFT JOIN dim_customer USING (customer_id)
  LEFT JOIN dim_territory USING (territory_id)
  LEFT JOIN dim_salesperson USING (salesperson_id) LEFT JOIN dim_product USING (product_id)),
sold AS (SELECT * FROM fact_sales WHERE order_status = 'sale'),
sold_97 AS (SELECT * FROM sold WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'),
ventas AS (SELECT * FROM sales_metrics WHERE order_status = 'sale'),
ventas_97 AS (SELECT * FROM ventas WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')
"""

# The rule by which constant parts of the contract are compared: table, columns.
CONTRACT = """contract(table_name, contract_columns) AS (VALUES
  ('sale_order', 13), ('sale_order_line', 10), ('res_partner', 9), ('res_users', 4),
  ('res_company', 3), ('res_country', 2), ('res_country_state', 4), ('res_currency', 2),
  ('crm_team', 3), ('product_product', 5), ('product_template', 7), ('product_category', 2),
  ('product_pricelist', 3), ('uom_uom', 2), ('stock_quant', 6), ('stock_location', 4),
  ('stock_warehouse', 3))"""

SIZES = """sizes(table_name, n) AS (
  SELECT 'sale_order', count(*) FROM orders UNION ALL
  SELECT 'sale_order_line', count(*) FROM lineitem UNION ALL
  SELECT 'res_partner', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) UNION ALL
  SELECT 'res_users', count(*) FROM supplier UNION ALL
  SELECT 'res_company', 2 UNION ALL
  SELECT 'res_country', count(*) FROM region UNION ALL
  SELECT 'res_country_state', count(*) FROM nation UNION ALL
  SELECT 'res_currency', 2 UNION ALL
  SELECT 'crm_team', count(*) FROM region UNION ALL
  SELECT 'product_product', count(*) FROM part UNION ALL
  SELECT 'product_template', count(*) FROM part UNION ALL
  SELECT 'product_category', count(DISTINCT p_brand) FROM part UNION ALL
  SELECT 'product_pricelist', 1 UNION ALL
  SELECT 'uom_uom', 1 UNION ALL
  SELECT 'stock_quant', 5 * count(*) FROM part UNION ALL
  SELECT 'stock_location', 5 UNION ALL
  SELECT 'stock_warehouse', 1)"""

ORDER_COLUMNS = (
    "id, name, client_order_ref, partner_id, user_id, team_id, date_order, state, currency_id, "
    "amount_untaxed, amount_tax, amount_total, company_id"
)


def _cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def _half_up(numerator: str, denominator: str, scale: int, kind: str) -> str:
    """``numerator / denominator`` of integers, rounded half away from zero to ``scale`` digits."""
    whole = f"(2 * abs({numerator}) * {10**scale} + {denominator}) // (2 * {denominator})"
    return (
        f"CASE WHEN {denominator} > 0 THEN "
        f"CAST(sign({numerator}) * CAST({whole} AS DECIMAL(18,0)) / {10**scale} AS {kind}) END"
    )


def _ticket(amount: str, orders: str) -> str:
    """Amount per order with two digits; cents already carry them."""
    whole = f"(2 * {_cents(amount)} + {orders}) // (2 * {orders})"
    return (
        f"CASE WHEN {orders} > 0 THEN "
        f"CAST(CAST({whole} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) END"
    )


def _change(current: str, previous: str, scale: int, kind: str) -> str:
    now, before = _cents(current), _cents(previous)
    return _half_up(f"(100 * ({now} - {before}))", before, scale, kind)


def _layered(select: str, *ctes: str) -> str:
    extra = "".join(f",\n{cte}" for cte in ctes)
    return f"{LAYERS.strip()}{extra}\n{select.strip()}"


def _view(name: str) -> str:
    return _layered(f"SELECT * FROM {name}")


MONEY = "DECIMAL(18,2)"
SUM_SALES = f"CAST(sum(subtotal) AS {MONEY})"
TICKET = _ticket("sum(subtotal)", "count(DISTINCT order_id)")

EVENTS = """events AS (
  SELECT CAST(id AS BIGINT) AS k, CAST(id AS BIGINT) AS key, 'U' AS op, 10 * k + 1 AS lsn,
         'draft' AS new_state FROM b_order_text WHERE k % 4 = 0 UNION ALL
  SELECT CAST(id AS BIGINT) AS k, k, 'U', 1000000000000 + 10 * k + 2, 'sale'
  FROM b_order_text WHERE k % 3 = 0 UNION ALL
  SELECT CAST(id AS BIGINT) AS k, k, 'D', 1000000000000 + 10 * k + 3, NULL
  FROM b_order_text WHERE k % 7 = 0 UNION ALL
  SELECT CAST(id AS BIGINT) AS k, k, 'I', 1000000000000 + 10 * k + 4, 'draft'
  FROM b_order_text WHERE k % 21 = 0 UNION ALL
  SELECT CAST(id AS BIGINT) AS k, -1 - k, 'I', 1000000000000 + 10 * k + 5, state
  FROM b_order_text WHERE k % 11 = 0),
history AS (
  SELECT k, key, op, lsn, new_state FROM events WHERE lsn > 1000000000000 UNION ALL
  SELECT k, key, op, lsn, new_state FROM events WHERE lsn > 1000000000000 AND k % 5 = 0 UNION ALL
  SELECT CAST(id AS BIGINT), CAST(id AS BIGINT), 'I', 1000000000000, state FROM b_order_text),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY lsn DESC) AS rn FROM history),
final AS (
  SELECT CAST(key AS VARCHAR) AS id, name, client_order_ref, partner_id, user_id, team_id,
    date_order, new_state AS state, currency_id, amount_untaxed, amount_tax, amount_total,
    company_id
  FROM ranked JOIN b_order_text b ON b.id = CAST(k AS VARCHAR) WHERE rn = 1 AND op <> 'D')"""

VALUES = """entities AS (
  SELECT DISTINCT dimension, value FROM (
    SELECT 'Zona' AS dimension, territory AS value FROM ventas UNION ALL
    SELECT 'Gerente', manager FROM ventas UNION ALL
    SELECT 'Vendedor', salesperson FROM ventas UNION ALL
    SELECT 'Cliente', customer FROM ventas UNION ALL
    SELECT 'Departamento', state FROM ventas UNION ALL
    SELECT 'Ciudad', city FROM ventas UNION ALL
    SELECT 'Producto', product FROM ventas UNION ALL
    SELECT 'Categoria', category FROM ventas UNION ALL
    SELECT 'warehouse', warehouse FROM fact_inventory) AS v
  WHERE value IS NOT NULL)"""


def _faulty(name: str, key: str, missing: bool) -> str:
    """Rows with the planted faults: missing, twice, and again without their key."""
    gone = f" WHERE {key} % 10 <> 2" if missing else ""
    return (
        f"(SELECT * FROM {name}{gone} UNION ALL SELECT * FROM {name} WHERE {key} % 10 = 4 "
        f"UNION ALL SELECT * REPLACE (NULL AS {key}) FROM {name} WHERE {key} % 10 = 3)"
    )


FAULTY = f"""faulty_silver_salespeople AS {_faulty("silver_salespeople", "salesperson_id", True)},
faulty_silver_territories AS (
  SELECT territory_id, territory, manager_id, salesperson AS manager
  FROM {_faulty("silver_territories", "territory_id", True)} AS t
  LEFT JOIN faulty_silver_salespeople ON salesperson_id = manager_id),
faulty_silver_customers AS {_faulty("silver_customers", "customer_id", True)},
faulty_silver_products AS {_faulty("silver_products", "product_id", True)},
faulty_silver_orders AS {_faulty("silver_orders", "order_id", False)},
faulty_silver_order_lines AS (
  SELECT * FROM silver_order_lines UNION ALL
  SELECT * REPLACE (NULL AS order_id) FROM silver_order_lines WHERE order_id % 10 = 3),
faulty_dim_salesperson AS (SELECT * FROM faulty_silver_salespeople),
faulty_dim_territory AS (SELECT * FROM faulty_silver_territories),
faulty_dim_customer AS (SELECT * FROM faulty_silver_customers),
faulty_dim_product AS (SELECT * FROM faulty_silver_products),
faulty_fact_sales AS (
  SELECT customer_id, salesperson_id, territory_id, product_id
  FROM faulty_silver_order_lines JOIN faulty_silver_orders USING (order_id)),
faulty_fact_inventory AS (SELECT * FROM silver_inventory)"""


def _quality(prefix: str = "") -> str:
    rules = [
        (f"silver_{view}", f"{one}_has_id", "drop", f"{one}_id IS NULL")
        for view, one in (
            ("salespeople", "salesperson"),
            ("territories", "territory"),
            ("customers", "customer"),
            ("products", "product"),
            ("orders", "order"),
        )
    ]
    unknown = "order_status NOT IN ('draft', 'sent', 'sale', 'cancel', 'done')"
    rules.append(("silver_orders", "status_is_known", "warn", unknown))
    rules.append(("silver_order_lines", "line_has_order", "drop", "order_id IS NULL"))
    return "\nUNION ALL ".join(
        f"SELECT '{view}' AS view_name, '{name}' AS constraint_name, '{action}' AS action, "
        f"count(*) AS evaluated, count(*) FILTER (WHERE {fails}) AS failed FROM {prefix}{view}"
        for view, name, action, fails in rules
    )


def _constraints(prefix: str = "") -> str:
    keyed = [
        f"""SELECT '{table}' AS table_name, '{kind}_{name}' AS constraint_name,
          '{label}' AS kind, count(*) AS checked, {found} AS violations FROM {prefix}{table}"""
        for table, name, key in (
            ("dim_customer", "customer", "customer_id"),
            ("dim_territory", "territory", "territory_id"),
            ("dim_salesperson", "salesperson", "salesperson_id"),
            ("dim_product", "product", "product_id"),
            ("silver_orders", "order", "order_id"),
        )
        for kind, label, found in (
            ("nn", "not_null", f"count(*) - count({key})"),
            (
                "pk",
                "primary_key",
                f"(SELECT count(*) FROM (SELECT {key} FROM {prefix}{table} "
                f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1) AS d)",
            ),
        )
    ]
    foreign = [
        f"""SELECT '{fact}', '{name}', 'foreign_key', count(*),
          count(*) FILTER (WHERE f.{key} IS NOT NULL AND d.{key} IS NULL)
          FROM {prefix}{fact} f
          LEFT JOIN (SELECT DISTINCT {key} FROM {prefix}{dim}) d ON d.{key} = f.{key}"""
        for fact, name, dim, key in (
            ("fact_sales", "fk_sales_customer", "dim_customer", "customer_id"),
            ("fact_sales", "fk_sales_salesperson", "dim_salesperson", "salesperson_id"),
            ("fact_sales", "fk_sales_territory", "dim_territory", "territory_id"),
            ("fact_sales", "fk_sales_product", "dim_product", "product_id"),
            ("fact_inventory", "fk_inventory_product", "dim_product", "product_id"),
        )
    ]
    return "\nUNION ALL ".join(keyed + foreign)

def _two_years(year: int) -> str:
    return _layered(
        f"""
        SELECT mes, CAST(now AS {MONEY}) AS current, CAST(before AS {MONEY}) AS previous,
          {_change("now", "before", 1, "DECIMAL(18,1)")} AS change_pct
        FROM (SELECT sale_month AS mes,
                sum(subtotal) FILTER (WHERE sale_year = {year}) AS now,
                sum(subtotal) FILTER (WHERE sale_year = {year - 1}) AS before
              FROM sold WHERE sale_year IN ({year}, {year - 1}) GROUP BY sale_month) AS m"""
    )


T1 = _layered(
    f"""
    SELECT territory, manager, count(DISTINCT order_id) AS orders, {SUM_SALES} AS sales
    FROM sold_97 JOIN dim_territory USING (territory_id) GROUP BY territory, manager"""
)
T2 = _layered(
    f"""
    SELECT salesperson, territory, count(DISTINCT order_id) AS orders, {SUM_SALES} AS sales,
      {TICKET} AS avg_ticket
    FROM sold_97 JOIN dim_salesperson USING (salesperson_id)
    LEFT JOIN dim_territory USING (territory_id)
    GROUP BY salesperson, territory
    ORDER BY sales DESC, salesperson NULLS FIRST, territory NULLS FIRST LIMIT 10"""
)
T3 = _layered(
    f"""
    SELECT product, category, CAST(sum(quantity) AS DECIMAL(18,3)) AS units, {SUM_SALES} AS sales
    FROM sold_97 JOIN dim_product USING (product_id) GROUP BY product, category
    ORDER BY sales DESC, product, category LIMIT 15"""
)
T4 = _layered(
    f"""
    SELECT coalesce(a.sale_month, b.sale_month) AS sale_month,
      CAST(a.s AS {MONEY}) AS sales_current, CAST(b.s AS {MONEY}) AS sales_previous,
      {_change("a.s", "b.s", 2, "DECIMAL(9,2)")} AS change_pct
    FROM (SELECT sale_month, sum(subtotal) AS s FROM sold WHERE sale_year = 2001
          GROUP BY sale_month) AS a
    FULL OUTER JOIN (SELECT sale_month, sum(subtotal) AS s FROM sold WHERE sale_year = 2000
          GROUP BY sale_month) AS b ON a.sale_month = b.sale_month"""
)
T5 = _layered(
    f"""
    SELECT state, count(DISTINCT customer_id) AS customers, {SUM_SALES} AS sales
    FROM sold_97 JOIN dim_customer USING (customer_id) GROUP BY state"""
)
_AVAILABLE = "CAST(available * 1000 AS HUGEINT) * 30"
_RECENT = "CAST(units * 1000 AS HUGEINT)"
T6 = _layered(
    f"""
    SELECT product, warehouse, CAST(available AS DECIMAL(18,3)) AS available,
      CAST(units AS DECIMAL(18,3)) AS sold_in_period,
      {_half_up(_AVAILABLE, _RECENT, 1, "DECIMAL(9,1)")} AS days_of_cover
    FROM fact_inventory JOIN dim_product USING (product_id)
    JOIN (SELECT product_id, sum(quantity) AS units FROM sold
          WHERE sale_date >= DATE '2001-08-02' - 30 GROUP BY product_id) AS r USING (product_id)
    WHERE units > 0"""
)
T7 = _layered(
    f"""
    SELECT customer, state, max(sale_date) AS last_order,
      CAST(date_diff('day', max(sale_date), DATE '2001-08-02') AS INTEGER) AS days_since_order,
      {SUM_SALES} AS lifetime_sales
    FROM sold JOIN dim_customer USING (customer_id) GROUP BY customer, state
    HAVING date_diff('day', max(sale_date), DATE '2001-08-02') > 60"""
)

CDC = _layered(f"SELECT {ORDER_COLUMNS} FROM final", EVENTS)

#: Planted failures, one row each.
FAILURES = f"""
SELECT 'sale_order' AS table_name, CAST(id AS VARCHAR) AS id, 'is decimal(18,2)' AS rule,
  'amount_total' AS column_name, 'n/a' AS raw FROM b_order WHERE id % 10 = 1
UNION ALL SELECT 'sale_order', CAST(id AS VARCHAR), 'is timestamp', 'date_order', '2024-13-40'
FROM b_order WHERE id % 10 = 8
UNION ALL SELECT 'sale_order', NULL, 'order_has_id', 'id', NULL FROM b_order WHERE id % 10 = 3
UNION ALL SELECT 'sale_order_line', {LINE_ID}, 'is decimal(18,3)', 'product_uom_qty', 'many'
FROM lineitem WHERE l_orderkey % 10 = 5 AND l_linenumber <> 7
UNION ALL SELECT 'sale_order_line', {LINE_ID}, 'line_has_order', 'order_id', NULL
FROM lineitem WHERE l_orderkey % 10 = 3 AND l_linenumber <> 7
UNION ALL SELECT 'res_partner', CAST(customer_id AS VARCHAR), 'is int', 'customer_rank', '1st'
FROM party WHERE customer_id % 10 = 6
UNION ALL SELECT 'res_partner', NULL, 'customer_has_id', 'id', NULL FROM party WHERE customer_id % 10 = 3
UNION ALL SELECT 'res_users', NULL, 'salesperson_has_id', 'id', NULL FROM supplier WHERE s_suppkey % 10 = 3
UNION ALL SELECT 'crm_team', NULL, 'territory_has_id', 'id', NULL FROM region WHERE r_regionkey % 10 = 3
UNION ALL SELECT 'product_product', NULL, 'product_has_id', 'id', NULL FROM part WHERE p_partkey % 10 = 3
"""

ORACLES: dict[str, str] = {
    "bronze_rowcounts": _layered("SELECT table_name, n AS rows FROM sizes", SIZES),
    "bronze_conform_drift": _layered(
        """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS client_order_ref) FROM b_order_text"""
    ),
    "contract_conformance": _layered(
        """
        SELECT table_name, CAST(contract_columns AS BIGINT) AS contract_columns,
          CAST(CASE table_name WHEN 'sale_order' THEN 1 WHEN 'product_pricelist' THEN 3 ELSE 0 END
               AS BIGINT) AS missing_columns,
          CASE table_name WHEN 'sale_order' THEN 'client_order_ref'
               WHEN 'product_pricelist' THEN 'currency_id, id, name' ELSE '' END AS missing,
          CASE table_name WHEN 'sale_order' THEN 'drift' WHEN 'product_pricelist' THEN 'absent'
               ELSE 'full' END AS status,
          CASE table_name WHEN 'product_pricelist' THEN 0 ELSE n END AS rows
        FROM contract JOIN sizes USING (table_name)""",
        CONTRACT,
        SIZES,
    ),
    "source_target_reconcile": _layered(
        """
        SELECT table_name, n AS source_rows, n AS target_rows, CAST(0 AS BIGINT) AS difference
        FROM sizes
        WHERE table_name IN ('sale_order', 'sale_order_line', 'res_partner', 'stock_quant')""",
        SIZES,
    ),
    "reconcile_faulty": _layered(
        """
        SELECT table_name, n AS source_rows, n + added - missing AS target_rows,
          missing - added AS difference FROM sizes JOIN (
          SELECT 'sale_order' AS table_name, CAST(0 AS BIGINT) AS missing,
            count(*) FILTER (WHERE id % 10 IN (3, 4)) AS added FROM b_order UNION ALL
          SELECT 'sale_order_line', 0, count(*) FILTER (WHERE l_orderkey % 10 = 3)
          FROM lineitem UNION ALL
          SELECT 'res_partner', count(*) FILTER (WHERE customer_id % 10 = 2),
            count(*) FILTER (WHERE customer_id % 10 IN (3, 4)) FROM party UNION ALL
          SELECT 'stock_quant', 0, 0) AS faults USING (table_name)""",
        SIZES,
    ),
    "reconcile_rows": _layered(
        f"""
        SELECT 'sale_order' AS table_name, CAST(id AS VARCHAR) AS id, 'added' AS kind,
          CAST(0 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS target_rows,
          CAST(NULL AS VARCHAR) AS changed
        FROM b_order WHERE id % 10 = 4
        UNION ALL SELECT 'sale_order', NULL, 'added', 0, count(*), NULL
        FROM b_order WHERE id % 10 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'sale_order', CAST(id AS VARCHAR), 'altered', 1, 1, 'state'
        FROM b_order WHERE id % 10 = 6
        UNION ALL SELECT 'sale_order_line', {LINE_ID} AS line, 'added', 0, count(*), NULL
        FROM lineitem WHERE l_orderkey % 10 = 3 GROUP BY line
        UNION ALL SELECT 'res_partner', CAST(customer_id AS VARCHAR), 'added', 0, 1, NULL
        FROM party WHERE customer_id % 10 = 4
        UNION ALL SELECT 'res_partner', CAST(customer_id AS VARCHAR), 'lost', 1, 0, NULL
        FROM party WHERE customer_id % 10 = 2
        UNION ALL SELECT 'res_partner', NULL, 'added', 0, count(*), NULL
        FROM party WHERE customer_id % 10 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'res_partner', CAST(customer_id AS VARCHAR), 'altered', 1, 1, 'vat'
        FROM party WHERE customer_id % 10 = 7"""
    ),
    "landing_round_trip": _layered("SELECT * FROM b_order_text"),
    "company_currency_audit": _layered(
        """
        SELECT c.company_id, company, currency, count(o.id) AS orders,
          count(o.id) FILTER (WHERE o.currency_id <> c.company_id) AS orders_in_other_currency
        FROM company c LEFT JOIN b_order o ON o.company_id = c.company_id
        GROUP BY c.company_id, company, currency""",
        "company(company_id, company, currency) AS (VALUES "
        "(CAST(1 AS BIGINT), 'Distribuidora', 'HNL'), (CAST(2 AS BIGINT), 'Importadora', 'USD'))",
    ),
    "bronze_cdc_apply": CDC,
    "bronze_cdc_stream": CDC,
    "bronze_cdc_buckets": CDC,
    "bronze_cdc_state": CDC,
    "bronze_versions": _layered(
        """
        SELECT reader, state, count(*) AS orders,
          CAST(sum(CAST(amount_total AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
        FROM (SELECT 'before' AS reader, state, amount_total FROM b_order_text
          UNION ALL SELECT 'after', state, amount_total FROM final) AS both_times
        GROUP BY reader, state""",
        EVENTS,
    ),
    "localized_text": _layered(
        """
        SELECT 'crm_team' AS table_name, territory_id AS id, territory AS text FROM dim_territory
        UNION ALL SELECT 'res_country', r_regionkey, 'País ' || r_name FROM region
        UNION ALL SELECT 'product_template', p_partkey + 500000, p_name FROM part
        UNION ALL SELECT DISTINCT 'product_category',
          CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT), 'Todo / ' || p_brand FROM part"""
    ),
    "quarantine_rows": _layered(f"SELECT * FROM ({FAILURES}) AS failures"),
    "quarantine_counts": _layered(
        f"""
        SELECT table_name, n - coalesce(failed, 0) AS good_rows, coalesce(failed, 0) AS failed_rows
        FROM (
          SELECT 'sale_order' AS table_name, count(*)
            + count(*) FILTER (WHERE id % 10 IN (3, 4)) AS n FROM b_order
          UNION ALL SELECT 'sale_order_line',
            count(*) + count(*) FILTER (WHERE l_orderkey % 10 = 3) FROM lineitem
          UNION ALL SELECT 'res_partner', count(*) + count(*) FILTER (WHERE customer_id % 10 IN (3, 4))
            - count(*) FILTER (WHERE customer_id % 10 = 2) FROM party
          UNION ALL SELECT 'res_users', count(*) + count(*) FILTER (WHERE s_suppkey % 10 IN (3, 4))
            - count(*) FILTER (WHERE s_suppkey % 10 = 2) FROM supplier
          UNION ALL SELECT 'crm_team', count(*) + count(*) FILTER (WHERE r_regionkey % 10 IN (3, 4))
            - count(*) FILTER (WHERE r_regionkey % 10 = 2) FROM region
          UNION ALL SELECT 'product_product', count(*) + count(*) FILTER (WHERE p_partkey % 10 IN (3, 4))
            - count(*) FILTER (WHERE p_partkey % 10 = 2) FROM part
          UNION ALL SELECT 'product_template', count(*) FROM part
          UNION ALL SELECT 'stock_quant', 5 * count(*) FROM part) AS input
        LEFT JOIN (SELECT table_name, count(*) AS failed FROM ({FAILURES}) AS failures
          GROUP BY table_name) AS set_aside USING (table_name)"""
    ),
    "quarantine_sales": _layered(
        """
        SELECT sale_year, count(*) AS n_lines, CAST(sum(subtotal) AS DECIMAL(18,2)) AS sales
        FROM fact_sales WHERE order_id % 10 NOT IN (1, 5, 8) GROUP BY sale_year"""
    ),
    **{
        name: _view(name)
        for name in (
            "silver_salespeople",
            "silver_territories",
            "silver_customers",
            "silver_products",
            "silver_orders",
            "silver_order_lines",
            "silver_inventory",
            "dim_customer",
            "dim_territory",
            "dim_salesperson",
            "dim_product",
            "fact_sales",
            "fact_inventory",
            "sales_metrics",
        )
    },
    "silver_quality_report": _layered(_quality()),
    "constraint_report": _layered(_constraints()),
    "quality_report_faulty": _layered(_quality("faulty_"), FAULTY),
    "constraint_report_faulty": _layered(_constraints("faulty_"), FAULTY),
    "sales_by_territory": T1,
    "top_salespeople": T2,
    "top_products": T3,
    "sales_year_over_year": T4,
    "sales_by_state": T5,
    "stockout_risk": T6,
    "lapsed_customers": T7,
    "sql_sales_by_territory": T1,
    "sql_top_salespeople": T2,
    "sql_top_products": T3,
    "sql_top_products_2000": T3.replace("LIMIT 15", "LIMIT 2000"),
    "sql_sales_year_over_year": T4,
    "sql_sales_by_state": T5,
    "sql_stockout_risk": T6,
    "sql_lapsed_customers": T7,
    "mv_by_zona": _layered(
        f"""
        SELECT territory AS zona, manager AS gerente, count(DISTINCT order_id) AS pedidos,
          {SUM_SALES} AS venta
        FROM ventas GROUP BY territory, manager"""
    ),
    "mv_by_vendedor": _layered(
        f"""
        SELECT salesperson AS vendedor, {SUM_SALES} AS venta, {TICKET} AS ticket_promedio
        FROM ventas_97 GROUP BY salesperson"""
    ),
    "mv_by_departamento": _layered(
        f"""
        SELECT state AS departamento, count(DISTINCT customer) AS clientes,
          count(DISTINCT order_id) AS pedidos, {SUM_SALES} AS venta
        FROM ventas_97 GROUP BY state"""
    ),
    "mv_by_producto": _layered(
        f"""
        SELECT product AS producto, category AS categoria, count(DISTINCT order_id) AS pedidos,
          count(DISTINCT customer) AS clientes, {SUM_SALES} AS venta
        FROM ventas_97 GROUP BY product, category"""
    ),
    "mv_by_ciudad_categoria": _layered(
        f"""
        SELECT city AS ciudad, category AS categoria, count(DISTINCT order_id) AS pedidos,
          {SUM_SALES} AS venta
        FROM ventas GROUP BY city, category"""
    ),
    "rollup_by_categoria": _layered(
        f"""
        SELECT category AS categoria, count(DISTINCT order_id) AS pedidos,
          count(DISTINCT customer) AS clientes, {TICKET} AS ticket_promedio
        FROM ventas GROUP BY category"""
    ),
    "rollup_by_zona": _layered(
        f"""
        SELECT territory AS zona, manager AS gerente, count(DISTINCT customer) AS clientes,
          count(DISTINCT order_id) AS pedidos, {SUM_SALES} AS venta
        FROM ventas GROUP BY territory, manager"""
    ),
    "mv_by_mes": _layered(
        f"""
        SELECT month_start AS mes_inicio, currency AS moneda, {SUM_SALES} AS venta,
          CAST(sum(total_with_tax) AS {MONEY}) AS venta_con_impuesto,
          count(DISTINCT order_id) AS pedidos
        FROM ventas GROUP BY month_start, currency"""
    ),
    "mv_all_measures": _layered(
        f"""
        SELECT {SUM_SALES} AS venta, CAST(sum(total_with_tax) AS {MONEY}) AS venta_con_impuesto,
          count(DISTINCT order_id) AS pedidos, count(DISTINCT customer) AS clientes,
          {TICKET} AS ticket_promedio
        FROM ventas"""
    ),
    "mv_currency_check": _layered(
        f"""
        SELECT territory AS zona, {SUM_SALES} AS venta, count(DISTINCT currency) AS currencies
        FROM ventas GROUP BY territory"""
    ),
    "mv_this_year": _layered(
        f"""
        SELECT territory AS zona, count(DISTINCT order_id) AS pedidos, {SUM_SALES} AS venta
        FROM ventas WHERE sale_year = 2001 GROUP BY territory"""
    ),
    "mv_yoy_pivot": _two_years(2001),
    "mv_top_products_in_zone": _layered(
        f"""
        SELECT product AS producto, {SUM_SALES} AS venta,
          CAST(sum(quantity) AS DECIMAL(18,3)) AS unidades
        FROM ventas_97 WHERE territory = 'Zona AFRICA' GROUP BY product
        ORDER BY venta DESC, producto LIMIT 15"""
    ),
    "mv_lowest_states": _layered(
        f"""
        SELECT state AS departamento, {SUM_SALES} AS venta FROM ventas_97 GROUP BY state
        ORDER BY venta, departamento LIMIT 5"""
    ),
    "kpi_month": _layered(
        f"""
        SELECT DATE '2001-07-01' AS month, CAST(now AS {MONEY}) AS sales,
          CAST(before AS {MONEY}) AS sales_last_year,
          {_change("now", "before", 2, "DECIMAL(9,2)")} AS change_pct, n AS orders,
          {_ticket("now", "n")} AS avg_ticket
        FROM (SELECT sum(subtotal) FILTER (WHERE sale_year = 2001) AS now,
                sum(subtotal) FILTER (WHERE sale_year = 2000) AS before,
                count(DISTINCT order_id) FILTER (WHERE sale_year = 2001) AS n
              FROM sold WHERE sale_month = 7 AND sale_year IN (2000, 2001)) AS m"""
    ),
    "monthly_two_years": _two_years(2000),
    "lowest_stock": _layered(
        """
        SELECT product, warehouse, CAST(available AS DECIMAL(18,3)) AS available
        FROM fact_inventory JOIN dim_product USING (product_id)"""
    ),
    "pending_delivery": _layered(
        """
        SELECT product_id, product,
          CAST(sum(greatest(quantity - quantity_delivered, 0)) AS DECIMAL(18,3)) AS pending
        FROM sold JOIN dim_product USING (product_id) GROUP BY product_id, product
        HAVING sum(greatest(quantity - quantity_delivered, 0)) > 0"""
    ),
    "entity_values": _layered("SELECT dimension, value FROM entities", VALUES),
    "entity_match": _layered(
        """
        SELECT dimension, value,
          CAST(levenshtein(strip_accents(lower(value)), 'zona amerca') AS INTEGER) AS distance
        FROM entities""",
        VALUES,
    ),
    "entity_match_terms": _layered(
        """
        SELECT term, dimension, value,
          CAST(levenshtein(strip_accents(lower(value)), strip_accents(lower(term))) AS INTEGER) AS distance
        FROM entities, (SELECT DISTINCT value[:2] || value[4:] AS term FROM entities)
        WHERE levenshtein(strip_accents(lower(value)), strip_accents(lower(term))) <= 1""",
        VALUES,
    ),
    "manager_scope": _layered(
        f"""
        SELECT territory, manager, count(DISTINCT order_id) AS orders, {SUM_SALES} AS sales
        FROM sold_97 JOIN dim_territory USING (territory_id)
        JOIN dim_salesperson s ON s.salesperson_id = manager_id AND email = 'user1@example.com'
        GROUP BY territory, manager"""
    ),
    "tenant_union": _layered(
        f"""
        SELECT tenant, sale_year, {SUM_SALES} AS sales, count(*) AS n_lines
        FROM all_sales WHERE order_status = 'sale' GROUP BY tenant, sale_year"""
    ),
}


def _placed(name: str, *order: str) -> str:
    """The rows of a question with their place; its other columns break ties."""
    return f"SELECT *, row_number() OVER (ORDER BY {', '.join(order)}) AS place FROM ({ORACLES[name]})"


ORACLES |= {
    # the same rows, whatever schemas they lie in
    "tenant_schemas": ORACLES["tenant_union"],
    "rollup_by_departamento": ORACLES["mv_by_departamento"],
    "rollup_by_producto": ORACLES["mv_by_producto"],
    "placed_sales_by_territory": _placed(
        "sales_by_territory",
        "sales DESC NULLS LAST", "territory NULLS FIRST", "manager NULLS FIRST", "orders",
    ),
    "placed_top_salespeople": _placed(
        "top_salespeople",
        "sales DESC NULLS LAST", "salesperson NULLS FIRST", "territory NULLS FIRST", "orders",
    ),
    "placed_top_products": _placed(
        "top_products", "sales DESC NULLS LAST", "product NULLS FIRST", "category NULLS FIRST", "units"
    ),
    "placed_sales_year_over_year": _placed("sales_year_over_year", "sale_month NULLS FIRST"),
    "placed_sales_by_state": _placed(
        "sales_by_state", "sales DESC NULLS LAST", "state NULLS FIRST", "customers"
    ),
    "placed_stockout_risk": _placed(
        "stockout_risk",
        "days_of_cover NULLS LAST", "product NULLS FIRST", "warehouse NULLS FIRST",
        "available NULLS FIRST", "sold_in_period NULLS FIRST",
    ),
    "placed_lapsed_customers": _placed(
        "lapsed_customers",
        "lifetime_sales DESC NULLS LAST", "customer NULLS FIRST", "state NULLS FIRST", "last_order",
    ),
    "placed_lowest_stock": _placed(
        "lowest_stock", "available NULLS FIRST", "product NULLS FIRST", "warehouse NULLS FIRST"
    ),
    "placed_mv_by_mes": _placed("mv_by_mes", "mes_inicio NULLS FIRST", "moneda NULLS FIRST"),
}
