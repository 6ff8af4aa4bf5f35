from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from starmart.config import MartConfig
from tests.conftest import BASE, ids, line, order, rows, sale


def test_salesperson_takes_its_partners_name(mart):
    users = [*BASE["res_users"], {"id": 3, "login": "nadie@x"}, {"id": 4, "partner_id": 999}]
    m = mart(res_users=users)
    assert sorted(rows(m.silver_salespeople)) == [
        (1, "Vera", "vera@x", True),
        (2, "Willy", "willy@x", False),
        (3, None, "nadie@x", None),
        (4, None, None, None),
    ]


def test_territory_reads_the_salespeople_view(mart):
    teams = [*BASE["crm_team"], {"id": 3, "name": "Sin gerente"}]
    assert sorted(rows(mart(crm_team=teams).silver_territories)) == [
        (1, "Zona Norte", 1, "Vera"),
        (2, "Zona Sur", 2, "Willy"),
        (3, "Sin gerente", None, None),
    ]


def test_every_partner_is_a_customer(mart):
    found = {r.customer_id: r for r in mart().silver_customers.collect()}
    assert set(found) == {1, 2, 3, 10, 11}
    assert (found[1].state, found[1].country) == ("Cortés", "Honduras (es)")
    assert (found[3].state, found[3].country, found[3].city) == (None, None, "SPS")


def test_product_needs_its_template(mart):
    variants = [*BASE["product_product"], {"id": 3, "product_tmpl_id": 999}, {"id": 4}]
    templates = [*BASE["product_template"][:1], {"id": 200, "name": "Suelto", "categ_id": 9}]
    found = {r.product_id: r for r in mart(
        product_product=variants, product_template=templates
    ).silver_products.collect()}
    assert set(found) == {1, 2}
    assert (found[1].product, found[1].category, found[1].uom) == ("Pan", "Todo / Pan", "Units")
    assert (found[2].product, found[2].category, found[2].uom) == ("Suelto", None, None)


def test_orders_follow_the_companys_currency(mart):
    m = mart(
        sale_order=[
            order(1),
            order(2, currency_id=2),
            order(3, currency_id=None),
            order(4, company_id=2),
            order(5, company_id=None),
        ]
    )
    assert sorted(rows(m.silver_orders.select("order_id", "currency"))) == [
        (1, "HNL"), (2, "USD"), (3, None),
    ]
    other = mart(sale_order=[order(1), order(4, company_id=2)], cfg=MartConfig(currency="USD"))
    assert ids(other.silver_orders, "order_id") == [4]


def test_sections_and_notes_are_not_lines(mart):
    m = mart(
        sale_order=[order(1)],
        sale_order_line=[
            line(1, 1, 5),
            line(2, 1, 5, display_type=""),
            line(3, 1, 0, display_type="line_section"),
            line(4, 1, 0, display_type="line_note"),
            line(5, None, 5),
            line(6, 2, 5),
        ],
    )
    assert ids(m.silver_order_lines, "line_id") == [1, 2, 6]
    assert ids(m.fact_sales, "line_id") == [1, 2]


def test_unknown_status_is_kept_and_counted(mart):
    states = ["draft", "sent", "sale", "cancel", "done", "locked", None]
    m = mart(
        sale_order=[order(i, state=s) for i, s in enumerate(states)] + [order(None)],
        res_users=[*BASE["res_users"], {"login": "sin id"}],
        crm_team=[*BASE["crm_team"], {"name": "sin id"}],
        res_partner=[*BASE["res_partner"], {"name": "sin id"}],
        product_product=[*BASE["product_product"], {"product_tmpl_id": 100}],
        sale_order_line=[line(1, None, 1), line(2, 1, 1)],
    )
    assert m.silver_orders.count() == 7
    report = {r.constraint_name: (r.action, r.evaluated, r.failed) for r in m.quality_report().collect()}
    assert report == {
        "salesperson_has_id": ("drop", 3, 1),
        "territory_has_id": ("drop", 3, 1),
        "customer_has_id": ("drop", 6, 1),
        "product_has_id": ("drop", 3, 1),
        "order_has_id": ("drop", 8, 1),
        "status_is_known": ("warn", 8, 2),
        "line_has_order": ("drop", 2, 1),
    }
    for view, column in (
        ("silver_salespeople", "salesperson_id"),
        ("silver_territories", "territory_id"),
        ("silver_customers", "customer_id"),
        ("silver_products", "product_id"),
        ("silver_order_lines", "order_id"),
    ):
        assert None not in [r[0] for r in getattr(m, view).select(column).collect()]


def test_expectations_are_counted_while_writing(mart):
    m = mart(sale_order=[order(1), order(2, state="locked"), order(None)])
    seen = Observation()
    m.checked("silver_orders", seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"evaluated": 3, "order_has_id": 1, "status_is_known": 1}


def test_quality_report_of_empty_views(mart):
    report = {r.constraint_name: r for r in mart().quality_report().collect()}
    assert (report["status_is_known"].evaluated, report["status_is_known"].failed) == (0, 0)


def quant(id, location_id, quantity, reserved, product_id=1, company_id=1):
    return {
        "id": id,
        "product_id": product_id,
        "location_id": location_id,
        "company_id": company_id,
        "quantity": quantity,
        "reserved_quantity": reserved,
    }


def test_inventory(mart):
    m = mart(
        stock_location=[
            {"id": 1, "complete_name": "WH/Stock", "usage": "internal", "warehouse_id": 1},
            {"id": 2, "complete_name": "WH/Stock", "usage": "internal", "warehouse_id": 1},
            {"id": 3, "complete_name": "Tránsito", "usage": "internal"},
            {"id": 4, "complete_name": "Proveedor", "usage": "supplier"},
        ],
        stock_quant=[
            quant(1, 1, "5", "1"),
            quant(2, 2, "3", None),
            quant(3, 3, "2.5", None),
            quant(4, 4, "100", "0"),
            quant(5, 1, "100", "0", company_id=2),
            quant(6, 1, "100", "0", company_id=None),
        ],
    )
    found = {tuple(r[:3]): tuple(map(lambda d: d if d is None else float(d), r[3:]))
             for r in rows(m.silver_inventory)}
    assert found == {
        (1, "Central", "WH/Stock"): (8.0, 1.0, 4.0),
        (1, None, "Tránsito"): (2.5, None, None),
    }


def test_casts_are_strict_unless_told_otherwise(mart):
    bad = [order("7.x")]
    with pytest.raises(PySparkException):
        mart(sale_order=bad).silver_orders.collect()
    lenient = mart(sale_order=[*bad, order(1)], cfg=MartConfig(strict_casts=False))
    assert ids(lenient.silver_orders, "order_id") == [1]


def test_fact_columns(mart):
    m = mart([sale(1, "10.005", day="2024-12-31")])
    (row,) = m.fact_sales.collect()
    assert (str(row.sale_date), row.sale_year, row.sale_month) == ("2024-12-31", 2024, 12)
    assert str(row.month_start) == "2024-12-01 00:00:00"
    assert str(row.subtotal) == "10.01"
    assert len(m.fact_sales.columns) == 20 and len(m.sales_metrics.columns) == 18
