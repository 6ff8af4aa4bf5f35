from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException

from starmart.config import MartConfig
from starmart.operators import assets
from starmart.plans import dashboard, sqlfunctions
from tests.conftest import BASE, line, order, rows, sale

MARCH = (dt.date(2024, 3, 1), dt.date(2024, 3, 31))


def D(text):
    return None if text is None else Decimal(text)


def test_sales_by_territory(mart):
    m = mart(
        [
            sale(1, 10, "2024-03-01"),
            sale(2, 20, "2024-03-31"),
            sale(3, 40, "2024-02-29"),
            sale(4, 80, "2024-04-01"),
            sale(5, 5, team_id=2),
            sale(6, 1, team_id=None),
            sale(7, 100, state="done"),
            sale(8, 100, state="draft"),
            sale(9, 100, team_id=77),
        ]
    )
    assert rows(assets.sales_by_territory(m, *MARCH)) == [
        ("Zona Norte", "Vera", 2, D("30.00")),
        ("Zona Sur", "Willy", 1, D("5.00")),
    ]


def test_orders_are_counted_once(mart):
    m = mart(
        sale_order=[order(1), order(2)],
        sale_order_line=[line(1, 1, 3), line(2, 1, 4, product_id=2), line(3, 2, 3)],
    )
    assert rows(assets.sales_by_territory(m, *MARCH)) == [("Zona Norte", "Vera", 2, D("10.00"))]


def test_zones_of_equal_name_and_manager_merge(mart):
    m = mart(
        [sale(1, 10), sale(2, 20, team_id=3)],
        crm_team=[*BASE["crm_team"], {"id": 3, "name": "Zona Norte", "user_id": 1}],
    )
    assert rows(assets.sales_by_territory(m, *MARCH)) == [("Zona Norte", "Vera", 2, D("30.00"))]


def test_period_defaults_to_the_current_year(mart):
    m = mart([sale(1, 10, "2024-01-01"), sale(2, 20, "2023-12-31"), sale(3, 5, "2024-12-31")])
    assert rows(assets.sales_by_territory(m)) == [("Zona Norte", "Vera", 2, D("15.00"))]


def test_top_salespeople(mart):
    m = mart(
        [
            sale(1, 10), sale(2, 11),
            sale(3, 5, team_id=None),
            sale(4, 5, user_id=2, team_id=2),
            sale(5, 50, user_id=None),
            sale(6, 50, user_id=99),
        ]
    )
    ranked = [
        ("Vera", "Zona Norte", 2, D("21.00"), D("10.50")),
        ("Vera", None, 1, D("5.00"), D("5.00")),
        ("Willy", "Zona Sur", 1, D("5.00"), D("5.00")),
    ]
    assert rows(assets.top_salespeople(m, *MARCH)) == ranked
    assert rows(assets.top_salespeople(m, *MARCH, 2)) == ranked[:2]
    assert rows(assets.top_salespeople(m, *MARCH, 0)) == []


def test_average_ticket_rounds_half_up(mart):
    m = mart([sale(1, "10.00"), sale(2, "10.01")])
    assert rows(assets.top_salespeople(m, *MARCH))[0][4] == D("10.01")


def test_top_products_merge_by_name(mart):
    m = mart(
        [sale(1, 10, product_id=1, qty="2"), sale(2, 5, product_id=3, qty="1.5"), sale(3, 12, product_id=2)],
        product_product=[*BASE["product_product"], {"id": 3, "product_tmpl_id": 100}],
    )
    assert rows(assets.top_products(m, *MARCH)) == [
        ("Pan", "Todo / Pan", D("3.500"), D("15.00")),
        ("Café", "Todo / Pan", D("1.000"), D("12.00")),
    ]
    assert len(rows(assets.top_products(m, *MARCH, 1))) == 1


def test_year_over_year(mart):
    m = mart(
        [
            sale(1, 150, "2024-01-05"), sale(2, 100, "2023-01-05"),
            sale(3, 10, "2024-02-05"),
            sale(4, 20, "2023-03-05"),
            sale(5, 7, "2024-04-05"), sale(6, 0, "2023-04-05"),
            sale(7, 1, "2024-05-05"), sale(8, 3, "2023-05-05"),
            sale(9, 99, "2022-06-05"), sale(10, 99, "2024-06-05", state="done"),
        ]
    )
    assert rows(assets.sales_year_over_year(m, 2024)) == [
        (1, D("150.00"), D("100.00"), D("50.00")),
        (2, D("10.00"), None, None),
        (3, None, D("20.00"), None),
        (4, D("7.00"), D("0.00"), None),
        (5, D("1.00"), D("3.00"), D("-66.67")),
    ]


def test_a_change_too_large_for_its_type(mart):
    sales = [sale(1, "99999999.00", "2024-01-05"), sale(2, "0.01", "2023-01-05")]
    with pytest.raises(ArithmeticException):
        rows(assets.sales_year_over_year(mart(sales), 2024))
    lenient = MartConfig(strict_casts=False)
    assert rows(assets.sales_year_over_year(mart(sales, cfg=lenient), 2024))[0][3] is None


def test_sales_by_state_counts_ids(mart):
    partners = [*BASE["res_partner"], {"id": 4, "name": "Ana", "state_id": 1}]
    m = mart(
        [sale(1, 10), sale(2, 5), sale(3, 5, partner_id=4), sale(4, 30, partner_id=3),
         sale(5, 9, partner_id=None)],
        res_partner=partners,
    )
    assert rows(assets.sales_by_state(m, *MARCH)) == [
        (None, 1, D("30.00")),
        ("Cortés", 2, D("20.00")),
    ]


def stock(id, product_id, location_id, quantity, reserved="0"):
    return {
        "id": id, "product_id": product_id, "location_id": location_id, "company_id": 1,
        "quantity": quantity, "reserved_quantity": reserved,
    }


def test_stockout_risk(mart):
    variants = [{"id": i, "product_tmpl_id": 100} for i in range(1, 7)]
    places = [
        {"id": 1, "complete_name": "A", "usage": "internal", "warehouse_id": 1},
        {"id": 2, "complete_name": "B", "usage": "internal"},
    ]
    m = mart(
        [
            sale(1, 1, "2024-05-31", product_id=1, qty="60"),  # exactly 30 days before
            sale(2, 1, "2024-05-30", product_id=2, qty="60"),  # a day too old
            sale(3, 1, "2024-06-10", product_id=3, qty="-4"),  # net return
            sale(4, 1, "2024-06-10", product_id=4, qty="0"),
            sale(5, 1, "2024-07-10", product_id=5, qty="7"),  # later than the reference date
        ],
        product_product=variants,
        stock_location=places,
        stock_quant=[
            stock(1, 1, 1, "30"), stock(2, 1, 2, "9"), stock(3, 2, 1, "5"), stock(4, 3, 1, "5"),
            stock(5, 4, 1, "5"), stock(6, 5, 1, "7", None), stock(7, 6, 1, "7"),
        ],
    )
    assert rows(assets.stockout_risk(m, 30)) == [
        ("Pan", None, D("9.000"), D("60.000"), D("4.5")),
        ("Pan", "Central", D("30.000"), D("60.000"), D("15.0")),
        ("Pan", "Central", None, D("7.000"), None),
    ]
    with pytest.raises(ValueError, match="p_days"):
        assets.stockout_risk(m, 0)


def test_lapsed_customers(mart):
    m = mart(
        [
            sale(1, 10, "2024-05-01", partner_id=1),  # 60 days: not yet
            sale(2, 10, "2024-04-30", partner_id=2),  # 61 days
            sale(3, 5, "2023-01-01", partner_id=2),
            sale(4, 10, "2020-01-01", partner_id=3, state="draft"),
        ]
    )
    assert rows(assets.lapsed_customers(m, 60)) == [
        ("Berta", "Atlántida", dt.date(2024, 4, 30), 61, D("15.00"))
    ]


def test_customers_of_equal_name_and_state_merge(mart):
    partners = [*BASE["res_partner"], {"id": 4, "name": "Ana", "state_id": 1}]
    sales = [sale(1, 10, "2023-01-01"), sale(2, 5, "2024-06-29", partner_id=4)]
    assert rows(assets.lapsed_customers(mart(sales, res_partner=partners), 60)) == []
    assert len(rows(assets.lapsed_customers(mart(sales), 60))) == 1


def test_clock_is_the_current_date_without_as_of(mart):
    today = dt.date.today()
    old = today - dt.timedelta(days=90)
    m = mart([sale(1, 10, str(old)), sale(2, 10, str(today), partner_id=2)], cfg=MartConfig())
    (row,) = rows(assets.lapsed_customers(m, 60))
    assert row[0] == "Ana" and row[3] in (90, 91)


def test_sql_functions_answer_like_python(spark, mart):
    m = mart(
        [
            sale(1, 10, "2024-03-01"), sale(2, "20.55", user_id=2, team_id=2, product_id=2),
            sale(3, 7, "2023-03-05", partner_id=2), sale(4, 8, "2024-06-20", qty="3"),
            sale(5, 3, team_id=None),
        ],
        stock_quant=[stock(1, 1, 1, "30")],
    )
    sqlfunctions.register(spark, m)
    span = "DATE'2024-03-01', DATE'2024-03-31'"
    calls = {
        f"sales_by_territory({span})": assets.sales_by_territory(m, *MARCH),
        f"top_salespeople({span})": assets.top_salespeople(m, *MARCH),
        f"top_salespeople({span}, p_limit => 1)": assets.top_salespeople(m, *MARCH, 1),
        f"top_products({span})": assets.top_products(m, *MARCH),
        "sales_year_over_year(2024)": assets.sales_year_over_year(m, 2024),
        f"sales_by_state({span})": assets.sales_by_state(m, *MARCH),
        "stockout_risk()": assets.stockout_risk(m),
        "lapsed_customers(p_days => 30)": assets.lapsed_customers(m, 30),
    }
    for call, expected in calls.items():
        got = spark.sql(f"SELECT * FROM {call}")
        assert got.dtypes == expected.dtypes, call
        assert sorted(rows(got), key=repr) == sorted(rows(expected), key=repr), call
        assert rows(got), call


def test_kpi_month(mart):
    m = mart([sale(1, 30, "2024-06-01"), sale(2, 30, "2024-06-30"), sale(3, 40, "2023-06-15"),
              sale(4, 99, "2024-05-31"), sale(5, 99, "2023-07-01")])
    assert rows(dashboard.kpi_month(m)) == [
        (dt.date(2024, 6, 1), D("60.00"), D("40.00"), D("50.00"), 2, D("30.00"))
    ]
    assert rows(dashboard.kpi_month(m, dt.date(2022, 1, 9))) == [
        (dt.date(2022, 1, 1), None, None, None, 0, None)
    ]


def test_stock_lists(mart):
    m = mart(
        sale_order=[order(1), order(2, state="draft")],
        sale_order_line=[
            line(1, 1, 1, qty="5", qty_delivered="2"),
            line(2, 1, 1, qty="1", qty_delivered="4"),
            line(3, 2, 1, qty="9"),
            line(4, 1, 1, product_id=2, qty="1", qty_delivered="1"),
        ],
        stock_quant=[stock(1, 1, 1, "5"), stock(2, 2, 1, "3", None)],
    )
    assert rows(dashboard.pending_delivery(m)) == [(1, "Pan", D("3.000"))]
    assert rows(dashboard.lowest_stock(m)) == [
        ("Café", "Central", None), ("Pan", "Central", D("5.000"))
    ]
