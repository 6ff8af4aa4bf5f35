from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

import pytest
from pyspark.sql import DataFrame, SparkSession

from starmart import contract
from starmart.config import MartConfig
from starmart.plans.mart import Mart
from starmart.session import configure, small_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("starmart-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def ids(df: DataFrame, column: str) -> list:
    return sorted(r[0] for r in df.select(column).collect())


# A small business: company 1 keeps books in HNL, company 2 in USD.
BASE: dict[str, list[dict]] = {
    "res_currency": [{"id": 1, "name": "HNL"}, {"id": 2, "name": "USD"}],
    "res_company": [
        {"id": 1, "name": "Uno", "currency_id": 1},
        {"id": 2, "name": "Dos", "currency_id": 2},
    ],
    "res_country": [{"id": 1, "name": '{"en_US": "Honduras", "es_ES": "Honduras (es)"}'}],
    "res_country_state": [
        {"id": 1, "name": "Cortés", "code": "CR", "country_id": 1},
        {"id": 2, "name": "Atlántida", "code": "AT", "country_id": 1},
    ],
    "res_partner": [
        {"id": 1, "name": "Ana", "state_id": 1, "country_id": 1, "city": "SPS", "active": "true"},
        {"id": 2, "name": "Berta", "state_id": 2, "country_id": 1, "city": "LCE"},
        {"id": 3, "name": "Caja", "city": "SPS"},
        {"id": 10, "name": "Vera"},
        {"id": 11, "name": "Willy"},
    ],
    "res_users": [
        {"id": 1, "partner_id": 10, "login": "vera@x", "active": "true"},
        {"id": 2, "partner_id": 11, "login": "willy@x", "active": "false"},
    ],
    "crm_team": [
        {"id": 1, "name": '{"en_US": "North", "es_ES": "Zona Norte"}', "user_id": 1},
        {"id": 2, "name": "Zona Sur", "user_id": 2},
    ],
    "product_category": [{"id": 1, "complete_name": "Todo / Pan"}],
    "uom_uom": [{"id": 1, "name": '{"en_US": "Units"}'}],
    "product_template": [
        {"id": 100, "name": "Pan", "categ_id": 1, "uom_id": 1, "list_price": "10.5"},
        {"id": 200, "name": '{"es_ES": "Café"}', "categ_id": 1, "uom_id": 1, "list_price": "7"},
    ],
    "product_product": [
        {"id": 1, "product_tmpl_id": 100, "default_code": "P1"},
        {"id": 2, "product_tmpl_id": 200, "default_code": "P2"},
    ],
    "product_pricelist": [],
    "stock_warehouse": [{"id": 1, "name": "Central", "code": "C"}],
    "stock_location": [
        {"id": 1, "complete_name": "WH/Stock", "usage": "internal", "warehouse_id": 1},
        {"id": 2, "complete_name": "Proveedor", "usage": "supplier"},
    ],
    "stock_quant": [],
    "sale_order": [],
    "sale_order_line": [],
}


def order(id, day="2024-03-10", state="sale", **fields) -> dict:
    values = {
        "id": id,
        "name": f"S{id}",
        "partner_id": 1,
        "user_id": 1,
        "team_id": 1,
        "date_order": f"{day} 12:30:00" if day else None,
        "state": state,
        "currency_id": 1,
        "company_id": 1,
        "amount_untaxed": "0",
        "amount_tax": "0",
        "amount_total": "0",
    }
    return {**values, **fields}


def line(id, order_id, subtotal, product_id=1, qty="1", **fields) -> dict:
    values = {
        "id": id,
        "order_id": order_id,
        "product_id": product_id,
        "product_uom_qty": qty,
        "qty_delivered": "0",
        "price_unit": "1",
        "discount": "0",
        "price_subtotal": str(subtotal),
        "price_total": str(subtotal),
    }
    return {**values, **fields}


def sale(id, subtotal, day="2024-03-10", product_id=1, qty="1", **fields):
    """One order with one line, as ``(order, line)``."""
    return order(id, day, **fields), line(id, id, subtotal, product_id, qty)


class Records(Mapping):
    """Bronze tables made from records when asked for."""

    def __init__(self, spark: SparkSession, tables: dict[str, list[dict]]) -> None:
        self._spark, self._tables = spark, tables

    def __getitem__(self, table: str) -> DataFrame:
        columns = contract.TABLES[table]
        unknown = {k for r in self._tables[table] for k in r} - set(columns)
        assert not unknown, unknown
        data = [
            tuple(None if r.get(c) is None else str(r[c]) for c in columns)
            for r in self._tables[table]
        ]
        ddl = ", ".join(f"{c} STRING" for c in columns)
        return small_table(self._spark, data, ddl)

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


@pytest.fixture
def bronze(spark):
    """Build Bronze from ``BASE`` with some tables replaced."""
    return lambda **tables: Records(spark, {**BASE, **tables})


@pytest.fixture
def mart(bronze):
    """Build a mart from sales given as ``(order, line)`` pairs and other tables."""

    def build(sales=(), as_of=dt.date(2024, 6, 30), cfg=None, **tables) -> Mart:
        if sales:
            tables.setdefault("sale_order", [o for o, _ in sales])
            tables.setdefault("sale_order_line", [ln for _, ln in sales])
        return Mart(bronze(**tables), cfg or MartConfig(as_of=as_of))

    return build
