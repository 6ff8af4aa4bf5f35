"""Failed rows are set aside with their reason; the rest builds under strict casts."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from starmart import contract
from starmart.config import MartConfig
from starmart.operators import silver
from starmart.operators.quarantine import NEEDED, TYPES, Quarantine, problems
from starmart.operators.quality import DROP, EXPECTATIONS
from starmart.plans.mart import SILVER, CatalogTables, GoldTables, Mart, build_all, write_table
from starmart.plans.versions import Publication
from tests.conftest import line, order, rows, sale
from tests.test_lanes import multiset

BAD_ORDERS = [
    order(5, amount_total="1,5"),
    order(6, date_order="soon"),
    order(7, partner_id="x", amount_tax="99999999999999999999"),
    order("", state="sale"),
    order(None),
]
BAD_LINES = [line(90, 1, "ten"), line(91, None, 5), line(92, 1, "text", display_type="line_note")]


@pytest.fixture
def spoiled(bronze):
    good = [sale(1, 10), sale(2, 5)]
    return bronze(
        sale_order=[o for o, _ in good] + BAD_ORDERS,
        sale_order_line=[ln for _, ln in good] + BAD_LINES,
        stock_quant=[{"id": 1, "product_id": 1, "location_id": 1, "company_id": 1, "quantity": "a lot"}],
    )


def test_good_and_failed_rows_are_the_input(spark, spoiled, tmp_path):
    found = Quarantine(spark, spoiled, str(tmp_path))
    for table in contract.TABLE_NAMES:
        failed = found.failed(table).drop("problems") if table in TYPES else spark.createDataFrame([], contract.schema(table))
        assert multiset(found[table]) + multiset(failed) == multiset(spoiled[table].select(*contract.TABLES[table])), table
    assert {r.table_name: (r.good_rows, r.failed_rows) for r in found.counts().collect()} == {
        "sale_order": (2, 5), "sale_order_line": (3, 2), "res_partner": (5, 0), "res_users": (2, 0),
        "crm_team": (2, 0), "product_product": (2, 0), "product_template": (2, 0), "stock_quant": (0, 1),
    }


def test_each_failure_is_named(spark, spoiled, tmp_path):
    found = Quarantine(spark, spoiled, str(tmp_path)).report(["sale_order", "sale_order_line", "stock_quant"])
    assert sorted(rows(found), key=repr) == sorted(
        [
            ("sale_order", "5", "is decimal(18,2)", "amount_total", "1,5"),
            ("sale_order", "6", "is timestamp", "date_order", "soon"),
            ("sale_order", "7", "is bigint", "partner_id", "x"),
            ("sale_order", "7", "is decimal(18,2)", "amount_tax", "99999999999999999999"),
            ("sale_order", "", "is bigint", "id", ""),
            ("sale_order", None, "order_has_id", "id", None),
            ("sale_order_line", "90", "is decimal(18,2)", "price_subtotal", "ten"),
            ("sale_order_line", "90", "is decimal(18,2)", "price_total", "ten"),
            ("sale_order_line", "91", "line_has_order", "order_id", None),
            ("stock_quant", "1", "is decimal(18,3)", "quantity", "a lot"),
        ],
        key=repr,
    )


def test_strict_silver_runs_on_what_is_left(spark, spoiled, tmp_path, mart):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Mart(spoiled).silver_orders.collect()
    kept = Mart(Quarantine(spark, spoiled, str(tmp_path)))
    want = mart([sale(1, 10), sale(2, 5)])
    for view in SILVER:
        assert multiset(getattr(kept, view)) == multiset(getattr(want, view)), view


def test_every_cast_and_every_dropping_rule_of_silver_is_covered(bronze, monkeypatch):
    """The columns that Silver casts are those inspected, with the same types."""
    cast: set[tuple[str, str]] = set()
    real = silver.typed

    def noted(value, kind, strict=True):
        cast.add((value, kind))
        return real(value, kind, strict)

    monkeypatch.setattr(silver, "typed", noted)
    made = Mart(bronze())
    for view in SILVER:
        made.unchecked(view)
    assert cast == {(c, k) for kinds in TYPES.values() for c, k in kinds.items()}
    dropping = {e.name for e in EXPECTATIONS if e.action == DROP}
    assert dropping == {rule for rules in NEEDED.values() for rule in rules.values()}


def test_a_table_without_types_has_no_problems(spark, bronze):
    assert bronze()["res_currency"].select(F.size(problems("res_currency"))).distinct().collect() == [(0,)]


def test_build_with_a_quarantine(spark, spoiled, tmp_path):
    tag = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_schema=f"b_{tag}", silver_schema=f"s_{tag}", gold_schema=f"g_{tag}")
    tables = {t: (lambda t=t: spoiled[t]) for t in contract.TABLE_NAMES}
    Publication(spark, cfg.schema("bronze")).publish(tables, write_table)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_all(spark, cfg)
    build_all(spark, cfg, str(tmp_path))
    assert rows(GoldTables(spark, cfg).fact_sales.select("order_id").orderBy("order_id")) == [(1,), (2,)]
    again = Quarantine(spark, CatalogTables(spark, cfg, "bronze", contract.TABLE_NAMES), str(tmp_path / "again"))
    assert again.report().count() == 10
