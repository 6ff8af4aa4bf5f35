from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry
from starmart.plans import rollup
from starmart.plans.metrics import Between, MetricError
from starmart.plans.rollup import Rollup, containers, distinct_ids
from starmart.plans.ventas import VENTAS
from tests.conftest import BASE, SF_DIR, rows, sale


@pytest.mark.parametrize("few", [0, 3, 2048])
def test_containers_count_as_distinct_does(spark, few):
    """Lists, bitmaps and both beside each other, over ranges, NULL keys and NULL ids."""
    rng = random.Random(few)
    data = [
        (2024, rng.randint(1, 3), rng.choice([None, 1, 2]), rng.choice([None, 5, rng.randint(0, 9), 10**12 + rng.randint(0, 40), 40_000]))
        for _ in range(400)
    ]
    ids = spark.createDataFrame(data, "sale_year int, sale_month int, key bigint, id bigint")
    packed = containers(ids, few)
    if few:
        assert packed.where("positions IS NOT NULL AND bits IS NOT NULL").count() == 0
        assert packed.where(f"size(positions) > {few}").count() == 0
    got = distinct_ids(packed.withColumnRenamed("key", "group"))
    # NULL as a group is a struct's field in the questions; here it is left out
    got = {r["group"]: r["n"] for r in got.where("group IS NOT NULL").collect()}
    assert got == {k: len({i for *_, g, i in data if g == k and i is not None}) for k in (1, 2)}


@pytest.mark.parametrize("few", [1, rollup.FEW])
def test_rollup_answers_as_the_fact_does(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(rollup.containers, "__defaults__", (few,))
    star = entry._mart(spark, SF_DIR)
    monthly = Rollup(spark, str(tmp_path), star, VENTAS)
    monthly.build()
    measures = [m.name for m in VENTAS.measures]
    for names, first, last in (
        ([], None, None),
        (["Vendedor"], dt.date(1996, 3, 1), dt.date(1998, 2, 28)),
        (["Categoria"], None, dt.date(1995, 12, 31)),
        (["Zona", "Gerente"], dt.date(1997, 1, 1), None),
        (["Cliente"], None, None),
    ):
        got = monthly.query(names, measures, first, last)
        want = VENTAS.query(
            star, names, measures, {"Fecha": Between(first, last)}, currencies="flag"
        )
        assert got.columns == want.columns
        assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)


def test_one_month_is_written_anew_and_the_others_stay(spark, mart, tmp_path):
    partners = [*BASE["res_partner"], {"id": 4, "name": "Ana", "state_id": 1}]
    sales = [
        sale(1, 10, "2024-01-05"),
        sale(2, 20, "2024-02-05", partner_id=4),
        sale(3, 5, "2024-02-06", partner_id=2, product_id=2),
        sale(4, 7, "2024-03-06", partner_id=2, team_id=None),
    ]
    before = Rollup(spark, str(tmp_path), mart(sales, res_partner=partners), VENTAS)
    before.build()
    # Ana twice under two ids
    assert rows(before.query([], ["Clientes", "Pedidos", "Venta"], currencies=None)) == [
        (2, 4, Decimal("42.00"))
    ]
    zones = rows(before.query(["Zona"], ["Clientes", "Pedidos"], currencies=None))
    assert sorted(zones, key=repr) == sorted([("Zona Norte", 2, 3), (None, 1, 1)], key=repr)
    kept = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("sale_month=1/*.parquet")}
    assert kept
    after = Rollup(
        spark, str(tmp_path), mart([sales[0], sale(2, 21, "2024-02-05")], res_partner=partners), VENTAS
    )
    after.build(months=[dt.date(2024, 2, 9), dt.date(2024, 3, 1)])
    assert rows(after.query([], ["Clientes", "Pedidos", "Venta"], currencies=None)) == [
        (1, 2, Decimal("31.00"))
    ]
    assert rows(after.query(["Producto"], ["Pedidos", "Venta"])) == [("Pan", 2, Decimal("31.00"), 1)]
    assert {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("sale_month=1/*.parquet")} == kept


def test_no_sales_and_misuse(spark, mart, tmp_path):
    empty = Rollup(spark, str(tmp_path), mart([sale(1, 10, state="draft")]), VENTAS)
    empty.build()
    assert rows(empty.query([], ["Venta", "Pedidos", "Clientes"])) == [(None, 0, 0, 0)]
    assert rows(empty.query(["Categoria"], ["Pedidos"])) == []
    for question in (
        dict(dimensions=["Zona", "Cliente"], measures=["Venta"]),
        dict(dimensions=["Moneda"], measures=["Venta"]),
        dict(dimensions=["Zona"], measures=[]),
        dict(dimensions=["Zona"], measures=["Venta"], first=dt.date(2024, 1, 2)),
        dict(dimensions=["Zona"], measures=["Venta"], last=dt.date(2024, 1, 30)),
        dict(dimensions=["Zona"], measures=["Venta"], currencies="raise"),
    ):
        with pytest.raises(MetricError):
            empty.query(**question)
