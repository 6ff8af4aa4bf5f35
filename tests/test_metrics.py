from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starmart.operators import assets
from starmart.plans import dashboard, scope, vocabulary
from starmart.plans.metrics import Between, MetricError
from starmart.plans.ventas import VENTAS
from tests.conftest import BASE, SF_DIR, line, order, rows, sale


@pytest.fixture(scope="module")
def star(spark):
    return entry._mart(spark, SF_DIR)




def naive(star, dimensions, measures, where=None):
    """Measures computed the obvious way, over the wide view at line grain."""
    exprs = {
        "Venta": lambda: F.sum("subtotal").cast("decimal(28,2)"),
        "Venta con impuesto": lambda: F.sum("total_with_tax").cast("decimal(28,2)"),
        "Pedidos": lambda: F.count_distinct("order_id"),
        "Unidades": lambda: F.sum("quantity").cast("decimal(28,3)"),
        "Clientes": lambda: F.count_distinct("customer"),
        "Ticket promedio": lambda: F.sum("subtotal")
        / F.nullif(F.count_distinct("order_id"), F.lit(0).cast("bigint")),
    }
    df = star.sales_metrics.filter(VENTAS.filter)
    for name, value in (where or {}).items():
        df = df.filter(F.col(VENTAS.dimension(name).column) == value)
    groups = [F.col(VENTAS.dimension(d).column).alias(d) for d in dimensions]
    if not measures:
        return df.select(*groups).distinct()
    return df.groupBy(*groups).agg(*[exprs[m]().alias(m) for m in measures])


DIMENSIONS = [d.name for d in VENTAS.dimensions]
MEASURES = [m.name for m in VENTAS.measures]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.sampled_from(DIMENSIONS), max_size=3, unique=True),
    st.lists(st.sampled_from(MEASURES), min_size=1, max_size=4, unique=True),
    st.sampled_from([{}, {"Zona": "Zona AFRICA"}, {"Anio": 1998}, {"Categoria": "Todo / Brand#1"}]),
)
def test_two_step_aggregation_equals_the_wide_view(star, dimensions, measures, where):
    got = VENTAS.query(star, dimensions, measures, where=where, currencies=None)
    want = naive(star, dimensions, measures, where)
    assert got.dtypes == want.dtypes
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)


def test_additive_measures_add_up_and_distinct_ones_need_not(star):
    total = VENTAS.query(star, [], ["Venta", "Unidades", "Pedidos"], currencies=None).first()
    by_product = rows(VENTAS.query(star, ["Producto"], ["Venta", "Unidades", "Pedidos"], currencies=None))
    assert sum(r[1] for r in by_product) == total["Venta"]
    assert sum(r[2] for r in by_product) == total["Unidades"]
    assert sum(r[3] for r in by_product) > total["Pedidos"]


def test_sales_without_zone_are_the_difference_to_the_asset(star):
    everything = Between(dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    total = VENTAS.query(star, [], ["Venta"], currencies=None).first()[0]
    zoneless = VENTAS.query(star, [], ["Venta"], where={"Zona": None}, currencies=None).first()[0]
    by_zone = rows(assets.sales_by_territory(star, everything.low, everything.high))
    assert sum(r[3] for r in by_zone) + zoneless == total
    assert zoneless > 0


def test_misuse_is_refused(star):
    refused = [
        dict(dimensions=["Venta"], measures=["Venta"]),
        dict(dimensions=["Zona"], measures=["Zona"]),
        dict(dimensions=["Zona"], measures=["Venta"], where={"Venta": 1}),
        dict(dimensions=["Inventado"], measures=["Venta"]),
        dict(dimensions=["Zona"], measures=["Inventado"]),
        dict(dimensions=["Zona"], measures=["Venta"], order_by=[("Pedidos", "desc")]),
        dict(dimensions=["Zona"], measures=["Venta"], order_by=[("Venta", "down")]),
        dict(dimensions=["Zona"], measures=["Venta"], currencies="maybe"),
        dict(),
    ]
    for question in refused:
        with pytest.raises(MetricError):
            VENTAS.query(star, **question)


def test_null_zone_is_a_group(mart):
    m = mart([sale(1, 10), sale(2, 20, team_id=None), sale(3, 99, state="done")])
    assert sorted(rows(VENTAS.query(m, ["Zona"], ["Venta", "Pedidos"], currencies=None)), key=repr) == sorted(
        [("Zona Norte", Decimal("10.00"), 1), (None, Decimal("20.00"), 1)], key=repr
    )


def test_customers_are_counted_by_name(mart):
    partners = [*BASE["res_partner"], {"id": 4, "name": "Ana", "state_id": 1}]
    m = mart([sale(1, 10), sale(2, 5, partner_id=4)], res_partner=partners)
    assert VENTAS.query(m, [], ["Clientes"], currencies=None).first()[0] == 1
    period = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert rows(assets.sales_by_state(m, *period))[0][1] == 2


def test_orders_spanning_products_of_equal_name(mart):
    m = mart(
        sale_order=[order(1)],
        sale_order_line=[line(1, 1, 3), line(2, 1, 4, product_id=3)],
        product_product=[*BASE["product_product"], {"id": 3, "product_tmpl_id": 100}],
    )
    assert rows(VENTAS.query(m, ["Producto"], ["Pedidos", "Venta"], currencies=None)) == [("Pan", 1, Decimal("7.00"))]


def test_conditions(mart):
    m = mart([sale(1, 1, "2024-01-01"), sale(2, 2, "2024-02-29"), sale(3, 4, "2024-03-01", team_id=2),
              sale(4, 8, "2023-02-28", team_id=None)])

    def total(**where):
        return VENTAS.query(m, [], ["Venta"], where=where, currencies=None).first()[0]

    assert total(Fecha=Between(dt.date(2024, 1, 1), dt.date(2024, 2, 29))) == 3
    assert total(Fecha=Between(None, dt.date(2024, 1, 31))) == 9
    assert total(Fecha=Between(dt.date(2024, 2, 1))) == 6
    assert total(Fecha=Between()) == 15
    assert total(Fecha=dt.date(2024, 3, 1)) == 4
    assert total(Fecha=[dt.date(2024, 3, 1), dt.date(2023, 2, 28)]) == 12
    assert total(Fecha=lambda c: c > "2024-01-31") == 6
    assert total(Fecha=None) is None
    assert total(**{"Mes inicio": dt.datetime(2024, 2, 1)}) == 2
    assert total(Anio=[2023, 2024], Mes=[2]) == 10
    assert total(Zona="Zona Sur") == 4
    assert total(Zona=lambda c: c.startswith("Zona")) == 7
    assert total(Zona="Nada") is None


def test_empty_totals(mart):
    row = VENTAS.query(mart(), [], MEASURES, currencies=None).first()
    assert row["Venta"] is None and row["Ticket promedio"] is None
    assert (row["Pedidos"], row["Clientes"]) == (0, 0)


def test_mixed_currencies_are_flagged(mart):
    m = mart([sale(1, 10), sale(2, 5, currency_id=2), sale(3, 1, team_id=2)])
    flagged = rows(VENTAS.query(m, ["Zona"], ["Venta"], currencies="flag"))
    assert sorted((r[0], r[2]) for r in flagged) == [("Zona Norte", 2), ("Zona Sur", 1)]
    mixed = VENTAS.query(m, ["Zona"], ["Venta"], currencies="raise")
    with pytest.raises(Exception, match="different currencies"):
        rows(mixed)
    fine = VENTAS.query(m, ["Zona", "Moneda"], ["Venta"], currencies="raise")
    assert fine.columns == ["Zona", "Moneda", "Venta"] and len(rows(fine)) == 3


def test_a_list_may_name_null(mart):
    m = mart([sale(1, 10), sale(2, 20, team_id=2), sale(3, 40, team_id=None)])
    found = VENTAS.query(m, ["Zona"], ["Venta"], where={"Zona": [None, "Zona Sur"]}, currencies=None)
    assert {r[0] for r in rows(found)} == {None, "Zona Sur"}
    days = VENTAS.query(m, [], ["Venta"], where={"Fecha": [None, dt.date(1990, 1, 1)]}, currencies=None)
    assert rows(days) == [(None,)]


def test_order_limit_and_metadata(mart):
    m = mart([sale(1, 10), sale(2, 20, team_id=2), sale(3, 20, team_id=None)])
    top = VENTAS.query(m, ["Zona"], ["Venta"], order_by=[("Venta", "desc")], limit=2, currencies=None)
    assert [r[0] for r in rows(top)] == [None, "Zona Sur"]
    field = VENTAS.query(m, ["Zona"], ["Venta"], currencies=None).schema["Venta"]
    assert field.metadata["format"]["currency_code"] == "HNL" and field.metadata["comment"]


def test_two_years_side_by_side(mart):
    m = mart([sale(1, 150, "2024-01-05"), sale(2, 100, "2023-01-05"), sale(3, 1, "2023-02-05")])
    assert rows(dashboard.monthly_two_years(m, 2024)) == [
        (1, Decimal("150.00"), Decimal("100.00"), Decimal("50.0")),
        (2, None, Decimal("1.00"), None),
    ]


# ------------------------------------------------------------------ vocabulary, scope


def test_terms_resolve_without_case_or_accents():
    assert vocabulary.resolve(VENTAS, " GERENTE ") == ["Gerente"]
    assert vocabulary.resolve(VENTAS, "jefe de zona") == ["Gerente"]
    assert vocabulary.resolve(VENTAS, "ano") == ["Anio"]
    assert vocabulary.resolve(VENTAS, "mes") == ["Mes"]
    assert vocabulary.resolve(VENTAS, "periodo mensual") == ["Mes inicio"]
    assert vocabulary.resolve(VENTAS, "facturación") == ["Venta"]
    assert vocabulary.resolve(VENTAS, "nada") == []
    assert vocabulary.resolve_column("articulo") == ["product"]
    assert vocabulary.resolve_column("on_hand") == ["on_hand"]


def test_vocabulary_catalog(spark):
    terms = vocabulary.catalog(spark, VENTAS)
    names = {(r.kind, r.name) for r in terms.collect()}
    assert len([n for n in names if n[0] == "dimension"]) == 13
    assert len([n for n in names if n[0] == "measure"]) == 6
    money = terms.filter("name = 'Venta'").select("currency").distinct().collect()
    assert [r[0] for r in money] == ["HNL"]


def test_entity_values_and_match(mart):
    m = mart([sale(1, 10), sale(2, 5, state="draft", partner_id=2)])
    values = vocabulary.entity_values(m, VENTAS)
    found = sorted(rows(values))
    assert ("Cliente", "Ana") in found and ("Cliente", "Berta") not in found
    assert ("Zona", "Zona Norte") in found and ("Departamento", "Cortés") in found
    assert len(found) == len(set(found))
    assert len(rows(vocabulary.match_entity(values, "cortes"))) == len(found)
    assert len(rows(vocabulary.match_entity(values, "cortes", limit=2))) == 2
    near = vocabulary.match_entity(values, "cortes", max_distance=3)
    assert rows(near) == [("Departamento", "Cortés", 0)]
    assert rows(vocabulary.match_entity(values, "zona nrte"))[0] == ("Zona", "Zona Norte", 1)
    assert rows(vocabulary.match_entity(values, "xxxxxxxxxx", 3)) == []


def test_managers_see_their_zones_only(mart):
    m = mart([sale(1, 10), sale(2, 20, team_id=2), sale(3, 40, team_id=None)])
    north = scope.ScopedStar(m, scope.managed_zones(m, "vera@x"))
    assert rows(VENTAS.query(north, ["Zona"], ["Venta"], currencies=None)) == [("Zona Norte", Decimal("10.00"))]
    assert rows(VENTAS.query(scope.ScopedStar(m, scope.managed_zones(m, "x")), ["Zona"], ["Venta"], currencies=None)) == []


def test_tenants_are_united(mart):
    one, two = mart([sale(1, 10)]), mart([sale(1, 5), sale(2, 6)])
    both = scope.union_tenants({"a": one.fact_sales, "b": two.fact_sales})
    assert both.columns[0] == "tenant"
    assert sorted(rows(both.groupBy("tenant").count())) == [("a", 1), ("b", 2)]


def test_currencies_are_flagged_unless_asked_not_to(mart):
    m = mart([sale(1, 10), sale(2, 20, currency_id=2)])
    flagged = VENTAS.query(m, [], ["Venta"])
    assert flagged.columns == ["Venta", "currencies"] and flagged.first()["currencies"] == 2
    by_currency = VENTAS.query(m, ["Moneda"], ["Venta"])
    assert {r["currencies"] for r in by_currency.collect()} == {1}
    assert VENTAS.query(m, [], ["Venta"], currencies=None).columns == ["Venta"]
