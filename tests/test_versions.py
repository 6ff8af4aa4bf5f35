"""Publication by version: what readers see before, during and after."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from starmart import contract
from starmart.config import MartConfig
from starmart.operators import constraints
from starmart.plans import mart as marts
from starmart.plans.mart import GOLD, CatalogTables, GoldTables, build_all, write_table
from starmart.plans.versions import Publication, current_schema, current_version
from tests.conftest import rows, sale

YEAR = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def names() -> MartConfig:
    tag = uuid.uuid4().hex[:8]
    return MartConfig(bronze_schema=f"b_{tag}", silver_schema=f"s_{tag}", gold_schema=f"g_{tag}")


@pytest.fixture
def layer(spark):
    return Publication(spark, f"layer_{uuid.uuid4().hex[:8]}")


def put(layer, **tables):
    spark = layer._spark
    make = {
        name: (lambda n=n: spark.range(n).toDF("id")) if isinstance(n, int) else n
        for name, n in tables.items()
    }
    return layer.publish(make, write_table)


def fail():
    raise LookupError("half way")


def sizes(spark, schema):
    return {t.name: spark.table(f"{schema}.{t.name}").count() for t in spark.catalog.listTables(schema) if not t.isTemporary}


def test_views_follow_the_version(spark, layer):
    assert current_version(spark, layer.schema) is None
    assert current_schema(spark, layer.schema) == layer.schema
    assert put(layer, a=1, b=2) == 1 and sizes(spark, layer.schema) == {"a": 1, "b": 2}
    assert put(layer, a=3, c=4) == 2 and sizes(spark, layer.schema) == {"a": 3, "c": 4}
    assert current_schema(spark, layer.schema) == f"{layer.schema}_v2"


def test_a_failed_publication_changes_nothing(spark, layer):
    put(layer, a=1, b=2)
    with pytest.raises(LookupError):
        put(layer, a=9, b=fail)
    assert sizes(spark, layer.schema) == {"a": 1, "b": 2} and layer.versions() == [1]
    assert put(layer, a=5, b=6) == 2


def test_a_reader_keeps_its_version_until_it_is_pruned(spark, layer):
    cfg = MartConfig(bronze_schema=layer.schema)
    put(layer, a=1)
    first = CatalogTables(spark, cfg, "bronze", ["a"])
    put(layer, a=2)
    second = CatalogTables(spark, cfg, "bronze", ["a"])
    assert (first["a"].count(), second["a"].count()) == (1, 2) and layer.versions() == [1, 2]
    put(layer, a=3)
    assert second["a"].count() == 2 and layer.versions() == [2, 3]


def test_views_can_be_set_again_after_a_crash_between_switch_and_views(spark, layer, monkeypatch):
    put(layer, a=1)
    monkeypatch.setattr(Publication, "point_views", fail)
    with pytest.raises(TypeError):
        put(layer, a=2)
    monkeypatch.undo()
    assert current_version(spark, layer.schema) == 2
    assert spark.table(f"{current_schema(spark, layer.schema)}.a").count() == 2
    layer.point_views()
    assert sizes(spark, layer.schema) == {"a": 2}


def test_two_builds_stage_apart_and_the_current_version_is_not_discarded(spark, layer):
    one, two = layer.stage(), layer.stage()
    assert one != two
    write_table(spark.range(7).toDF("id"), f"{layer.staged(two)}.a")
    layer.switch(two)
    assert sizes(spark, layer.schema) == {"a": 7}
    with pytest.raises(ValueError, match="current"):
        layer.discard(two)
    layer.discard(one)
    assert layer.versions() == [two]


def test_a_temporary_view_of_the_same_name_is_none_of_its_tables(spark, layer):
    spark.range(99).createOrReplaceTempView("a")
    put(layer, a=1, b=2)
    spark.catalog.dropTempView("a")
    assert sizes(spark, layer.schema) == {"a": 1, "b": 2}


def test_plain_tables_from_before_give_way_to_views(spark, layer):
    spark.sql(f"CREATE SCHEMA {layer.schema}")
    write_table(spark.range(3).toDF("id"), f"{layer.schema}.a", "it's old")
    put(layer, a=4)
    assert sizes(spark, layer.schema) == {"a": 4}
    assert {t.tableType for t in spark.catalog.listTables(layer.schema) if not t.isTemporary} == {"VIEW"}


def test_a_rebuild_stopped_midway_leaves_the_old_star(spark, bronze, monkeypatch):
    cfg = names()
    lake = Publication(spark, cfg.schema("bronze"))

    def load(*sales, **tables):
        found = bronze(sale_order=[o for o, _ in sales], sale_order_line=[ln for _, ln in sales], **tables)
        lake.publish({t: (lambda t=t: found[t]) for t in contract.TABLE_NAMES}, write_table)

    def star():
        gold = GoldTables(spark, cfg)
        seen = {name: sorted(rows(getattr(gold, name)), key=repr) for name in GOLD}
        for name in GOLD:  # the views agree
            assert sorted(rows(spark.table(cfg.table("gold", name))), key=repr) == seen[name]
        return seen

    load(sale(1, 10), sale(2, 5))
    build_all(spark, cfg)
    before = star()
    load(sale(1, 10), sale(2, 5), sale(3, 7))
    real, count = marts.write_gold, []

    def dies(df, name):
        count.append(name)
        if len(count) == 3:
            raise OSError("executor and driver lost")
        real(df, name)

    monkeypatch.setattr(marts, "write_gold", dies)
    with pytest.raises(OSError):
        build_all(spark, cfg)
    assert len(count) >= 3 and star() == before
    monkeypatch.undo()
    load(sale(1, 10), sale(4, 7, partner_id=99))
    with pytest.raises(constraints.ConstraintViolation):
        build_all(spark, cfg)
    assert star() == before
    load(sale(1, 10), sale(2, 5), sale(3, 7))
    build_all(spark, cfg)
    assert len(star()["fact_sales"]) == 3
    assert len(Publication(spark, cfg.schema("gold")).versions()) == 2
