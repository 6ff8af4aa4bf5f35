from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart import contract
from starmart.config import MartConfig, current_quarter, current_year
from starmart.sources import jdbc
from starmart.sources.landing import row_counts

import datetime as dt

from tests.conftest import rows


def test_contract_size():
    assert len(contract.TABLES) == 17
    assert sum(map(len, contract.TABLES.values())) == 82
    assert set(contract.schema("uom_uom").fieldNames()) == {"id", "name"}


def test_conform_absorbs_drift(spark):
    source = spark.sql("SELECT 'HNL' AS NAME, 7 AS Extra, 5 AS ID, true AS unused")
    bronze = contract.conform(source, "res_company")
    assert bronze.dtypes == [("id", "string"), ("name", "string"), ("currency_id", "string")]
    assert rows(bronze) == [("5", "HNL", None)]


def test_conform_keeps_values_as_text(spark):
    source = spark.sql(
        "SELECT 1 AS id, named_struct('es_ES', 'a,\"b') AS name, CAST(1.50 AS DECIMAL(9,2)) "
        "AS categ_id, true AS active, false AS sale_ok"
    )
    (row,) = contract.conform(source, "product_template").collect()
    assert row.name == '{"es_ES":"a,\\"b"}'
    assert (row.categ_id, row.active, row.sale_ok, row.uom_id) == ("1.50", "true", "false", None)


def test_missing_columns_and_tables():
    assert contract.missing_columns("uom_uom", ["ID"]) == ["name"]
    contract.require_tables([t.upper() for t in contract.TABLES])
    with pytest.raises(contract.MissingTables, match="crm_team, uom_uom"):
        contract.require_tables(set(contract.TABLES) - {"uom_uom", "crm_team"})


def test_conformance_report(spark, bronze):
    source = dict(bronze(sale_order=[], uom_uom=[{"id": 1}, {"id": 2}]))
    source["sale_order"] = source["sale_order"].drop("name", "client_order_ref")
    report = contract.conformance(
        spark, contract.introspect(source), row_counts(source, sorted(source))
    )
    by_table = {r.table_name: r for r in report.collect()}
    assert len(by_table) == 17
    drifted = by_table["sale_order"]
    assert (drifted.status, drifted.missing) == ("drift", "client_order_ref, name")
    assert (by_table["uom_uom"].status, by_table["uom_uom"].rows) == ("full", 2)
    assert contract.verdict(report) == (16, 17)

    del source["crm_team"]
    report = contract.conformance(
        spark, contract.introspect(source), row_counts(source, sorted(source))
    )
    assert report.filter("table_name = 'crm_team'").first().status == "absent"
    with pytest.raises(contract.MissingTables, match="crm_team"):
        contract.verdict(report)


def test_jdbc_queries_ask_only_for_the_contract():
    assert "'sale_order'" in jdbc.columns_query() and "table_schema = 'public'" in jdbc.columns_query()
    query = jdbc.table_query("res_company", ["ID", "name", "other"])
    assert 'CAST("ID" AS text) AS "id"' in query and "other" not in query
    assert "currency_id" not in query
    assert 'FROM "erp"."res_users"' in jdbc.bounds_query("res_users", "erp")


def test_config_validation():
    assert MartConfig.for_target("dev").table("gold", "x") == "gold_dev.x"
    assert MartConfig.for_target("prod", catalog="lake").schema("gold") == "lake.gold"
    for wrong in ({"currency": "hnl"}, {"gold_schema": "a b"}, {"locales": ()}, {"catalog": "a.b"}):
        with pytest.raises(ValueError):
            MartConfig(**wrong)
    with pytest.raises(ValueError, match="target"):
        MartConfig.for_target("staging")


def test_periods():
    assert current_year(dt.date(2024, 5, 6)) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert current_quarter(dt.date(2024, 5, 6)) == (dt.date(2024, 4, 1), dt.date(2024, 6, 30))
    assert current_quarter(dt.date(2024, 12, 31)) == (dt.date(2024, 10, 1), dt.date(2024, 12, 31))


def test_local_metadata_has_a_known_size(spark):
    from starmart.session import small_table

    df = small_table(spark, [(1, None), (2, "b")], "id bigint, name string")
    assert rows(df.orderBy("id")) == [(1, None), (2, "b")]
    joined = spark.range(10).join(df, "id")
    plan = joined.select(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
