"""Tenants with schemas of their own."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import connect, differences, oracle_rows, spark_rows
from starmart.config import MartConfig
from starmart.operators import assets
from starmart.plans.mart import write_table
from starmart.plans.tenants import Tenants
from starmart.session import small_table
from tests.conftest import SF_DIR


def files_of(tenants: Tenants, tenant: str) -> dict[str, int]:
    own = tenants.configs[tenant].gold_schema
    found = Path(tenants._folder).glob(f"{own}_v*/**/*.parquet")
    return {str(f): f.stat().st_mtime_ns for f in found}


def test_rebuilding_one_tenant_leaves_the_other(spark):
    tenants, sources = entry.tenants_of(spark, SF_DIR)
    for tenant, source in sources.items():
        tenants.land(tenant, source)
        tenants.build(tenant)
    before = {t: files_of(tenants, t) for t in sources}
    assert all(before.values())

    half = sources["HNL"]["sale_order"].where(F.col("id").cast("bigint") < 3000)
    tenants.land("HNL", {**sources["HNL"], "sale_order": half})
    tenants.build("HNL")
    after = {t: files_of(tenants, t) for t in sources}
    assert after["USD"] == before["USD"] and after["HNL"] != before["HNL"]

    sales = tenants.table("fact_sales")
    per = dict(sales.groupBy("tenant").count().collect())
    assert set(per) == {"HNL", "USD"}

    # a filter on the tenant leaves only its files in the plan
    read = sales.where("tenant = 'USD'").inputFiles()
    assert read and all(tenants.configs["USD"].gold_schema in f for f in read)
    # a column that only one of them has
    both = tenants.ask(
        lambda star: assets.confirmed(star).withColumn("extra", F.lit(1))
        if star.cfg.currency == "USD"
        else assets.confirmed(star)
    )
    assert dict(both.groupBy("tenant").agg(F.max("extra")).collect()) == {"HNL": None, "USD": 1}


def test_shared_schemas_are_refused(spark):
    one, two = (MartConfig(currency=c, bronze_schema="b", silver_schema=f"s{c}", gold_schema=f"g{c}") for c in ("HNL", "USD"))
    with pytest.raises(ValueError, match="more than one tenant"):
        Tenants(spark, {"a": one, "b": two})


def test_joins_size_written_tables_by_their_rows(spark, tmp_path):
    """A broadcast goes through the driver: files of 1 MB must not bring 60 MB of rows there."""
    name = f"sized_{tmp_path.name}".replace("-", "_")
    alike = [f"repeat('x', 20) AS c{k}" for k in range(8)]
    write_table(spark.range(200_000).selectExpr("CAST(id AS STRING) AS id", *alike), name)
    try:
        files = [Path(f.removeprefix("file:")) for f in spark.table(name).inputFiles()]
        assert 0 < sum(f.stat().st_size for f in files) < 5_000_000
        both = spark.table(name).join(spark.table(name).withColumnRenamed("c0", "c"), "id")
        plan = both._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
        # a few of its rows are still broadcast
        few = small_table(spark, [("1",)], "id string")
        plan = spark.table(name).join(few, "id")._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan, plan
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_orders_of_a_tenant_are_not_broadcast_to_its_lines(spark):
    _, sources = entry.tenants_of(spark, SF_DIR)
    for source in sources.values():
        plan = source["sale_order_line"]._jdf.queryExecution().sparkPlan().toString()
        assert re.search(r"SortMergeJoin \[order_id#\d+\], \[order_id#\d+\], LeftSemi", plan), plan


def test_query(spark):
    have = spark_rows(entry.queries()["tenant_schemas"](spark, SF_DIR))
    assert have[1] and differences(have, oracle_rows(connect(SF_DIR), entry.ORACLES["tenant_schemas"])) == []
