"""What the plans must look like for large data, and that hot keys are split."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.operators import assets, gold
from starmart.plans import scope, sqlfunctions
from starmart.plans.mart import GOLD, GoldTables, Mart, write_gold
from starmart.plans.metrics import Between
from starmart.plans.ventas import VENTAS
from starmart.sources.retail import ConformedTables, RetailSource
from tests.conftest import SF_DIR, rows, sale

YEAR = (dt.date(1997, 3, 1), dt.date(1997, 12, 31))


@pytest.fixture(scope="module")
def star(spark):
    cfg = MartConfig(gold_schema=f"scale_{uuid.uuid4().hex[:8]}", as_of=dt.date(2001, 8, 2))
    spark.sql(f"CREATE SCHEMA {cfg.schema('gold')}")
    mart = Mart(ConformedTables(RetailSource(spark, SF_DIR)), cfg)
    for name in GOLD:
        write_gold(getattr(mart, name), cfg.table("gold", name))
    return GoldTables(spark, cfg)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before[name] = spark.conf.get(name)
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def plan(df, final=False) -> str:
    execution = df._jdf.queryExecution()
    if final:
        df.collect()
    return execution.executedPlan().toString()


def scan_of(text: str, table: str) -> list[str]:
    return [ln for ln in text.splitlines() if "FileScan" in ln and f"{table}[" in ln]


def test_a_period_prunes_months_and_pushes_filters(star):
    (scan,) = scan_of(plan(assets.sales_by_territory(star, *YEAR)), "fact_sales")
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert "sale_year" in partition_filters and "sale_month" in partition_filters
    assert "EqualTo(order_status,sale)" in scan
    assert "sale_date,1997-03-01" in scan and "sale_date,1997-12-31" in scan
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert {f.split(":")[0] for f in read.split(",") if ":" in f} == {
        "order_id", "sale_date", "order_status", "territory_id", "subtotal"
    }
    for question in (
        assets.stockout_risk(star),
        VENTAS.query(star, ["Zona"], ["Venta"], where={"Fecha": Between(*YEAR)}, currencies=None),
        VENTAS.query(star, ["Zona"], ["Venta"], where={"Fecha": YEAR[0]}, currencies=None),
        VENTAS.query(star, [], ["Venta"], where={"Mes inicio": dt.datetime(1997, 3, 1)}, currencies=None),
        assets.sales_year_over_year(star, 2001),
    ):
        (scan,) = scan_of(plan(question), "fact_sales")
        assert "PartitionFilters: []" not in scan


def test_months_outside_the_period_are_not_read(star):
    whole = star.fact_sales.select(F.input_file_name()).distinct().count()
    year = VENTAS.query(star, [], ["Venta"], where={"Fecha": Between(*YEAR)}, currencies=None)
    year.collect()
    period = star.fact_sales.filter(
        F.col("sale_date").between(*YEAR) & assets.months_between_dates(*YEAR)
    )
    assert period.select(F.input_file_name()).distinct().count() <= 10 < whole


def test_only_named_dimensions_are_joined(star):
    text = plan(VENTAS.query(star, ["Zona"], ["Venta"], currencies=None))
    assert scan_of(text, "dim_territory")
    assert not any(scan_of(text, t) for t in ("dim_customer", "dim_product", "dim_salesperson"))
    text = plan(VENTAS.query(star, ["Anio", "Moneda"], ["Venta", "Pedidos"], currencies=None))
    assert "Join" not in text


@pytest.mark.parametrize(
    "question",
    [
        lambda s: assets.sales_by_territory(s, *YEAR),
        lambda s: assets.top_salespeople(s, *YEAR),
        lambda s: assets.top_products(s, *YEAR),
        lambda s: assets.sales_by_state(s, *YEAR),
        lambda s: assets.lapsed_customers(s),
        lambda s: assets.stockout_risk(s),
        lambda s: VENTAS.query(s, ["Cliente", "Zona"], ["Venta", "Pedidos", "Clientes"], currencies=None),
        lambda s: VENTAS.query(s, ["Categoria"], ["Venta", "Unidades"], currencies=None),
        lambda s: VENTAS.query(s, ["Mes"], ["Venta", "Pedidos"], currencies="flag"),
    ],
)
def test_the_fact_is_aggregated_before_any_join_or_shuffle(star, conf, question):
    """Between the scan of the fact and the first exchange above it stands an aggregate."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    first = next(ln for ln in above_fact(question(star)) if re.search(STEPS, ln))
    assert "Aggregate" in first and ("partial_" in first or "functions=[]" in first)


@pytest.mark.parametrize(
    "dimensions, measures, tables",
    [
        (["Producto", "Categoria"], ["Pedidos", "Clientes", "Venta"], 2),
        (["Ciudad", "Categoria"], ["Pedidos", "Venta"], 2),
        (["Zona", "Vendedor", "Producto"], ["Pedidos", "Clientes"], 4),
    ],
)
def test_only_products_are_joined_to_fact_rows(star, conf, dimensions, measures, tables):
    """One join below the first aggregate, the other tables after the second."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    steps = re.findall(
        "Join|Aggregate",
        " ".join(
            ln.split("(")[0] for ln in above_fact(VENTAS.query(star, dimensions, measures, currencies=None))
        ),
    )
    assert steps.count("Join") == tables
    assert steps.index("Aggregate") == 1 and steps[1:].index("Join") >= 4


STEPS = r"Exchange|Join|Aggregate"


def above_fact(question) -> list[str]:
    """The plan's nodes from the scan of the fact upwards."""
    text = plan(question).splitlines()
    (at,) = [i for i, ln in enumerate(text) if "FileScan" in ln and "fact_sales[" in ln]
    above = []
    depth = len(re.match(r"[ :|+\-]*", text[at]).group())
    for ln in reversed(text[:at]):
        here = len(re.match(r"[ :|+\-]*", ln).group())
        if here < depth:
            depth = here
            above.append(ln)
    return above


def test_distinct_counts_do_not_expand_rows(star):
    everything = [m.name for m in VENTAS.measures]
    for dimensions in ([], ["Zona"], ["Producto"], ["Cliente", "Categoria"], ["Mes"]):
        text = plan(VENTAS.query(star, dimensions, everything, currencies=None))
        assert "Expand" not in text, dimensions


def test_rankings_keep_only_the_top_rows(star):
    assert "TakeOrderedAndProject(limit=15" in plan(assets.top_products(star, *YEAR))
    assert "Window" not in plan(assets.top_salespeople(star, *YEAR))


def test_a_long_ranking_takes_the_top_of_each_part_first(spark, star):
    sqlfunctions.register(spark, star)
    top = spark.sql("SELECT * FROM top_products(DATE'1997-01-01', DATE'1997-12-31', 2000)")
    text = plan(top).split("SinglePartition")[-1]
    assert "WindowGroupLimit" in text or "Filter (near" in text


def test_a_managers_zones_are_broadcast(spark, star):
    """With many zones and sellers the fact is not shuffled to find the rows of one manager."""
    many = GoldTables(spark, star.cfg)
    many.dim_territory = spark.range(200).select(
        F.col("id").alias("territory_id"), F.lit("z").alias("territory"),
        F.col("id").alias("manager_id"), F.lit("m").alias("manager"),
    )
    many.dim_salesperson = spark.range(20_000).select(
        F.col("id").alias("salesperson_id"), F.concat(F.lit("u"), "id").alias("email")
    )
    text = plan(scope.ScopedStar(many, scope.managed_zones(many, "u7")).fact_sales)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2


def test_line_ids_are_unique(spark):
    for size in ("0.001", "0.01", "0.1"):
        ids = RetailSource(spark, f"/root/testdata/sf{size}")["sale_order_line"].select("id")
        assert ids.count() == ids.distinct().count(), size


def test_fact_files_are_sorted_once(spark, star):
    df = star.fact_sales.hint("rebalance", *gold.FACT_PARTITIONS)
    df = df.sortWithinPartitions(*gold.FACT_PARTITIONS, "sale_date")
    assert plan(df).count("Sort [") == 1
    files = star.fact_sales.select("sale_year", "sale_month", F.input_file_name()).distinct()
    assert files.count() == star.fact_sales.select(*gold.FACT_PARTITIONS).distinct().count()


def test_a_hot_order_is_split(spark, conf):
    """One order holds a third of all lines: AQE splits its partition, rows stay whole."""
    conf(
        spark__sql__shuffle__partitions="8",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    lines = spark.range(0, n, numPartitions=16).select(
        F.col("id").alias("line_id"),
        hot.alias("order_id"),
        F.lit(1).cast("bigint").alias("product_id"),
        F.lit(1).cast("decimal(18,3)").alias("quantity"),
        F.lit(0).cast("decimal(18,3)").alias("quantity_delivered"),
        F.lit(1).cast("decimal(18,4)").alias("unit_price"),
        F.lit(0).cast("decimal(9,4)").alias("discount_pct"),
        (F.hash("id") % 10000 / 100).cast("decimal(18,2)").alias("subtotal"),
        F.lit(1).cast("decimal(18,2)").alias("total_with_tax"),
    )
    orders = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.lit("S").alias("order_ref"),
        F.lit("2024-01-05").cast("timestamp").alias("ordered_at"),
        F.lit("sale").alias("order_status"),
        F.lit("HNL").alias("currency"),
        F.lit(1).cast("bigint").alias("customer_id"),
        F.lit(1).cast("bigint").alias("salesperson_id"),
        F.lit(1).cast("bigint").alias("territory_id"),
    )
    fact = gold.fact_sales(lines, orders)
    assert "skew=true" in plan(fact, final=True)
    assert fact.count() == n
    # Also where a later aggregation could have reused the join's partitioning.
    by_order = fact.groupBy("order_id").agg(F.sum("subtotal"), F.count("*").alias("n"))
    assert "skew=true" in plan(by_order, final=True)
    assert rows(by_order.filter("order_id = 1").select("n")) == [(n // 3 + 1,)]


def test_a_hot_customer_is_split_in_the_wide_view(spark, conf, star):
    conf(
        spark__sql__shuffle__partitions="8",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    fact = star.fact_sales.repartition(16).withColumn(
        "customer_id", F.when(F.col("line_id") % 3 == 0, None).otherwise(F.col("customer_id"))
    )
    wide = gold.sales_metrics(
        fact, star.dim_customer, star.dim_territory, star.dim_salesperson, star.dim_product
    )
    assert "skew=true" in plan(wide, final=True)
    assert wide.count() == star.fact_sales.count()


def test_sales_metrics_move_lines_without_the_names_of_their_order(spark, mart):
    star = mart([sale(1, 10), sale(2, 20, partner_id=None, team_id=9), sale(3, 30, product_id=2, user_id=77)])
    fact = gold.sales_metrics(
        star.fact_sales, star.dim_customer, star.dim_territory, star.dim_salesperson, star.dim_product
    )
    assert Counter(map(tuple, star.sales_metrics.collect())) == Counter(map(tuple, fact.collect()))
    assert star.sales_metrics.columns == fact.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = mart([sale(1, 10)]).sales_metrics._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the last join is that of lines and orders: nothing that holds both is moved again
    assert "order_id" in next(x for x in plan.splitlines() if "Join" in x)


def test_inventory_is_dealt_by_product_before_it_is_added_up(spark):
    stock = Mart(ConformedTables(RetailSource(spark, SF_DIR))).silver_inventory
    plan = stock._jdf.queryExecution().executedPlan().toString()
    # read from the result down: both halves of the aggregation stand above the exchange
    steps = re.findall(r"HashAggregate|Exchange hashpartitioning\(product_id", plan)
    assert steps == ["HashAggregate", "HashAggregate", "Exchange hashpartitioning(product_id"], plan
