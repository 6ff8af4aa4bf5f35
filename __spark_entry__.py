
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import lru_cache, partial
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracle import ORACLES
from starmart import contract
from starmart.config import MONEY, MartConfig
from starmart.functions.text import txt
from starmart.operators import assets, audit
from starmart.operators.quarantine import Quarantine
from starmart.operators.ranking import numbered
from starmart.plans import dashboard, scope, sqlfunctions, vocabulary
from starmart.plans.mart import CatalogTables, Mart, UncheckedMart, write_table
from starmart.plans.metrics import Between
from starmart.plans.rollup import Rollup
from starmart.plans.tenants import LAYERS, Tenants
from starmart.plans.ventas import VENTAS
from starmart.plans.versions import Publication
from starmart.session import configure, run_jobs, shared_dir
from starmart.sources.landing import land_table, read_landed, row_counts
from starmart.sources.retail import (
    AlteredTables,
    ConformedTables,
    FaultyTables,
    RetailSource,
    SpoiledTables,
    order_changes,
)
from starmart.streaming.buckets import Buckets, StateLane
from starmart.streaming.changes import ChangeLane, apply_changes

# The given orders end on 2001-08-01; questions that read the clock are asked a day later.
AS_OF = dt.date(2001, 8, 2)
KPI_DAY = dt.date(2001, 7, 15)
YEAR = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))
PERIOD = {"Fecha": Between(*YEAR)}
SNAPSHOT_LSN = 10**12

Query = Callable[[SparkSession, str], DataFrame]


def _source(spark: SparkSession, sf_dir: str) -> RetailSource:
    return RetailSource(configure(spark), sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> ConformedTables:
    return ConformedTables(_source(spark, sf_dir))


@lru_cache(maxsize=16)
def _mart(spark: SparkSession, sf_dir: str, **choices) -> Mart:
    """The lazy mart over a folder: its plans are kept between queries, never its rows."""
    return Mart(_bronze(spark, sf_dir), MartConfig(as_of=AS_OF, **choices))


def _plain(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores, and timestamps without a zone."""
    kinds = dict(df.dtypes)
    return df.select(
        [
            (F.col(f"`{c}`").cast("timestamp_ntz") if kinds[c] == "timestamp" else F.col(f"`{c}`"))
            .alias(c.lower().replace(" ", "_"))
            for c in df.columns
        ]
    )


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(MONEY) for c in columns})


# ------------------------------------------------------------------------------ Bronze


def bronze_rowcounts(spark, sf_dir):
    return row_counts(_bronze(spark, sf_dir))


def _drifted_orders(spark, sf_dir) -> DataFrame:
    """Orders from a source version without a column, with another, and other name case."""
    orders = _source(spark, sf_dir)["sale_order"].drop("client_order_ref")
    return orders.withColumn("note", F.lit("extra")).toDF(
        *[c.upper() for c in orders.columns], "note"
    )


def bronze_conform_drift(spark, sf_dir):
    return contract.conform(_drifted_orders(spark, sf_dir), "sale_order")


def contract_conformance(spark, sf_dir):
    source = dict(_source(spark, sf_dir))
    source["sale_order"] = _drifted_orders(spark, sf_dir)
    del source["product_pricelist"]
    counts = row_counts(source, sorted(source))
    return contract.conformance(spark, contract.introspect(source), counts)


def source_target_reconcile(spark, sf_dir):
    source = _source(spark, sf_dir)
    return audit.reconcile(source, ConformedTables(source))


def _landed(spark, source, tables) -> dict[str, DataFrame]:
    """Tables written as JSON Lines to the shared folder and read back as they landed."""
    folder = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    run_jobs({table: partial(land_table, source[table], table, folder) for table in tables})
    return {table: read_landed(spark, table, folder) for table in tables}


def landing_round_trip(spark, sf_dir):
    return _landed(spark, _source(spark, sf_dir), ["sale_order"])["sale_order"]


def reconcile_faulty(spark, sf_dir):
    """The source against a landing with rows lost, repeated and added."""
    source = _bronze(spark, sf_dir)
    return audit.reconcile(source, _landed(spark, FaultyTables(source), audit.RECONCILED))


def reconcile_rows(spark, sf_dir):
    """Each row that a landing lost, added or altered."""
    source = _bronze(spark, sf_dir)
    faulty = AlteredTables(FaultyTables(source))
    return audit.reconcile_content(source, _landed(spark, faulty, audit.RECONCILED))


def company_currency_audit(spark, sf_dir):
    return audit.company_currencies(_bronze(spark, sf_dir))


def bronze_cdc_apply(spark, sf_dir):
    orders = _bronze(spark, sf_dir)["sale_order"]
    changes = order_changes(orders, SNAPSHOT_LSN)
    return apply_changes(orders, changes, "sale_order", SNAPSHOT_LSN)


def bronze_cdc_stream(spark, sf_dir):
    """The same change feed as files, ingested by the streaming lane."""
    orders = _bronze(spark, sf_dir)["sale_order"]
    folder = f"{shared_dir(spark)}/cdc-{uuid.uuid4().hex}"
    order_changes(orders, SNAPSHOT_LSN).write.json(f"{folder}/feed")
    lane = ChangeLane(spark, folder)
    lane.start(lane.read_feed(f"{folder}/feed")).awaitTermination()
    return lane.current("sale_order", orders, SNAPSHOT_LSN)


def bronze_cdc_buckets(spark, sf_dir):
    """The change feed applied to hash buckets of the id, the later half of it first."""
    orders = _bronze(spark, sf_dir)["sale_order"]
    changes = order_changes(orders, SNAPSHOT_LSN)
    folder = f"{shared_dir(spark)}/buckets-{uuid.uuid4().hex}"
    bronze = Buckets(spark, folder, tables=["sale_order"], snapshot_lsn=SNAPSHOT_LSN)
    bronze.load("sale_order", orders)
    late = F.col("lsn") % 10 > 2
    bronze.apply(changes.where(late))
    bronze.apply(changes.where(~late))
    return bronze.current("sale_order")


def bronze_cdc_state(spark, sf_dir):
    """The feed in two deliveries, each row's latest change held in a state store between them."""
    orders = _bronze(spark, sf_dir)["sale_order"]
    changes = order_changes(orders, SNAPSHOT_LSN)
    folder = f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"
    bronze = Buckets(spark, folder, tables=["sale_order"], snapshot_lsn=SNAPSHOT_LSN)
    bronze.load("sale_order", orders)
    lane = StateLane(spark, folder, bronze)
    late = F.col("lsn") % 10 > 2
    for delivery in (late, ~late):
        feed = changes.where(delivery).write.mode("append")
        feed.option("compression", "gzip").json(f"{folder}/feed")
        lane.start(ChangeLane(spark, folder).read_feed(f"{folder}/feed")).awaitTermination()
    return bronze.current("sale_order")


def bronze_versions(spark, sf_dir):
    """Orders by state for a reader from before and one from after a second publication; a
    third one, which fails when half of it is written, shows in neither."""
    source = _bronze(spark, sf_dir)
    orders = source["sale_order"]
    changes = order_changes(orders, SNAPSHOT_LSN)
    later = apply_changes(orders, changes, "sale_order", SNAPSHOT_LSN)
    name = f"bronze_{uuid.uuid4().hex}"
    layer = Publication(spark, name, f"{shared_dir(spark)}/{name}")
    cfg, tables = MartConfig(bronze_schema=name), ("sale_order", "res_currency")

    def publish(rows: DataFrame, currencies: Callable[[], DataFrame]) -> CatalogTables:
        layer.publish({"sale_order": lambda: rows, "res_currency": currencies}, write_table)
        return CatalogTables(spark, cfg, "bronze", tables)

    def broken() -> DataFrame:
        raise LookupError("no currencies")

    readers = {"before": publish(orders, lambda: source["res_currency"])}
    publish(later, lambda: source["res_currency"])
    with suppress(LookupError):
        publish(orders.limit(0), broken)
    readers["after"] = CatalogTables(spark, cfg, "bronze", tables)
    parts = [
        reader["sale_order"]
        .groupBy("state")
        .agg(F.count("*").alias("orders"), F.sum(F.col("amount_total").cast(MONEY)).cast(MONEY).alias("amount"))
        .select(F.lit(when).alias("reader"), "*")
        for when, reader in readers.items()
    ]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------------------ Silver


def localized_text(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    parts = [
        bronze[table].select(
            F.lit(table).alias("table_name"),
            F.col("id").cast("bigint").alias("id"),
            txt(column).alias("text"),
        )
        for table, column in (
            ("crm_team", "name"),
            ("res_country", "name"),
            ("product_template", "name"),
            ("product_category", "complete_name"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _view(name: str) -> Query:
    return lambda spark, sf_dir: _plain(getattr(_mart(spark, sf_dir), name))


def silver_quality_report(spark, sf_dir):
    return _mart(spark, sf_dir).quality_report()


def constraint_report(spark, sf_dir):
    return _mart(spark, sf_dir).constraint_report()


def quality_report_faulty(spark, sf_dir):
    return Mart(FaultyTables(_bronze(spark, sf_dir)), MartConfig(as_of=AS_OF)).quality_report()


def constraint_report_faulty(spark, sf_dir):
    faulty = FaultyTables(_bronze(spark, sf_dir))
    return UncheckedMart(faulty, MartConfig(as_of=AS_OF)).constraint_report()


def _quarantine(spark, sf_dir) -> Quarantine:
    """Bronze with missing keys and values that do not parse, inspected."""
    faulty = SpoiledTables(FaultyTables(_bronze(spark, sf_dir)))
    return Quarantine(spark, faulty, f"{shared_dir(spark)}/quarantine-{uuid.uuid4().hex}")


def quarantine_rows(spark, sf_dir):
    return _quarantine(spark, sf_dir).report()


def quarantine_counts(spark, sf_dir):
    return _quarantine(spark, sf_dir).counts()


def quarantine_sales(spark, sf_dir):
    """Sales by year from the rows that passed, under strict casts."""
    bronze = SpoiledTables(_bronze(spark, sf_dir))
    folder = f"{shared_dir(spark)}/quarantine-{uuid.uuid4().hex}"
    mart = Mart(Quarantine(spark, bronze, folder), MartConfig(as_of=AS_OF))
    return mart.fact_sales.groupBy("sale_year").agg(
        F.count("*").alias("n_lines"), F.sum("subtotal").cast(MONEY).alias("sales")
    )


# ----------------------------------------------------------------------------- questions


def _asset(function, *args) -> Query:
    return lambda spark, sf_dir: function(_mart(spark, sf_dir), *args)


def _sql_function(call: str) -> Query:
    def run(spark, sf_dir):
        sqlfunctions.register(spark, _mart(spark, sf_dir))
        return spark.sql(f"SELECT * FROM {call}")

    return run


def _ventas(dimensions, measures, money=(), **options) -> Query:
    options.setdefault("currencies", None)

    def run(spark, sf_dir):
        result = VENTAS.query(_mart(spark, sf_dir), dimensions, measures, **options)
        return _money(_plain(result), *money)

    return run


def mv_yoy_pivot(spark, sf_dir):
    result = dashboard.monthly_two_years(_mart(spark, sf_dir), 2001)
    return _money(_plain(result), "current", "previous").withColumn(
        "change_pct", F.col("change_pct").cast("decimal(18,1)")
    )


def mv_top_products_in_zone(spark, sf_dir):
    return _money(
        _plain(
            VENTAS.query(
                _mart(spark, sf_dir),
                ["Producto"],
                ["Venta", "Unidades"],
                where={"Zona": "Zona AFRICA", **PERIOD},
                order_by=[("Venta", "desc")],
                limit=15,
                currencies=None,
            )
        ),
        "venta",
    ).withColumn("unidades", F.col("unidades").cast("decimal(18,3)"))


def monthly_two_years(spark, sf_dir):
    result = dashboard.monthly_two_years(_mart(spark, sf_dir), 2000)
    return _money(_plain(result), "current", "previous").withColumn(
        "change_pct", F.col("change_pct").cast("decimal(18,1)")
    )


def _rollup(dimensions, measures, money=(), period=(None, None)) -> Query:
    """The question answered from monthly totals and containers of ids, built before."""

    def run(spark, sf_dir):
        folder = f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}"
        rollup = Rollup(spark, folder, _mart(spark, sf_dir), VENTAS)
        tables = [d.table for d in VENTAS.dimensions if d.name in dimensions] or None
        rollup.build(tables=tables and set(tables))
        return _money(_plain(rollup.query(dimensions, measures, *period, currencies=None)), *money)

    return run


# ---------------------------------------------------------- vocabulary, scope, tenants


def entity_values(spark, sf_dir):
    return vocabulary.entity_values(_mart(spark, sf_dir), VENTAS)


def entity_match(spark, sf_dir):
    values = vocabulary.entity_values(_mart(spark, sf_dir), VENTAS)
    return vocabulary.match_entity(values, "zona amerca")


def entity_match_terms(spark, sf_dir):
    """Every value typed without its third character, against all values."""
    values = vocabulary.entity_values(_mart(spark, sf_dir), VENTAS)
    typed = F.concat(F.substring("value", 1, 2), F.expr("substring(value, 4)"))
    return vocabulary.match_terms(values, values.select(typed.alias("term")))


def manager_scope(spark, sf_dir):
    star = _mart(spark, sf_dir)
    zones = scope.managed_zones(star, "user1@example.com")
    return assets.sales_by_territory(scope.ScopedStar(star, zones), *YEAR)


def tenant_union(spark, sf_dir):
    """Two tenants: the companies that keep books in each currency."""
    marts = {name: _mart(spark, sf_dir, currency=name) for name in ("HNL", "USD")}
    sales = scope.union_tenants({name: assets.confirmed(m) for name, m in marts.items()})
    return sales.groupBy("tenant", "sale_year").agg(
        F.sum("subtotal").cast(MONEY).alias("sales"), F.count("*").alias("n_lines")
    )


def tenants_of(spark, sf_dir) -> tuple[Tenants, dict[str, dict[str, DataFrame]]]:
    """A tenant for each currency, and its rows: the orders of the companies that keep books in
    it. The second one's source is of a version without a column and with another."""
    bronze = _bronze(spark, sf_dir)
    names = bronze["res_currency"].select(F.col("id").alias("currency_id"), F.col("name").alias("_name"))
    run, sources, configs = uuid.uuid4().hex, {}, {}
    for tenant in ("HNL", "USD"):
        own = names.where(F.col("_name") == tenant)
        companies = bronze["res_company"].join(own, "currency_id", "left_semi")
        companies = companies.select(F.col("id").alias("company_id"))
        orders = bronze["sale_order"].join(companies, "company_id", "left_semi")
        # orders grow with the lines; their compressed files do not tell what a broadcast takes
        own_orders = orders.select(F.col("id").alias("order_id")).hint("merge")
        lines = bronze["sale_order_line"].join(own_orders, "order_id", "left_semi")
        sources[tenant] = {**bronze, "sale_order": orders, "sale_order_line": lines}
        schemas = {f"{layer}_schema": f"{layer}_{tenant.lower()}_{run}" for layer in LAYERS}
        configs[tenant] = MartConfig(as_of=AS_OF, currency=tenant, **schemas)
    older = sources["USD"]["sale_order"].drop("client_order_ref").withColumn("note", F.lit("extra"))
    sources["USD"]["sale_order"] = older
    return Tenants(spark, configs, f"{shared_dir(spark)}/tenants-{run}"), sources


def tenant_schemas(spark, sf_dir):
    """The same two tenants with schemas of their own, one of them rebuilt after the other."""
    tenants, sources = tenants_of(spark, sf_dir)
    for tenant, source in sources.items():
        tenants.land(tenant, source)
        tenants.build(tenant)
    tenants.build("HNL")
    return tenants.ask(assets.confirmed).groupBy("tenant", "sale_year").agg(
        F.sum("subtotal").cast(MONEY).alias("sales"), F.count("*").alias("n_lines")
    )


VIEWS = [
    "silver_salespeople",
    "silver_territories",
    "silver_customers",
    "silver_products",
    "silver_orders",
    "silver_order_lines",
    "silver_inventory",
    "dim_customer",
    "dim_territory",
    "dim_salesperson",
    "dim_product",
    "fact_sales",
    "fact_inventory",
    "sales_metrics",
]

QUERIES: dict[str, Query] = {
    "bronze_rowcounts": bronze_rowcounts,
    "bronze_conform_drift": bronze_conform_drift,
    "contract_conformance": contract_conformance,
    "source_target_reconcile": source_target_reconcile,
    "reconcile_faulty": reconcile_faulty,
    "reconcile_rows": reconcile_rows,
    "landing_round_trip": landing_round_trip,
    "company_currency_audit": company_currency_audit,
    "bronze_cdc_apply": bronze_cdc_apply,
    "bronze_cdc_stream": bronze_cdc_stream,
    "bronze_cdc_buckets": bronze_cdc_buckets,
    "bronze_cdc_state": bronze_cdc_state,
    "bronze_versions": bronze_versions,
    "localized_text": localized_text,
    **{name: _view(name) for name in VIEWS},
    "silver_quality_report": silver_quality_report,
    "constraint_report": constraint_report,
    "quality_report_faulty": quality_report_faulty,
    "constraint_report_faulty": constraint_report_faulty,
    "quarantine_rows": quarantine_rows,
    "quarantine_counts": quarantine_counts,
    "quarantine_sales": quarantine_sales,
    "sales_by_territory": _asset(assets.sales_by_territory, *YEAR),
    "top_salespeople": _asset(assets.top_salespeople, *YEAR, 10),
    "top_products": _asset(assets.top_products, *YEAR, 15),
    "sales_year_over_year": _asset(assets.sales_year_over_year, 2001),
    "sales_by_state": _asset(assets.sales_by_state, *YEAR),
    "stockout_risk": _asset(assets.stockout_risk, 30),
    "lapsed_customers": _asset(assets.lapsed_customers, 60),
    "sql_sales_by_territory": _sql_function(
        "sales_by_territory(DATE'1997-01-01', DATE'1997-12-31')"
    ),
    "sql_top_salespeople": _sql_function("top_salespeople(DATE'1997-01-01', DATE'1997-12-31')"),
    "sql_top_products": _sql_function("top_products(DATE'1997-01-01', DATE'1997-12-31')"),
    "sql_top_products_2000": _sql_function(
        "top_products(DATE'1997-01-01', DATE'1997-12-31', 2000)"
    ),
    "sql_sales_year_over_year": _sql_function("sales_year_over_year(2001)"),
    "sql_sales_by_state": _sql_function("sales_by_state(DATE'1997-01-01', DATE'1997-12-31')"),
    "sql_stockout_risk": _sql_function("stockout_risk()"),
    "sql_lapsed_customers": _sql_function("lapsed_customers()"),
    "mv_by_zona": _ventas(
        ["Zona", "Gerente"], ["Pedidos", "Venta"], ["venta"], order_by=[("Venta", "desc")]
    ),
    "mv_by_vendedor": _ventas(
        ["Vendedor"], ["Venta", "Ticket promedio"], ["venta", "ticket_promedio"], where=PERIOD
    ),
    "mv_by_departamento": _ventas(
        ["Departamento"], ["Clientes", "Pedidos", "Venta"], ["venta"], where=PERIOD
    ),
    "mv_by_producto": _ventas(
        ["Producto", "Categoria"], ["Pedidos", "Clientes", "Venta"], ["venta"], where=PERIOD
    ),
    "mv_by_ciudad_categoria": _ventas(["Ciudad", "Categoria"], ["Pedidos", "Venta"], ["venta"]),
    "mv_by_mes": _ventas(
        ["Mes inicio", "Moneda"],
        ["Venta", "Venta con impuesto", "Pedidos"],
        ["venta", "venta_con_impuesto"],
    ),
    "mv_all_measures": _ventas(
        [],
        ["Venta", "Venta con impuesto", "Pedidos", "Clientes", "Ticket promedio"],
        ["venta", "venta_con_impuesto", "ticket_promedio"],
    ),
    "mv_currency_check": _ventas(["Zona"], ["Venta"], ["venta"], currencies="flag"),
    "mv_this_year": _ventas(["Zona"], ["Pedidos", "Venta"], ["venta"], this_year=True),
    "rollup_by_departamento": _rollup(
        ["Departamento"], ["Clientes", "Pedidos", "Venta"], ["venta"], YEAR
    ),
    "rollup_by_producto": _rollup(
        ["Producto", "Categoria"], ["Pedidos", "Clientes", "Venta"], ["venta"], YEAR
    ),
    "rollup_by_categoria": _rollup(
        ["Categoria"], ["Pedidos", "Clientes", "Ticket promedio"], ["ticket_promedio"]
    ),
    "rollup_by_zona": _rollup(["Zona", "Gerente"], ["Clientes", "Pedidos", "Venta"], ["venta"]),
    "mv_yoy_pivot": mv_yoy_pivot,
    "mv_top_products_in_zone": mv_top_products_in_zone,
    "mv_lowest_states": _ventas(
        ["Departamento"], ["Venta"], ["venta"], where=PERIOD, order_by=[("Venta", "asc")], limit=5
    ),
    "kpi_month": lambda spark, sf_dir: dashboard.kpi_month(_mart(spark, sf_dir), KPI_DAY),
    "monthly_two_years": monthly_two_years,
    "lowest_stock": _asset(dashboard.lowest_stock),
    "pending_delivery": _asset(dashboard.pending_delivery),
    "entity_values": entity_values,
    "entity_match": entity_match,
    "entity_match_terms": entity_match_terms,
    "manager_scope": manager_scope,
    "tenant_union": tenant_union,
    "tenant_schemas": tenant_schemas,
}


def _placed(name: str, order: Callable[[], list]) -> Query:
    """A question's rows with their place in its order; columns need a session to be made."""
    return lambda spark, sf_dir: numbered(QUERIES[name](spark, sf_dir), order())


PLACES: dict[str, Callable[[], list]] = {
    "sales_by_territory": lambda: [F.desc("sales")],
    "top_salespeople": lambda: [F.desc("sales"), "salesperson"],
    "top_products": lambda: [F.desc("sales"), "product"],
    "sales_year_over_year": lambda: ["sale_month"],
    "sales_by_state": lambda: [F.desc("sales"), "state"],
    "stockout_risk": lambda: [F.asc_nulls_last("days_of_cover"), "product", "warehouse"],
    "lapsed_customers": lambda: [F.desc("lifetime_sales"), "customer"],
    "lowest_stock": lambda: ["available"],
    "mv_by_mes": lambda: ["mes_inicio", "moneda"],
}
QUERIES |= {f"placed_{name}": _placed(name, order) for name, order in PLACES.items()}


# The corpus operators are a part of their own; without it everything else still works.
LLM_ORACLES: dict[str, str] = {}
LLM_PARTS = ("corpus_pipeline", "starmart.llm", "starmart.llm.registry")
# that they are there is asked, so that a library they miss is not taken for their absence
if all(find_spec(part) for part in LLM_PARTS):
    from corpus_pipeline import ORACLE_SQL, run
    from starmart.llm import registry

    QUERIES.update(registry.QUERIES, pipeline=run)
    LLM_ORACLES = {**registry.ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Sales by zone for 1997 on the smallest data, from source rows to the answer."""
    return QUERIES["sales_by_territory"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    known = {**ORACLES, **LLM_ORACLES}
    return {name: known[name] for name in QUERIES if name in known}
