"""The mart: Bronze in, Silver and Gold as lazy DataFrames, and the full rebuild."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, Observation, SparkSession

from starmart import contract
from starmart.config import MartConfig
from starmart.functions.text import register_txt
from starmart.operators import constraints, gold, quality, silver
from starmart.operators.quarantine import Quarantine
from starmart.plans.versions import Publication, current_schema
from starmart.session import COMPRESSION, run_jobs

SILVER = (
    "silver_salespeople",
    "silver_territories",
    "silver_customers",
    "silver_products",
    "silver_orders",
    "silver_order_lines",
    "silver_inventory",
)
GOLD = (
    "dim_customer",
    "dim_territory",
    "dim_salesperson",
    "dim_product",
    "fact_sales",
    "fact_inventory",
)


class Star:
    """What questions are asked of: four dimensions, two facts and the wide view."""

    dim_customer: DataFrame
    dim_territory: DataFrame
    dim_salesperson: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame
    fact_inventory: DataFrame

    @cached_property
    def sales_metrics(self) -> DataFrame:
        return gold.sales_metrics(
            self.fact_sales,
            self.dim_customer,
            self.dim_territory,
            self.dim_salesperson,
            self.dim_product,
        )

    def register_views(self) -> None:
        """Temporary views under the Gold names, for SQL users."""
        for name in (*GOLD, "sales_metrics"):
            getattr(self, name).createOrReplaceTempView(name)


class Mart(Star):
    """Silver and Gold over a Bronze mapping, nothing computed until a result is asked for.

    Reading a question straight off Bronze lets Catalyst prune the casts and joins that
    the question does not need.
    """

    def __init__(self, bronze: Mapping[str, DataFrame], cfg: MartConfig | None = None) -> None:
        self.bronze = bronze
        self.cfg = cfg or MartConfig()

    # Silver, before expectations

    def unchecked(self, view: str) -> DataFrame:
        b, cfg = self.bronze, self.cfg
        if view == "silver_salespeople":
            return silver.salespeople(b["res_users"], b["res_partner"], cfg)
        if view == "silver_territories":
            return silver.territories(b["crm_team"], self.silver_salespeople, cfg)
        if view == "silver_customers":
            return silver.customers(b["res_partner"], b["res_country_state"], b["res_country"], cfg)
        if view == "silver_products":
            return silver.products(
                b["product_product"],
                b["product_template"],
                b["product_category"],
                b["uom_uom"],
                cfg,
            )
        if view == "silver_orders":
            return silver.orders(b["sale_order"], b["res_currency"], b["res_company"], cfg)
        if view == "silver_order_lines":
            return silver.order_lines(b["sale_order_line"], cfg)
        if view == "silver_inventory":
            return silver.inventory(
                b["stock_quant"],
                b["stock_location"],
                b["stock_warehouse"],
                b["res_company"],
                b["res_currency"],
                cfg,
            )
        raise KeyError(view)

    def checked(self, view: str, observation: Observation | None = None) -> DataFrame:
        return quality.enforce(self.unchecked(view), view, observation)

    @cached_property
    def silver_salespeople(self) -> DataFrame:
        return self.checked("silver_salespeople")

    @cached_property
    def silver_territories(self) -> DataFrame:
        return self.checked("silver_territories")

    @cached_property
    def silver_customers(self) -> DataFrame:
        return self.checked("silver_customers")

    @cached_property
    def silver_products(self) -> DataFrame:
        return self.checked("silver_products")

    @cached_property
    def silver_orders(self) -> DataFrame:
        return self.checked("silver_orders")

    @cached_property
    def silver_order_lines(self) -> DataFrame:
        return self.checked("silver_order_lines")

    @cached_property
    def silver_inventory(self) -> DataFrame:
        return self.checked("silver_inventory")

    # Gold

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dimension(self.silver_customers, "dim_customer", gold.DIM_CUSTOMER)

    @cached_property
    def dim_territory(self) -> DataFrame:
        return gold.dimension(self.silver_territories, "dim_territory", gold.DIM_TERRITORY)

    @cached_property
    def dim_salesperson(self) -> DataFrame:
        return gold.dimension(self.silver_salespeople, "dim_salesperson", gold.DIM_SALESPERSON)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dimension(self.silver_products, "dim_product", gold.DIM_PRODUCT)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.silver_order_lines, self.silver_orders)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return gold.fact_inventory(self.silver_inventory)

    @cached_property
    def sales_metrics(self) -> DataFrame:
        return gold.sales_metrics_by_order(
            self.silver_order_lines,
            self.silver_orders,
            self.dim_customer,
            self.dim_territory,
            self.dim_salesperson,
            self.dim_product,
        )

    def quality_report(self) -> DataFrame:
        return quality.report(_Named(self.unchecked, SILVER))

    def constraint_report(self) -> DataFrame:
        return constraints.report(_Named(lambda name: getattr(self, name), (*GOLD, *SILVER)))


class UncheckedMart(Mart):
    """A mart that drops no row: what the key checks would find without the expectations."""

    def checked(self, view: str, observation: Observation | None = None) -> DataFrame:
        return self.unchecked(view)


class _Named(Mapping):
    def __init__(self, get, names) -> None:
        self._get, self._names = get, names

    def __getitem__(self, name: str) -> DataFrame:
        return self._get(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class CatalogTables(Mapping):
    """Tables of one layer read from the catalog.

    All of one version: the one that was current when this was made, or the given one.
    """

    def __init__(
        self, spark: SparkSession, cfg: MartConfig, layer: str, names, version: int | None = None
    ) -> None:
        self._spark, self._names = spark, tuple(names)
        schema = cfg.schema(layer)
        self._schema = f"{schema}_v{version}" if version else current_schema(spark, schema)

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.table(f"{self._schema}.{name}")

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class GoldTables(Star):
    """The star as written by :func:`build_all`; the way to serve questions at scale.

    It stays with the version that was current when it was made, so its tables agree with
    each other while a rebuild goes on.
    """

    def __init__(self, spark: SparkSession, cfg: MartConfig, names=GOLD) -> None:
        self.cfg = cfg
        tables = CatalogTables(spark, cfg, "gold", names)
        for name in names:
            setattr(self, name, tables[name])


def write_table(
    df: DataFrame,
    name: str,
    comment: str = "",
    partitions: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Replace a table whole.

    A partitioned table is rebalanced on its partition columns first: AQE merges small
    partitions and splits a hot month, so files come out of even size and their number
    does not depend on the number of tasks. Files are sorted by ``sort_by`` after the
    partition columns, the sort such a write needs anyway, so that a filter on those
    columns skips row groups.

    Its rows are counted, from the files' footers, so that joins take its size from them and
    not from the compressed files, of which a few MB can be hundreds in a broadcast.
    """
    if partitions:
        df = df.hint("rebalance", *partitions)
        df = df.sortWithinPartitions(*partitions, *(sort_by or []))
    writer = df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def write_gold(df: DataFrame, name: str) -> None:
    """Write one Gold table; the sales fact by month and, within a file, by day."""
    table = name.rpartition(".")[2]
    by_month = table == "fact_sales"
    write_table(
        df,
        name,
        gold.TABLE_COMMENTS[table],
        gold.FACT_PARTITIONS if by_month else None,
        ["sale_date"] if by_month else None,
    )


def build_all(
    spark: SparkSession, cfg: MartConfig, quarantine: str | None = None, folder: str | None = None
) -> dict[str, dict[str, int]]:
    """Rebuild Silver and Gold from the Bronze tables of the catalog.

    With a folder for a ``quarantine``, rows that do not fit go there instead of failing the
    build or vanishing from it. ``folder`` is where the schemas' files go; unset, the catalog
    chooses.

    Order: ``txt``, Silver, constraints, Gold. Silver is written before Gold because each view
    feeds several tables. Both layers are written as new versions and published at the end,
    so a rebuild that fails, or whose keys are broken, leaves the ones being read as they
    are. Returns the expectation counts per view, taken while the views are written.
    """
    contract.require_tables(
        contract.introspect_catalog(spark, current_schema(spark, cfg.schema("bronze")))
    )
    register_txt(spark, cfg.locales)
    bronze = CatalogTables(spark, cfg, "bronze", contract.TABLE_NAMES)
    mart = Mart(Quarantine(spark, bronze, quarantine) if quarantine else bronze, cfg)
    silver_layer = Publication(spark, cfg.schema("silver"), folder)
    gold_layer = Publication(spark, cfg.schema("gold"), folder)
    version = silver_layer.stage()
    written = CatalogTables(spark, cfg, "silver", SILVER, version)

    def write_silver(view: str) -> dict[str, int]:
        observation = Observation(view) if quality.expectations(view) else None
        write_table(mart.checked(view, observation), f"{silver_layer.staged(version)}.{view}")
        # Later views and Gold read what was written instead of recomputing it.
        setattr(mart, view, written[view])
        return observation.get if observation else {}

    try:
        # Territories read the salespeople view; the other views stand alone.
        first, *others = SILVER
        counts = {first: write_silver(first)}
        counts.update(run_jobs({view: partial(write_silver, view) for view in others}))
        # keys are checked before Gold is published, so broken ones are never served
        constraints.enforce(mart.constraint_report())
        gold_layer.publish({name: partial(getattr, mart, name) for name in GOLD}, write_gold)
    except BaseException:
        silver_layer.discard(version)
        raise
    silver_layer.switch(version)
    return counts
