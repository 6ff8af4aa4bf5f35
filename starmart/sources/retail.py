"""A retail star in Parquet read as if it were the ERP source.

The given ``region nation customer supplier part orders lineitem`` tables carry no ERP
rows, so each contract table is derived from them by a fixed rule. The rules also plant
what a real source has: translatable names, NULL references, two companies, two
currencies, section lines, unknown states and repeated product names. Values keep native
types, as a database would hand them over; the contract turns them into text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import contract
from starmart.session import small_table

# Column types of the given files, stated so that opening one runs no job.
FILES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

TEMPLATE_OFFSET = 500_000
#: Ids that no customer and no order can have, at any size.
SUPPLIER_PARTNER = "-1 - s_suppkey"
#: Some lines share order, number, part and supplier, so the id is 60 bits of a digest of all
#: columns: two lines may share one by chance, at odds of n * n / 2**61 for n lines.
LINE_ID = (
    "CAST(conv(substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(l_quantity AS DECIMAL(18,3)), CAST(l_extendedprice AS DECIMAL(18,2)), "
    "CAST(l_discount AS DECIMAL(4,2)), CAST(l_tax AS DECIMAL(4,2)), l_returnflag, "
    "l_linestatus, CAST(l_shipdate AS DATE))), 1, 15), 16, 10) AS BIGINT)"
)


class RetailSource(Mapping):
    """``{contract table: DataFrame}`` over one folder of Parquet files, built on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder
        self._rules: dict[str, Callable[[], DataFrame]] = {
            name: getattr(self, f"_{name}") for name in contract.TABLES
        }

    def __getitem__(self, table: str) -> DataFrame:
        return self._rules[table]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._rules)

    def __len__(self) -> int:
        return len(self._rules)

    def raw(self, name: str) -> DataFrame:
        return self._spark.read.schema(FILES[name]).parquet(f"{self._folder}/{name}.parquet")

    # ---------------------------------------------------------------- sales

    def _sale_order(self) -> DataFrame:
        untaxed = "CAST(o_totalprice AS DECIMAL(18,2))"
        return (
            self.raw("orders")
            .selectExpr(
                "o_orderkey AS id",
                "concat('S', o_orderkey) AS name",
                "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS client_order_ref",
                "o_custkey AS partner_id",
                "(o_orderkey DIV 10) % 10 AS user_id",
                "CASE WHEN o_orderkey % 50 <> 7 THEN o_custkey % 5 END AS team_id",
                "o_orderdate AS date_order",
                "CASE WHEN o_orderkey % 997 = 0 THEN 'locked' WHEN o_orderstatus = 'F' THEN 'sale' "
                "WHEN o_orderstatus = 'O' THEN 'draft' WHEN o_orderkey % 4 = 0 THEN 'cancel' "
                "WHEN o_orderkey % 4 = 1 THEN 'sent' WHEN o_orderkey % 4 = 2 THEN 'done' "
                "ELSE 'sale' END AS state",
                "CASE WHEN o_orderkey % 100 = 5 THEN 2 ELSE 1 END AS currency_id",
                f"{untaxed} AS amount_untaxed",
                f"CAST({untaxed} * 0.15 AS DECIMAL(18,2)) AS amount_tax",
                "CASE WHEN o_orderkey % 1000 = 500 THEN NULL WHEN o_orderkey % 10 = 9 THEN 2 "
                "ELSE 1 END AS company_id",
            )
            .withColumn(
                "amount_total", F.expr("CAST(amount_untaxed + amount_tax AS DECIMAL(18,2))")
            )
        )

    def _sale_order_line(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .selectExpr(
                f"{LINE_ID} AS id",
                "l_orderkey AS order_id",
                "l_partkey AS product_id",
                "CAST(l_quantity AS DECIMAL(18,3)) AS product_uom_qty",
                "CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS DECIMAL(18,3)) "
                "AS qty_delivered",
                "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS price_unit",
                "CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(9,4)) AS discount",
                "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) "
                "* (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS price_subtotal",
                "CASE WHEN l_linenumber = 7 THEN 'line_section' WHEN l_linenumber = 6 THEN '' END "
                "AS display_type",
                "l_tax",
            )
            .withColumn(
                "price_total",
                F.expr("CAST(price_subtotal * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2))"),
            )
        )

    # --------------------------------------------------- parties, geography

    def _res_partner(self) -> DataFrame:
        customers = self.raw("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "concat('RTN', c_custkey) AS vat",
            "c_mktsegment AS city",
            "c_nationkey AS state_id",
            "c_custkey % 2 = 0 AS is_company",
            "1 AS customer_rank",
            "c_custkey % 10 <> 9 AS active",
        )
        suppliers = self.raw("supplier").selectExpr(
            f"{SUPPLIER_PARTNER} AS id",
            "s_name AS name",
            "CAST(NULL AS STRING) AS vat",
            "CAST(NULL AS STRING) AS city",
            "s_nationkey AS state_id",
            "false AS is_company",
            "0 AS customer_rank",
            "true AS active",
        )
        regions = self.raw("nation").selectExpr(
            "n_nationkey AS state_id",
            "CASE WHEN n_nationkey <> 24 THEN n_regionkey END AS country_id",
        )
        return customers.unionByName(suppliers).join(regions, "state_id", "left")

    def _res_users(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS id",
            f"CASE WHEN s_suppkey % 10 <> 3 THEN {SUPPLIER_PARTNER} END AS partner_id",
            "concat('user', s_suppkey, '@example.com') AS login",
            "s_suppkey % 7 <> 6 AS active",
        )

    def _res_company(self) -> DataFrame:
        rows = [(1, "Distribuidora", 1), (2, "Importadora", 2)]
        return small_table(self._spark, rows, "id bigint, name string, currency_id bigint")

    def _res_currency(self) -> DataFrame:
        return small_table(self._spark, [(1, "HNL"), (2, "USD")], "id bigint, name string")

    def _res_country(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "r_regionkey AS id",
            "to_json(named_struct('en_US', r_name, 'es_ES', concat('País ', r_name))) AS name",
        )

    def _res_country_state(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "n_nationkey AS id",
            "n_name AS name",
            "concat('N', n_nationkey) AS code",
            "n_regionkey AS country_id",
        )

    def _crm_team(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "r_regionkey AS id",
            "CASE r_regionkey "
            "WHEN 0 THEN to_json(named_struct('en_US', r_name, 'es_ES', concat('Zona ', r_name))) "
            "WHEN 1 THEN to_json(named_struct('es_419', concat('Zona ', r_name))) "
            "WHEN 2 THEN to_json(named_struct('en_US', r_name)) "
            "WHEN 3 THEN r_name "
            "ELSE to_json(named_struct('fr_FR', r_name)) END AS name",
            "r_regionkey AS user_id",
        )

    # -------------------------------------------------------------- products

    def _product_product(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS id",
            f"p_partkey + {TEMPLATE_OFFSET} AS product_tmpl_id",
            "concat('P', p_partkey) AS default_code",
            "CASE WHEN p_partkey % 4 <> 0 THEN concat('750', p_partkey) END AS barcode",
            "true AS active",
        )

    def _product_template(self) -> DataFrame:
        return self.raw("part").selectExpr(
            f"p_partkey + {TEMPLATE_OFFSET} AS id",
            "CASE WHEN p_partkey % 2 = 0 "
            "THEN to_json(named_struct('en_US', p_name, 'es_ES', p_name)) ELSE p_name END AS name",
            "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS categ_id",
            "CAST(p_retailprice AS DECIMAL(18,2)) AS list_price",
            "1 AS uom_id",
            "p_partkey % 11 <> 10 AS sale_ok",
            "p_partkey % 9 <> 8 AS active",
        )

    def _product_category(self) -> DataFrame:
        brands = self.raw("part").select("p_brand").distinct()
        return brands.selectExpr(
            "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS id",
            "concat('Todo / ', p_brand) AS complete_name",
        )

    def _product_pricelist(self) -> DataFrame:
        rows = [(1, "Lista base", 1)]
        return small_table(self._spark, rows, "id bigint, name string, currency_id bigint")

    def _uom_uom(self) -> DataFrame:
        rows = [(1, '{"en_US": "Units", "es_ES": "Unidades"}')]
        return small_table(self._spark, rows, "id bigint, name string")

    # ------------------------------------------------------------- inventory

    def _stock_quant(self) -> DataFrame:
        places = self.raw("part").selectExpr(
            "p_partkey", "p_size", "explode(sequence(1, 5)) AS location_id"
        )
        return places.selectExpr(
            "p_partkey * 8 + location_id AS id",
            "p_partkey AS product_id",
            "location_id",
            "CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 1 END AS company_id",
            "CAST(p_size * location_id AS DECIMAL(18,3)) AS quantity",
            "CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size DIV 2 AS DECIMAL(18,3)) END "
            "AS reserved_quantity",
        )

    def _stock_location(self) -> DataFrame:
        rows = [
            (1, "WH/Stock", "internal", 1),
            (2, "WH/Stock", "internal", 1),
            (3, "Tránsito", "internal", None),
            (4, "Proveedores", "supplier", None),
            (5, "Clientes", "customer", None),
        ]
        ddl = "id bigint, complete_name string, usage string, warehouse_id bigint"
        return small_table(self._spark, rows, ddl)

    def _stock_warehouse(self) -> DataFrame:
        rows = [(1, '{"es_ES": "Almacén central", "en_US": "Main warehouse"}', "WH")]
        return small_table(self._spark, rows, "id bigint, name string, code string")


def order_changes(orders: DataFrame, snapshot_lsn: int) -> DataFrame:
    """A change feed for ``sale_order`` rows, with k the order id.

    Log position ``10 k + n`` after the snapshot: n=2 confirms orders with k % 3 = 0, n=3
    deletes k % 7 = 0, n=4 inserts k % 21 = 0 again as draft, n=5 inserts a new order for
    k % 11 = 0. Orders with k % 4 = 0 also have a draft update from before the snapshot.
    Every record of k % 5 = 0 comes twice.
    """
    k = F.col("id").cast("bigint")

    def event(when: Column, op: str, n: int, base: int, state: Column, key: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(op).alias("op"),
                (k * 10 + n + base).alias("lsn"),
                state.alias("new_state"),
                key.cast("string").alias("key"),
            ),
        )

    def text(value: str | None) -> Column:
        return F.lit(value).cast("string")

    events = F.array_compact(
        F.array(
            event(k % 4 == 0, "U", 1, 0, text("draft"), k),
            event(k % 3 == 0, "U", 2, snapshot_lsn, text("sale"), k),
            event(k % 7 == 0, "D", 3, snapshot_lsn, text(None), k),
            event(k % 21 == 0, "I", 4, snapshot_lsn, text("draft"), k),
            event(k % 11 == 0, "I", 5, snapshot_lsn, F.col("state"), -1 - k),
        )
    )
    events = F.when(k % 5 == 0, F.concat(events, events)).otherwise(events)
    row = F.to_json(
        F.struct(
            *[
                {"id": F.col("key"), "state": F.col("new_state")}.get(c, F.col(c)).alias(c)
                for c in contract.TABLES["sale_order"]
            ]
        ),
        {"ignoreNullFields": "false"},
    )
    return orders.select("*", F.inline(events)).select(
        F.lit("sale_order").alias("table"),
        "op",
        "lsn",
        F.timestamp_seconds(F.col("lsn") % 10**9).alias("commit_ts"),
        F.col("key").alias("id"),
        F.when(F.col("op") != "D", row).alias("row"),
    )


class ConformedTables(Mapping):
    """Bronze view of any source: every table projected onto the contract when asked for."""

    def __init__(self, source: Mapping[str, DataFrame]) -> None:
        self._source = source

    def __getitem__(self, table: str) -> DataFrame:
        return contract.conform(self._source[table], table)

    def __iter__(self) -> Iterator[str]:
        return iter(contract.TABLE_NAMES)

    def __len__(self) -> int:
        return len(contract.TABLE_NAMES)


#: Tables with planted faults: the column, whether rows go missing, whether rows come twice.
FAULTY = {
    "res_users": ("id", True, True),
    "crm_team": ("id", True, True),
    "res_partner": ("id", True, True),
    "product_product": ("id", True, True),
    "sale_order": ("id", False, True),
    "sale_order_line": ("order_id", False, False),
}


class FaultyTables(Mapping):
    """Bronze with faults planted by rule, for checks that must find something.

    With k the value of the column: rows of k % 10 = 3 come again with NULL, rows of
    k % 10 = 4 come twice and rows of k % 10 = 2 are missing, as ``FAULTY`` says.
    """

    def __init__(self, bronze: Mapping[str, DataFrame]) -> None:
        self._bronze = bronze

    def __getitem__(self, table: str) -> DataFrame:
        df = self._bronze[table]
        if table not in FAULTY:
            return df
        column, missing, twice = FAULTY[table]
        value, k = F.col(column), F.col(column).cast("bigint") % 10
        values = F.when(k == 3, F.array(value, F.lit(None).cast("string")))
        if twice:
            values = values.when(k == 4, F.array(value, value))
        if missing:
            values = values.when(k == 2, F.array().cast("array<string>"))
        return df.withColumn(column, F.explode(values.otherwise(F.array(value))))

    def __iter__(self) -> Iterator[str]:
        return iter(self._bronze)

    def __len__(self) -> int:
        return len(self._bronze)


#: Tables with altered values: the last digit of the id, the column and its new value.
ALTERED = {
    "sale_order": (6, "state", "changed"),
    "res_partner": (7, "vat", None),
}


class AlteredTables(Mapping):
    """Bronze in which some rows keep their id but not a value, as ``ALTERED`` says."""

    def __init__(self, bronze: Mapping[str, DataFrame]) -> None:
        self._bronze = bronze

    def __getitem__(self, table: str) -> DataFrame:
        df = self._bronze[table]
        if table not in ALTERED:
            return df
        digit, column, value = ALTERED[table]
        hit = F.col("id").cast("bigint") % 10 == digit
        changed = F.when(hit, F.lit(value).cast("string")).otherwise(F.col(column))
        return df.withColumn(column, changed)

    def __iter__(self) -> Iterator[str]:
        return iter(self._bronze)

    def __len__(self) -> int:
        return len(self._bronze)


#: Values that no cast takes: the column that decides, its last digit, the column that is
#: spoiled and what then stands there.
SPOILED = {
    "sale_order": [("id", 1, "amount_total", "n/a"), ("id", 8, "date_order", "2024-13-40")],
    "sale_order_line": [("order_id", 5, "product_uom_qty", "many")],
    "res_partner": [("id", 6, "customer_rank", "1st")],
}


class SpoiledTables(Mapping):
    """Bronze in which some values do not parse, as ``SPOILED`` says."""

    def __init__(self, bronze: Mapping[str, DataFrame]) -> None:
        self._bronze = bronze

    def __getitem__(self, table: str) -> DataFrame:
        df = self._bronze[table]
        return df.withColumns(
            {
                column: F.when(F.col(key).cast("bigint") % 10 == digit, text).otherwise(F.col(column))
                for key, digit, column, text in SPOILED.get(table, ())
            }
        )

    def __iter__(self) -> Iterator[str]:
        return iter(self._bronze)

    def __len__(self) -> int:
        return len(self._bronze)
