"""Finding the right name or value for what a person typed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import fold, fold_text
from starmart.operators import gold
from starmart.plans.mart import Star
from starmart.plans.metrics import MetricView
from starmart.session import small_table

# Words for the physical columns of Gold.
COLUMN_SYNONYMS = {
    "territory": ("zona", "región", "equipo comercial"),
    "manager": ("gerente", "jefe de zona", "responsable"),
    "salesperson": ("vendedor", "ejecutivo", "asesor"),
    "customer": ("cliente",),
    "state": ("departamento", "región geográfica"),
    "city": ("ciudad",),
    "product": ("producto", "artículo"),
    "category": ("categoría", "familia", "línea"),
    "subtotal": ("venta", "monto vendido", "importe"),
    "quantity": ("cantidad", "unidades"),
    "order_status": ("estado del pedido",),
    "sale_date": ("fecha", "fecha del pedido"),
    "available": ("disponible", "existencia libre"),
    "on_hand": ("existencia", "inventario"),
    "order_id": ("pedido",),
}


def resolve(view: MetricView, term: str) -> list[str]:
    """Names of the dimensions and measures a term may mean.

    A name beats a synonym; case, accents and outer blanks do not matter. Several
    names come back when a synonym is shared.
    """
    wanted = fold_text(term)
    members = [*view.dimensions, *view.measures]
    exact = [m.name for m in members if fold_text(m.name) == wanted]
    return exact or [m.name for m in members if wanted in map(fold_text, m.synonyms)]


def resolve_column(term: str) -> list[str]:
    """Gold columns a term may mean."""
    wanted = fold_text(term)
    return [
        column
        for column, words in COLUMN_SYNONYMS.items()
        if wanted == column or wanted in map(fold_text, words)
    ]


def catalog(spark: SparkSession, view: MetricView) -> DataFrame:
    """The vocabulary as rows: every name and synonym of the metric view, every commented column."""
    rows = []
    for kind, members in (("dimension", view.dimensions), ("measure", view.measures)):
        for m in members:
            source = m.column if kind == "dimension" else None
            fmt = m.format.get("currency_code") if kind == "measure" else None
            for term in (m.name, *m.synonyms):
                folded = fold_text(term)
                rows.append((kind, view.name, m.name, term, folded, source, m.comment, fmt))
    for table, comments in gold.COLUMN_COMMENTS.items():
        for column, comment in comments.items():
            for term in (column, *COLUMN_SYNONYMS.get(column, ())):
                rows.append(("column", table, column, term, fold_text(term), column, comment, None))
    return small_table(
        spark,
        rows,
        "kind string, object string, name string, term string, folded string, "
        "source_column string, comment string, currency string",
    )


def catalog_comments(spark: SparkSession, database: str) -> DataFrame:
    """Column comments as the catalog holds them after a build."""
    rows = [
        (t.name, c.name, c.description)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
        for c in spark.catalog.listColumns(f"{database}.{t.name}")
        if c.description
    ]
    return small_table(spark, rows, "table_name string, column_name string, comment string")


def entity_values(star: Star, view: MetricView) -> DataFrame:
    """Every distinct literal a person may name: ``(dimension, value)``.

    Values of the metric view are those that occur in its sales. The fact is scanned once
    and contributes only its distinct keys, all dimensions together; names come from the
    dimension tables. Warehouses come from the inventory. Ids, dates and measures are
    never offered.
    """
    wanted = [d for d in view.dimensions if d.match_values and d.table is not None]
    tables = list(dict.fromkeys(d.table for d in wanted))

    def keyed(table, **fields: Column) -> list[Column]:
        return [
            F.lit(table.table).alias("dimension_table"),
            F.col(table.key).alias("key"),
            *[value.alias(name) for name, value in fields.items()],
        ]

    sold = star.fact_sales.filter(view.filter).select(*[t.key for t in tables])
    used = sold.select(F.inline(F.array(*[F.struct(*keyed(t)) for t in tables]))).distinct()
    named = reduce(
        DataFrame.unionByName,
        [
            getattr(star, t.table).select(
                *keyed(
                    t,
                    literals=F.array(
                        *[
                            F.struct(
                                F.lit(d.name).alias("dimension"), F.col(d.column).alias("value")
                            )
                            for d in wanted
                            if d.table == t
                        ]
                    ),
                )
            )
            for t in tables
        ],
    )
    warehouses = star.fact_inventory.select(
        F.lit("warehouse").alias("dimension"), F.col("warehouse").alias("value")
    )
    return (
        named.join(used, ["dimension_table", "key"], "left_semi")
        .select(F.inline("literals"))
        .unionByName(warehouses)
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def match_entity(
    values: DataFrame,
    term: str | Column,
    max_distance: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """All values by their edit distance to a term after folding, the nearest first.

    ``max_distance`` and ``limit`` leave values out only where they are asked for.
    """
    wanted = fold(F.lit(term) if isinstance(term, str) else term)
    distance = F.levenshtein(fold("value"), wanted)
    found = values.select("dimension", "value", distance.alias("distance"))
    if max_distance is not None:
        found = found.filter(F.col("distance") <= max_distance)
    found = found.orderBy("distance", "dimension", "value")
    return found if limit is None else found.limit(limit)


def _shortened(text: Column, times: int) -> Column:
    """The text, and what is left of it without up to ``times`` of its characters."""

    def without_one(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1)))
        return F.transform(
            places,
            lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1, F.length(t))),
        )

    found = F.array(text)
    for _ in range(times):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, without_one))))
    return found


def match_terms(values: DataFrame, terms: DataFrame, max_distance: int = 1) -> DataFrame:
    """All values within an edit distance of each term: ``term, dimension, value, distance``.

    Two texts within ``max_distance`` edits become equal when each loses that many of its
    characters at most, so values and terms meet in an equality join of their shortened forms,
    and the distance of those that meet is then computed. Nothing is lost, and texts that only
    share a common beginning do not meet. A text of n characters has in the order of
    ``n ** max_distance`` forms, each one BIGINT hash, so this is for names and small distances.
    Both sides are folded first, and equal folded texts are indexed once. NULL matches nothing.
    """
    named = values.where("value IS NOT NULL").select("dimension", "value", fold("value").alias("folded"))
    asked = terms.where("term IS NOT NULL").select("term", fold("term").alias("wanted")).distinct()

    def forms(texts: DataFrame, column: str) -> DataFrame:
        hashes = F.transform(_shortened(F.col(column), max_distance), lambda t: F.xxhash64(t))
        return texts.select(column).distinct().select(column, F.explode(hashes).alias("form"))

    near = (
        forms(named, "folded")
        .join(forms(asked, "wanted"), "form")
        .select("folded", "wanted")
        .distinct()
        .withColumn("distance", F.levenshtein("folded", "wanted"))
        .where(F.col("distance") <= max_distance)
    )
    return (
        near.join(named, "folded")
        .join(asked, "wanted")
        .select("term", "dimension", "value", "distance")
    )
