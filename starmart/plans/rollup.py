"""Monthly totals and mergeable distinct counts (A11, A13): questions answered without the fact.

For each dimension table there is one set of tables by month and key: totals, which add up,
and containers of ids, from which distinct orders and customers over any months and names are
counted exactly. A container holds the ids of one month, key and range of 32,768 ids: as a list of
positions where there are few, as a bitmap where the list would be longer than one. So it never
takes more room than the rows it was made from, however thinly a key's ids are spread.

Orders need containers only next to dimensions that vary within an order. Elsewhere an order
has one key and one month, and its plain count adds up. Customers are counted by name: the
smallest id of a name stands for all ids of that name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.gold import Dimension as Table
from starmart.plans.mart import Star
from starmart.plans.metrics import DistinctNames, MetricError, MetricView, Orders, Total
from starmart.session import run_jobs, small_table

#: Positions up to which a list takes no more room than a bitmap: 4,096 bytes, two a position.
FEW = 2048
MONTH = ["sale_year", "sale_month"]


def containers(ids: DataFrame, few: int = FEW) -> DataFrame:
    """``sale_year, sale_month, key`` and ``id`` packed; rows with a NULL id hold none.

    Repeated rows are dropped before they are gathered, so a group is at most one range of ids.
    Rows are dealt by key and range beforehand, so that no half-filled bitmap is shuffled.
    """
    at = F.expr("CAST(bitmap_bit_position(id) AS SMALLINT)")
    single = ids.where("id IS NOT NULL").select(
        *MONTH, "key", F.expr("bitmap_bucket_number(id)").alias("bucket"), at.alias("at")
    )
    dealt = single.repartition(*MONTH, "key", "bucket").distinct()
    packed = dealt.groupBy(*MONTH, "key", "bucket").agg(
        F.sort_array(F.collect_list("at")).alias("positions"),
        F.expr("bitmap_construct_agg(at)").alias("bits"),
    )
    sparse = F.size("positions") <= few
    return packed.select(
        *MONTH,
        "key",
        "bucket",
        F.when(sparse, F.col("positions")).alias("positions"),
        F.when(~sparse, F.col("bits")).alias("bits"),
    )


def distinct_ids(packed: DataFrame) -> DataFrame:
    """``group`` and ``n``, the distinct ids in all containers of each group.

    Lists are opened and their repeats dropped, first in each task. Where a group has a bitmap in
    a range of ids, the positions of its lists there join it. A group that holds most ids
    is spread over its ranges until only counts are left.
    """
    at = ["group", "bucket"]
    listed = packed.where("positions IS NOT NULL").select(
        *at, F.explode("positions").alias("at")
    ).distinct()
    mapped = packed.where("bits IS NOT NULL").groupBy(*at).agg(
        F.expr("bitmap_or_agg(bits)").alias("bits")
    )
    beside = listed.join(mapped.select(*at), at, "left_semi").groupBy(*at).agg(
        F.expr("bitmap_construct_agg(at)").alias("bits")
    )
    united = mapped.unionByName(beside).groupBy(*at).agg(
        F.expr("bitmap_count(bitmap_or_agg(bits))").alias("n")
    )
    alone = listed.join(mapped.select(*at), at, "left_anti").groupBy(*at).agg(
        F.count("*").alias("n")
    )
    return united.unionByName(alone).groupBy("group").agg(F.sum("n").alias("n"))


class Rollup:
    """The monthly tables of a view over a star, in a folder."""

    def __init__(self, spark: SparkSession, folder: str, star: Star, view: MetricView) -> None:
        self.spark, self.folder, self.star, self.view = spark, folder, star, view
        self.tables = list(dict.fromkeys(d.table for d in view.dimensions if d.table is not None))
        self._parts = list(dict.fromkeys(p for m in view.measures for p in m.parts))

    # build

    def build(
        self, months: Iterable[dt.date] | None = None, tables: Iterable[Table] | None = None
    ) -> None:
        """Write the tables; with ``months``, given by any day of them, those months only.

        The other months' files stay as they are. ``tables`` leaves out other dimension tables. A month that has no sales any more becomes
        empty.
        """
        fact = self.star.fact_sales.where(self.view.filter)
        asked = None
        if months is not None:
            asked = sorted({(day.year, day.month) for day in months})
            tests = [(F.col("sale_year") == y) & (F.col("sale_month") == m) for y, m in asked]
            wanted = F.lit(False)
            for test in tests:
                wanted = wanted | test
            fact = fact.where(wanted)
        jobs = {}
        for table in self.tables if tables is None else tables:
            for kind, rows in self._contents(fact, table).items():
                name = f"{table.table}/{kind}"
                jobs[name] = partial(self._write, rows, name, asked)
        run_jobs(jobs)

    def _contents(self, fact: DataFrame, table: Table) -> dict[str, DataFrame]:
        keyed = fact.withColumn("key", F.col(table.key).cast("bigint"))
        sums = [F.count("*").alias("lines")] + [
            F.sum(p.column).cast(p.data_type).alias(p.column)
            for p in self._parts
            if isinstance(p, Total)
        ]
        by = [*MONTH, "key", "currency"]
        if not self._varies(table):
            sums.append(F.count_distinct("order_id").alias("orders"))
        contents = {"totals": keyed.groupBy(*by).agg(*sums)}
        if self._varies(table):
            orders = keyed.select(*MONTH, "key", F.col("order_id").cast("bigint").alias("id"))
            contents["orders"] = containers(orders)
        for part in self._parts:
            if isinstance(part, DistinctNames):
                ids = keyed.select(*MONTH, "key", F.col(part.table.key).alias("_id")).distinct()
                ids = ids.join(self._one_per_name(part), "_id")
                contents[part.column] = containers(ids.select(*MONTH, "key", "id"))
        return contents

    def _varies(self, table: Table) -> bool:
        return any(d.within_order for d in self.view.dimensions if d.table == table)

    def _one_per_name(self, part: DistinctNames) -> DataFrame:
        """``_id`` of each row of a dimension table and ``id``, the smallest of its name."""
        rows = getattr(self.star, part.table.table).select(
            F.col(part.table.key).alias("_id"), F.col(part.column).alias("_name")
        )
        smallest = rows.groupBy("_name").agg(F.min("_id").cast("bigint").alias("id"))
        return rows.join(smallest, "_name").select("_id", "id")

    def _write(self, rows: DataFrame, name: str, months: list[tuple[int, int]] | None) -> None:
        if months is not None:
            # a row without contents for each month, so that its old files go
            blank = small_table(self.spark, months, "sale_year int, sale_month int")
            rows = rows.unionByName(blank, allowMissingColumns=True)
        writer = rows.hint("rebalance", *MONTH).write.mode("overwrite").partitionBy(*MONTH)
        if months is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(f"{self.folder}/{name}")

    # questions

    def query(
        self,
        dimensions: Sequence[str],
        measures: Sequence[str],
        first: dt.date | None = None,
        last: dt.date | None = None,
        currencies: str | None = "flag",
    ) -> DataFrame:
        """Measures by names of one dimension table, from the day ``first`` to ``last``.

        The period must be whole months; an open end is None. Names are those of the dimension
        table now. ``currencies="flag"`` adds the number of currencies in each group.
        """
        groups = [self.view.dimension(n) for n in dimensions]
        chosen = [self.view.measure(n) for n in measures]
        named = list(dict.fromkeys(d.table for d in groups))
        if len(named) > 1 or None in named:
            raise MetricError("name dimensions of one table: a rollup has one key")
        if not chosen:
            raise MetricError("name at least one measure")
        if currencies not in (None, "flag"):
            raise MetricError(f"currencies must be None or 'flag', not {currencies!r}")
        if first is not None and first.day != 1:
            raise MetricError("a period starts with a month")
        if last is not None and (last + dt.timedelta(days=1)).day != 1:
            raise MetricError("a period ends with a month")
        parts = list(dict.fromkeys(p for m in chosen for p in m.parts))
        # without names, the least table that has no orders to unite
        plain = [t for t in self.tables if not self._varies(t)]
        table = named[0] if named else (plain or self.tables)[0]
        within = _months(first, last)
        names = [F.col(d.column).alias(f"g{i}") for i, d in enumerate(groups)]

        totals = self._grouped(table, "totals", within, names).groupBy("group").agg(
            *[
                F.sum("orders" if isinstance(p, Orders) else p.column).alias(f"p{i}")
                for i, p in enumerate(parts)
                if isinstance(p, Total) or (isinstance(p, Orders) and not self._varies(table))
            ],
            F.collect_set("currency").alias("known"),
        )
        found = totals
        for i, part in enumerate(parts):
            kind = "orders" if isinstance(part, Orders) else part.column
            if isinstance(part, DistinctNames) or (isinstance(part, Orders) and self._varies(table)):
                counted = distinct_ids(self._grouped(table, kind, within, names))
                counted = counted.withColumnRenamed("n", f"p{i}")
                found = found.unionByName(counted, allowMissingColumns=True)
        merged = [
            F.sum(f"p{i}").cast(p.data_type).alias(f"p{i}")
            if isinstance(p, Total)
            else F.coalesce(F.sum(f"p{i}"), F.lit(0)).cast("bigint").alias(f"p{i}")
            for i, p in enumerate(parts)
        ]
        # a group's currencies come in one row, that of the totals
        merged.append(F.coalesce(F.sum(F.size("known")), F.lit(0)).alias("currencies"))
        rows = found.groupBy("group").agg(*merged) if names else found.agg(*merged)
        values = [F.col(f"group.g{i}").alias(d.name) for i, d in enumerate(groups)]
        values += [
            m.combine(*[F.col(f"p{parts.index(p)}") for p in m.parts]).alias(m.name) for m in chosen
        ]
        return rows.select(*values, *(["currencies"] if currencies == "flag" else []))

    def _grouped(
        self, table: Table, kind: str, within: Column, names: list[Column]
    ) -> DataFrame:
        """Stored rows of the months, with the names they are grouped by as ``group``."""
        contents = self._contents(self.star.fact_sales, table)[kind]
        rows = self.spark.read.schema(contents.schema).parquet(f"{self.folder}/{table.table}/{kind}")
        rows = rows.where(within).where("lines > 0" if kind == "totals" else "bucket IS NOT NULL")
        if not names:
            return rows.withColumn("group", F.struct(F.lit(0).alias("all")))
        labels = getattr(self.star, table.table).select(
            F.col(table.key).cast("bigint").alias("key"), *names
        )
        # a key that the dimension table lacks has no names, like one whose names are NULL
        named = [c for c in labels.columns if c != "key"]
        return rows.join(labels, "key", "left").withColumn("group", F.struct(*named)).drop(*named)


def _months(first: dt.date | None, last: dt.date | None) -> Column:
    """The condition on the partitions that a period of whole months is."""
    month = F.col("sale_year") * 12 + F.col("sale_month")
    within = F.lit(True)
    if first is not None:
        within = within & (month >= first.year * 12 + first.month)
    if last is not None:
        within = within & (month <= last.year * 12 + last.month)
    return within
