"""Checks on a load: source against target, companies and their currencies."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.sources.landing import row_counts

# The tables whose counts are compared after a load.
RECONCILED = ["sale_order", "sale_order_line", "res_partner", "stock_quant"]


def reconcile(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], names: list[str] = RECONCILED
) -> DataFrame:
    """Row counts of both sides and their difference, one row per table."""
    have = row_counts(target, names).withColumnRenamed("rows", "target_rows")
    want = row_counts(source, names).withColumnRenamed("rows", "source_rows")
    return want.join(have, "table_name", "full_outer").select(
        "table_name",
        "source_rows",
        "target_rows",
        (F.col("source_rows") - F.col("target_rows")).alias("difference"),
    )


#: Bits of the key's hash that a level of ranges adds, and levels.
LEVEL_BITS, LEVELS = 10, 1
#: Bits of a row's hash that say whether a row like it differs: as a bitmap, 16 MB at most.
MARK_BITS = 27


def _summed(rows: DataFrame, bits: int) -> DataFrame:
    """Order-free sums of two row hashes, per range of the key's hash."""
    total = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    return rows.groupBy(_range(bits)).agg(
        F.struct(F.count("*").alias("n"), total("h1").alias("a"), total("h2").alias("b")).alias("sums")
    )


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("kh", 64 - bits).alias("range")


def _marks(hashes: DataFrame) -> DataFrame:
    """``part, bits``: a bitmap of the leading ``MARK_BITS`` bits of the hashes ``h1``, in parts.

    The hashes are dealt by part first, so that each part is gathered once.
    """
    at = hashes.select(F.shiftrightunsigned("h1", 64 - MARK_BITS).alias("at"))
    parts = at.select(F.bitmap_bucket_number("at").alias("part"), "at").repartition("part")
    return parts.groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows whose ``h1`` is in the bitmap: all that were marked, and few others."""
    at = F.shiftrightunsigned("h1", 64 - MARK_BITS)
    place = F.bitmap_bit_position(at)
    byte = F.col("bits").substr((F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), place.bitwiseAND(7).cast("int"))
    joined = rows.join(F.broadcast(marks), F.bitmap_bucket_number(at) == F.col("part"))
    return joined.where(bit == 1).select(*rows.columns)


def row_differences(
    source: DataFrame,
    target: DataFrame,
    key: str = "id",
    levels: int = LEVELS,
    level_bits: int = LEVEL_BITS,
) -> DataFrame:
    """The multiset difference of two tables: every row with ``net``, how many more times it
    stands in the source, where that is not zero.

    Each level compares checksums of key ranges, at most two to the power of ``level_bits``
    in each range that differed before, so that rows of equal ranges are read and hashed but
    never shuffled. Of the ranges that differ at the last level, two hashes of each row are
    shuffled and compared as multisets; whole rows are shuffled, and compared, only if their
    hash is among those that differ. Checksums add up, so neither order nor a row lost here
    and added there hides a fault. What is broadcast has a bound: a number for each range, and
    a bitmap of ``MARK_BITS``.
    """
    columns = source.columns
    if set(columns) != set(target.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(target.columns))}")

    def hashed(df: DataFrame) -> DataFrame:
        # a hash passes over NULL, so whether a value is one is hashed as well
        parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
        every = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("it")
        return df.select(
            every,
            F.xxhash64(f"`{key}`", F.col(f"`{key}`").isNull()).alias("kh"),
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(1), *reversed(parts)).alias("h2"),
        )

    have, want = hashed(target), hashed(source)
    for level in range(1, levels + 1):
        bits = level * level_bits
        other = _summed(have, bits).withColumnRenamed("sums", "others")
        differ = (
            _summed(want, bits)
            .join(other, "range", "full_outer")
            .where(~F.col("sums").eqNullSafe(F.col("others")))
            .select("range")
        )
        within = lambda df, bits=bits, differ=differ: (
            df.withColumn("range", _range(bits))
            .join(F.broadcast(differ), "range", "left_semi")
            .drop("range")
        )
        have, want = within(have), within(want)
    pair = lambda df, sign: df.select("h1", "h2", F.lit(sign).alias("sign"))
    odd = pair(want, 1).union(pair(have, -1)).groupBy("h1", "h2")
    marks = _marks(odd.agg(F.sum("sign").alias("net")).where("net <> 0"))
    have, want = _marked(have, marks), _marked(want, marks)
    signed = want.select("it", F.lit(1).alias("sign")).union(have.select("it", F.lit(-1)))
    return (
        signed.groupBy("it").agg(F.sum("sign").alias("net")).where("net <> 0").select("it.*", "net")
    )


def content_difference(
    source: DataFrame,
    target: DataFrame,
    key: str = "id",
    levels: int = LEVELS,
    level_bits: int = LEVEL_BITS,
) -> DataFrame:
    """One row per key whose rows differ: ``key, kind, source_rows, target_rows, changed``.

    ``kind`` is ``lost`` or ``added`` if only the source or the target has rows that the other
    lacks, else ``altered``; the counts are of those rows. ``changed`` names the columns, in
    order, if one row became one other. Rows with a NULL key cannot be told apart by it:
    those lost and those added are counted in a row each.
    """
    columns = [c for c in source.columns if c != key]
    found = row_differences(source, target, key, levels, level_bits)
    side = F.when(F.col(f"`{key}`").isNull(), F.signum("net"))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    more, less = F.when(F.col("net") > 0, F.col("net")), F.when(F.col("net") < 0, -F.col("net"))
    per_key = found.groupBy(F.col(f"`{key}`").alias("key"), side.alias("side")).agg(
        F.coalesce(F.sum(more), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(less), F.lit(0)).alias("target_rows"),
        F.max(F.when(F.col("net") > 0, row)).alias("was"),
        F.max(F.when(F.col("net") < 0, row)).alias("now"),
    )
    named = [
        F.when(~F.col(f"was.`{c}`").eqNullSafe(F.col(f"now.`{c}`")), F.lit(c)) for c in columns
    ]
    alone = (F.col("source_rows") == 1) & (F.col("target_rows") == 1)
    return per_key.select(
        "key",
        F.when(F.col("target_rows") == 0, "lost")
        .when(F.col("source_rows") == 0, "added")
        .otherwise("altered")
        .alias("kind"),
        "source_rows",
        "target_rows",
        F.when(alone, F.array_join(F.array_compact(F.array(*named)), ", ")).alias("changed"),
    )


def reconcile_content(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], names: list[str] = RECONCILED
) -> DataFrame:
    """:func:`content_difference` of several tables by id, with ``table_name``."""
    parts = [
        content_difference(source[name], target[name]).select(
            F.lit(name).alias("table_name"),
            F.col("key").alias("id"),
            "kind",
            "source_rows",
            "target_rows",
            "changed",
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


def company_currencies(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Each company with the currency of its books, its orders and how many are in another one.

    Orders are counted per company and currency id before any name is looked up.
    """
    companies = bronze["res_company"].select(
        F.col("id").alias("company_id"), F.col("name").alias("company"), "currency_id"
    )
    books = bronze["res_currency"].select(
        F.col("id").alias("currency_id"), F.col("name").alias("currency")
    )
    used = (
        bronze["sale_order"]
        .groupBy("company_id", F.col("currency_id").alias("order_currency_id"))
        .agg(F.count("*").alias("n"))
    )
    other = ~F.col("order_currency_id").eqNullSafe(F.col("currency_id"))
    return (
        companies.join(books, "currency_id")
        .join(used, "company_id", "left")
        .groupBy(F.col("company_id").cast("bigint").alias("company_id"), "company", "currency")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orders"),
            F.coalesce(F.sum(F.when(other, F.col("n"))), F.lit(0))
            .cast("bigint")
            .alias("orders_in_other_currency"),
        )
        .orderBy("company_id")
    )
