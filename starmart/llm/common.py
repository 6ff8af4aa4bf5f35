"""What several corpus operators share: reading, stored steps, words, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import shared_dir

#: What stands between the words of most contracts.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it again.

    Lineage ends there: an executor lost later costs only the tasks of the step that runs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(docs: DataFrame) -> DataFrame:
    """All columns in one, ``row``, so that no column name of the input can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def words(text: Column, between: str = SPACE) -> Column:
    """The words of a text, an empty array for NULL."""
    return F.coalesce(
        F.array_remove(F.split(text, between), ""), F.array().cast("array<string>")
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every linked node, as ``(node, root)``.

    ``links`` has two BIGINT columns ``a, b``; nodes without a link to another are left out.
    Alternates large-star and small-star steps until the edges no longer change, which takes
    a number of rounds in the order of the logarithm of the largest component. A round is
    two joins and two aggregations; what crosses to the driver is one count and one checksum.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        nearest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(nearest.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct("u", F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.*").where("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v"), F.col("v")).distinct())
