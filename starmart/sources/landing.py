"""Batch lane: source tables to JSON Lines, JSON Lines to Bronze tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart import contract
from starmart.config import MartConfig
from starmart.plans.mart import write_table
from starmart.plans.versions import Publication
from starmart.session import run_jobs


def as_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, NULL fields kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def land_table(df: DataFrame, table: str, folder: str) -> int:
    """Write one conformed table as JSON Lines; returns the rows written.

    The count is taken while writing, without a second pass. Files are compressed: names and
    digits repeat in every line, so text takes several times the room.
    """
    observation = Observation(f"land_{table}")
    (
        contract.conform(df, table)
        .observe(observation, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("compression", "gzip")
        .json(f"{folder}/{table}")
    )
    return observation.get["rows"]


def land(source: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Export every contract table, or nothing at all if one is absent."""
    contract.require_tables(source)
    return run_jobs(
        {
            table: partial(land_table, source[table], table, folder)
            for table in contract.TABLE_NAMES
        }
    )


def read_landed(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """Landed rows under the explicit all-text schema.

    Absent fields are NULL, unknown fields are ignored and a JSON object stays raw text. A
    line that is no JSON object fails the read: no row is made up and none is lost.
    """
    reader = spark.read.schema(contract.schema(table)).option("mode", "FAILFAST")
    return reader.json(f"{folder}/{table}")


def publish(spark: SparkSession, folder: str, cfg: MartConfig) -> int:
    """Replace all Bronze tables with what has landed, in one switch."""
    tables = {
        table: partial(read_landed, spark, table, folder) for table in contract.TABLE_NAMES
    }
    return Publication(spark, cfg.schema("bronze")).publish(tables, write_table)


def row_counts(tables: Mapping[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """Load report: rows per table."""
    parts = [
        tables[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in (contract.TABLE_NAMES if names is None else names)
    ]
    return reduce(DataFrame.unionByName, parts)
