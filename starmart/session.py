"""Session settings the mart relies on; all of them can change at run time."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Result = TypeVar("Result")

# Jobs submitted side by side, so that small tables do not wait for large ones.
CONCURRENT_JOBS = 4

# Codec of the tables that are written: Bronze is text, which Spark's default halves at best.
COMPRESSION = "zstd"

SETTINGS = {
    # Casts and divisions must fail loudly instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Day and month boundaries follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One order, customer or NULL zone may hold a large part of the fact: let AQE split
    # that partition even if a later step then needs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What is broadcast goes through the driver: a table whose rows are counted has the size
    # of its rows there, not that of its compressed files.
    "spark.sql.cbo.planStats.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def run_jobs(jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent Spark jobs from a few threads; the first failure is raised."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        submitted = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: future.result() for name, future in submitted.items()}


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Driver-side metadata as a frame whose size the optimizer knows.

    A frame made from a list of rows has no size estimate, so a join with it would shuffle
    the other side; one made from Arrow is a local relation.
    """
    schema = T.StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches, for tables written between jobs.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver
    and executors share one disk, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="starmart-", dir=os.environ.get("TMPDIR"))
