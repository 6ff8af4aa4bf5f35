"""Row numbers over a whole result, at any size."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.session import shared_dir

#: Bits of ``monotonically_increasing_id`` below the number of the partition.
WITHIN = 33


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """The rows with their place, from 1 on, in the given order.

    Rows that are equal in ``order`` follow in the order of their columns, so the result
    repeats and equal keys spread over tasks. The rows are dealt by ranges and sorted, each
    task numbers its own, and the number of rows before a task's first is added. No task holds
    more than a range; only the tasks' row counts, one each, meet in one. The sorted rows are
    written to the shared folder, since the ranges of a second run could differ.
    """
    spark = df.sparkSession
    columns = [F.col(f"`{c}`") for c in df.columns]
    step = df.orderBy(*order, *columns).select(
        F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("id")
    )
    folder = f"{shared_dir(spark)}/numbered-{uuid.uuid4().hex}"
    step.write.parquet(folder)
    rows = spark.read.schema(step.schema).parquet(folder).select(
        "row",
        F.shiftright("id", WITHIN).alias("task"),
        F.col("id").bitwiseAND(2**WITHIN - 1).alias("at"),
    )
    # one row for each task of the sort, whatever the number of rows
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("task").agg(F.count("*").alias("n"))
    starts = starts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "task").select(
        "row.*", (F.col("start") + F.col("at") + 1).alias(name)
    )
