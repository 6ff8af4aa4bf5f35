"""Bronze in hash buckets of the id, where applying changes rewrites only what they touch.

Each row keeps the log position and operation that made it, and a deleted row stays as a
mark. So changes may arrive in any order, late or twice, over any number of applications:
the latest position wins wherever it comes from. Marks go with :meth:`Buckets.forget`, once
the feed is complete up to their position.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart import contract
from starmart.session import COMPRESSION, run_jobs
from starmart.streaming.changes import BEFORE_EVERYTHING, DELETE, checked, latest

#: Operation of rows that come from a snapshot; it sorts before those of the feed.
LOADED = ""


class Buckets:
    """Bronze tables under one folder, each in ``buckets`` partitions of its id's hash.

    The number of buckets is part of the path, so a table is never read with another one.
    Choose it so that a bucket is a few files: a change costs the rewrite of its bucket.
    ``snapshot_lsn`` is the position of the snapshots that are loaded; older changes are in
    them already.

    An application that fails before its commit leaves all buckets as they were, and is run
    again. The commit replaces one bucket after the other; if the driver dies within it, load
    the snapshot again and apply the feed from its beginning.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        buckets: int = 64,
        tables: Sequence[str] = contract.TABLE_NAMES,
        snapshot_lsn: int = BEFORE_EVERYTHING,
    ) -> None:
        self._spark, self._folder, self._n = spark, folder, buckets
        self._tables, self._snapshot_lsn = list(tables), snapshot_lsn

    def path(self, table: str) -> str:
        return f"{self._folder}/{table}/of={self._n}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self._n)).cast("int").alias("bucket")

    def _write(self, rows: DataFrame, table: str, mode: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .option("compression", COMPRESSION)
            .partitionBy("bucket")
            .parquet(self.path(table))
        )

    def _stored(self, table: str) -> DataFrame:
        columns = ", ".join(f"`{c}` STRING" for c in contract.TABLES[table])
        schema = f"lsn BIGINT, op STRING, {columns}, bucket INT"
        return self._spark.read.schema(schema).parquet(self.path(table))

    def load(self, table: str, snapshot: DataFrame) -> None:
        """Replace a table by a snapshot with the contract's columns."""
        rows = snapshot.select(
            F.lit(self._snapshot_lsn).cast("bigint").alias("lsn"),
            F.lit(LOADED).alias("op"),
            *contract.TABLES[table],
            self._bucket(),
        )
        self._write(rows.hint("rebalance", "bucket"), table, "static")

    def current(self, table: str) -> DataFrame:
        """Bronze rows of a table after all changes applied so far."""
        return self._stored(table).where(F.col("op") != DELETE).select(*contract.TABLES[table])

    def apply(self, changes: DataFrame) -> dict[str, list[int]]:
        """Apply changes of all tables; returns the buckets rewritten per table.

        The changes are read and folded once. Which buckets they touch comes to the driver,
        at most one number per table and bucket, so that the others are not even listed.
        """
        newer = F.col("lsn") > self._snapshot_lsn
        mine = changes.where(newer & F.col("table").isin(self._tables))
        path = f"{self._folder}/folded/{uuid.uuid4().hex}"
        fold = latest(mine).withColumn("bucket", self._bucket())
        fold.write.option("compression", COMPRESSION).partitionBy("table").parquet(path)
        schema = "op STRING, lsn BIGINT, id STRING, row STRING, bucket INT, table STRING"
        folded = self._spark.read.schema(schema).parquet(path)
        touched: dict[str, list[int]] = {}
        for found in folded.select("table", "bucket").distinct().collect():
            touched.setdefault(found["table"], []).append(found["bucket"])
        run_jobs({t: partial(self._merge, t, folded, some) for t, some in touched.items()})
        return {t: sorted(some) for t, some in touched.items()}

    def _merge(self, table: str, folded: DataFrame, touched: list[int]) -> None:
        columns = contract.TABLES[table]
        changed = folded.where(F.col("table") == table)
        missing = F.raise_error(F.lit(f"change of {table} without a row image")).cast("string")
        image = F.when(F.col("op") != DELETE, F.coalesce("row", missing))
        row = F.from_json(image, contract.schema(table), {"mode": "FAILFAST"})
        new = changed.select("lsn", "op", row.alias("r"), "id", "bucket").select(
            "lsn",
            "op",
            *[F.col("id") if c == "id" else F.col(f"r.{c}").alias(c) for c in columns],
            "bucket",
        )
        old = self._stored(table).where(F.col("bucket").isin(touched))
        every = old.select("lsn", "op", *columns, "bucket", F.lit(False).alias("fresh")).union(
            new.select("lsn", "op", *columns, "bucket", F.lit(True))
        )
        # an id that is NULL or repeated in the snapshot stays as it is until a change names it
        lone = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
        # one exchange serves both the comparison and the files, which are a bucket's each
        dealt = every.withColumn("lone", lone).repartition("bucket")
        of = W.partitionBy("bucket", "id", "lone")
        others = F.struct(*[c for c in columns if c != "id"])
        ranked = dealt.withColumns(
            {
                "nth": F.row_number().over(of.orderBy(F.desc("lsn"), F.desc("op"), others.desc())),
                "named": F.max("fresh").over(of),
            }
        )
        won = ranked.where("nth = 1 OR NOT named").select("lsn", "op", *columns, "bucket")
        self._write(won, table, "dynamic")

    def forget(self, table: str, position: int) -> None:
        """Drop the marks of rows deleted up to a position to which the feed is complete.

        Only buckets that hold such marks are rewritten.
        """
        old = self._stored(table)
        done = (F.col("op") == DELETE) & (F.col("lsn") <= position)
        touched = [r["bucket"] for r in old.where(done).select("bucket").distinct().collect()]
        if touched:
            kept = old.where(F.col("bucket").isin(touched) & ~done)
            self._write(kept.hint("rebalance", "bucket"), table, "dynamic")


class StateLane:
    """Feed files to bucketed Bronze, the latest change of each row held in a state store.

    A micro-batch is combined with what the store knows: a change older than one seen before,
    in any batch, changes nothing. Rows whose latest change is new go to the buckets; a batch
    replayed after a failure writes the same rows again.

    The store grows with the number of different ids that ever changed; with many of them, use
    the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``), which keeps
    them on disk.
    """

    def __init__(self, spark: SparkSession, folder: str, bronze: Buckets) -> None:
        self._spark, self._bronze = spark, bronze
        self._offsets = f"{folder}/state-offsets"

    def start(self, changes: DataFrame) -> StreamingQuery:
        """Ingest everything that is there, then stop; run it on a schedule."""
        return (
            latest(checked(changes))
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, _: self._bronze.apply(batch))
            .option("checkpointLocation", self._offsets)
            .trigger(availableNow=True)
            .start()
        )
