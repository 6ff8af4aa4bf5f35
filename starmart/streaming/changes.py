"""Change-capture lane: the same Bronze tables from a snapshot and a change feed.

A change record carries the full row after the change, as JSON text, and its position in
the source log. The feed may repeat records and deliver them out of order; only the
position decides which one is the latest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart import contract
from starmart.config import MartConfig
from starmart.plans.mart import write_table
from starmart.plans.versions import Publication, current_schema
from starmart.session import run_jobs
from starmart.sources.landing import land_table, read_landed

# Operations of the feed are I(nsert), U(pdate) and D(elete).
OPERATIONS = ("I", "U", "D")
DELETE = "D"
FEED_SCHEMA = "table STRING, op STRING, lsn BIGINT, commit_ts TIMESTAMP, id STRING, row STRING"
BEFORE_EVERYTHING = -1


def latest(changes: DataFrame) -> DataFrame:
    """The last change per table and id.

    Changes of one row are combined on the map side, so a row that is updated all the time
    reaches the shuffle once per task. Deletes stay in the result: without them an older
    update that arrives later would bring the row back. Of several changes of a row at one log
    position the last by operation and row image counts, so that the result repeats.
    """
    return (
        changes.groupBy("table", "id")
        .agg(F.max_by(F.struct("op", "lsn", "commit_ts", "row"), F.struct("lsn", "op", "row")).alias("last"))
        .select("table", "id", "last.*")
    )


def checked(changes: DataFrame) -> DataFrame:
    """The same changes; one that says too little to be applied fails the job."""
    known = F.coalesce(F.col("op").isin(*OPERATIONS), F.lit(False))
    told = known & F.col("table").isNotNull() & F.col("id").isNotNull() & F.col("lsn").isNotNull()
    refused = F.raise_error(F.lit("a change without table, id, log position or known operation"))
    return changes.withColumn("table", F.when(told, F.col("table")).otherwise(refused.cast("string")))


def apply_changes(
    snapshot: DataFrame,
    changes: DataFrame,
    table: str,
    snapshot_lsn: int = BEFORE_EVERYTHING,
) -> DataFrame:
    """Bronze rows of a table after its changes.

    ``snapshot`` has the contract's columns and reflects the source up to
    ``snapshot_lsn``; changes up to there are already in it and are ignored (C3), so
    applying a feed that overlaps the snapshot, or applying it twice, gives the same rows.

    The changes are read twice, once for their ids alone: an anti-join with few ids leaves
    the snapshot where it is, which a full outer join with the changes would shuffle.
    """
    newer = changes.filter((F.col("table") == table) & (F.col("lsn") > snapshot_lsn))
    untouched = snapshot.join(newer.select("id").distinct(), "id", "left_anti")
    image = F.coalesce("row", F.raise_error(F.lit(f"change of {table} without a row image")))
    row = F.from_json(image, contract.schema(table), {"mode": "FAILFAST"})
    written = (
        latest(newer)
        .filter(F.col("op") != DELETE)
        .select(row.alias("r"), F.col("id").alias("key"))
        .select(F.col("key").alias("id"), *[f"r.{c}" for c in contract.TABLES[table] if c != "id"])
    )
    columns = contract.TABLES[table]
    return untouched.select(*columns).unionByName(written.select(*columns))


class ChangeLane:
    """Feed files to Bronze through a Parquet change log.

    Every micro-batch is reduced to the latest change per row and written to its own
    folder of the log, named by batch id: a batch that is replayed after a failure replaces
    its folder. Bronze is the landed snapshot with the log applied. A fresh snapshot with
    a higher position makes older log folders unnecessary.
    """

    def __init__(
        self, spark: SparkSession, folder: str, tables: Sequence[str] = contract.TABLE_NAMES
    ) -> None:
        self._spark = spark
        self._tables = list(tables)
        self._log = f"{folder}/log"
        self._offsets = f"{folder}/offsets"

    def read_feed(self, feed: str, max_files: int = 1000) -> DataFrame:
        """Streaming frame over a folder where change files arrive as JSON Lines.

        A broken line stops the stream before its offsets are committed.
        """
        return (
            self._spark.readStream.schema(FEED_SCHEMA)
            .option("maxFilesPerTrigger", max_files)
            .option("mode", "FAILFAST")
            .json(feed)
        )

    def start(self, changes: DataFrame) -> StreamingQuery:
        """Ingest everything that is there, then stop; run it on a schedule."""
        return (
            changes.writeStream.foreachBatch(self._append)
            .option("checkpointLocation", self._offsets)
            .trigger(availableNow=True)
            .start()
        )

    def _append(self, batch: DataFrame, batch_id: int) -> None:
        """Log the changes of all tables; those asked for are picked when the log is read."""
        (
            latest(checked(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("table")
            .parquet(f"{self._log}/batch={batch_id}")
        )

    def changes(self) -> DataFrame:
        """The change log so far; without a batch it is empty."""
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._log)
        hadoop = self._spark.sparkContext._jsc.hadoopConfiguration()
        if not path.getFileSystem(hadoop).exists(path):
            return self._spark.createDataFrame([], f"{FEED_SCHEMA}, batch BIGINT")
        return (
            self._spark.read.schema(f"{FEED_SCHEMA}, batch BIGINT")
            .option("basePath", self._log)
            .parquet(self._log)
        )

    def current(
        self, table: str, snapshot: DataFrame, snapshot_lsn: int = BEFORE_EVERYTHING
    ) -> DataFrame:
        return apply_changes(snapshot, self.changes(), table, snapshot_lsn)

    def publish(
        self, landed: str, cfg: MartConfig, snapshot_lsn: int = BEFORE_EVERYTHING
    ) -> None:
        """Replace the Bronze tables with the landed snapshot plus the log, in one switch (C4).

        Tables that this lane does not take part in stay as they are.
        """
        present = current_schema(self._spark, cfg.schema("bronze"))

        def fresh(table: str) -> DataFrame:
            snapshot = read_landed(self._spark, table, landed)
            return self.current(table, snapshot, snapshot_lsn)

        kept = {
            t.name: partial(self._spark.table, f"{present}.{t.name}")
            for t in (self._spark.catalog.listTables(present) if self._spark.catalog.databaseExists(present) else [])
            if not t.isTemporary
        }
        tables = kept | {table: partial(fresh, table) for table in self._tables}
        Publication(self._spark, cfg.schema("bronze")).publish(tables, write_table)

    def advance(
        self, landed: str, target: str, position: int, snapshot_lsn: int = BEFORE_EVERYTHING
    ) -> dict[str, int]:
        """Land the snapshot as of ``position`` in a new folder; returns the rows per table.

        The feed must be complete up to ``position``. Read with that position, the new
        snapshot gives the same Bronze, and the filter on the log position, which reaches
        the Parquet scan, skips what it already holds.
        """
        if target.rstrip("/") == landed.rstrip("/"):
            raise ValueError("the new snapshot needs a folder of its own")

        def land(table: str) -> int:
            snapshot = read_landed(self._spark, table, landed)
            known = self.changes().filter(F.col("lsn") <= position)
            return land_table(apply_changes(snapshot, known, table, snapshot_lsn), table, target)

        return run_jobs({table: partial(land, table) for table in self._tables})
