"""Source tables over JDBC, read in parallel ranges of their id.

The driver jar, URL and credentials are the user's; nothing here opens a connection by
itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart import contract


def columns_query(schema: str = "public") -> str:
    """Query for the columns of the contract's tables in ``information_schema``."""
    names = ", ".join(f"'{t}'" for t in contract.TABLE_NAMES)
    return (
        "SELECT table_name, column_name FROM information_schema.columns "
        f"WHERE table_schema = '{schema}' AND table_name IN ({names})"
    )


def bounds_query(table: str, schema: str = "public") -> str:
    return f'SELECT min(id) AS low, max(id) AS high FROM "{schema}"."{table}"'


def table_query(table: str, actual: list[str], schema: str = "public") -> str:
    """Contract columns of a table as text, so that no source type needs a mapping.

    Columns the source lacks are not selected; :func:`starmart.contract.conform` adds them.
    The numeric ``id`` is kept beside its text for the range partitions.
    """
    present = {c.lower(): c for c in actual}
    columns = [
        f'CAST("{present[c.lower()]}" AS text) AS "{c}"'
        for c in contract.TABLES[table]
        if c.lower() in present
    ]
    return f'SELECT id AS range_id, {", ".join(columns)} FROM "{schema}"."{table}"'


class JdbcSource(Mapping):
    """``{contract table: DataFrame}`` over a database the user can reach."""

    def __init__(
        self,
        spark: SparkSession,
        options: Mapping[str, str],
        partitions: int = 16,
        fetch_size: int = 10_000,
        schema: str = "public",
    ) -> None:
        self._spark = spark
        self._options = dict(options)
        self._partitions = partitions
        self._fetch_size = fetch_size
        self._schema = schema
        self._columns: dict[str, list[str]] | None = None

    def _query(self, query: str) -> DataFrame:
        return (
            self._spark.read.format("jdbc").options(**self._options).option("query", query).load()
        )

    def introspect(self) -> dict[str, list[str]]:
        if self._columns is None:
            found: dict[str, list[str]] = {}
            for row in self._query(columns_query(self._schema)).collect():  # catalog rows only
                found.setdefault(row["table_name"], []).append(row["column_name"])
            self._columns = found
        return self._columns

    def __iter__(self) -> Iterator[str]:
        return iter(self.introspect())

    def __len__(self) -> int:
        return len(self.introspect())

    def __getitem__(self, table: str) -> DataFrame:
        columns = self.introspect()[table]
        limits = self._query(bounds_query(table, self._schema)).first()
        reader = (
            self._spark.read.format("jdbc")
            .options(**self._options)
            .option("dbtable", f"({table_query(table, columns, self._schema)}) AS t")
            .option("fetchsize", str(self._fetch_size))
        )
        if limits["low"] is not None:
            reader = (
                reader.option("partitionColumn", "range_id")
                .option("lowerBound", str(limits["low"]))
                .option("upperBound", str(limits["high"] + 1))
                .option("numPartitions", str(self._partitions))
            )
        return reader.load().drop("range_id")
