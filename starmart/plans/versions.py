"""Publication of whole layers that readers survive.

A layer is written into a schema of its own per version, ``gold_v7``. Which version is
current stands in one property of the layer's schema, so one catalog update switches every
table at once. Under the layer's own schema each table's name is a view of the current
version; the views follow the property and can be set again at any time.

A reader that asks :func:`current_schema` once reads all tables of one version, whatever is
published meanwhile. Versions before the current one are kept until they are pruned.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.catalog import Table

from starmart.session import run_jobs

PROPERTY = "current_version"
#: Versions that stay: the current one, and the one before it for readers that still hold it.
KEPT = 2

Write = Callable[[DataFrame, str], None]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def current_version(spark: SparkSession, schema: str) -> int | None:
    """The published version of a layer; None if it was never published, or does not exist."""
    if not spark.catalog.databaseExists(schema):
        return None
    facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE SCHEMA EXTENDED {schema}").collect()}
    found = re.search(rf"\({PROPERTY},(\d+)\)", facts.get("Properties", ""))
    return int(found[1]) if found else None


def current_schema(spark: SparkSession, schema: str) -> str:
    """The schema that holds the tables of a layer's current version.

    A layer that is not versioned, as a source's, is its own.
    """
    version = current_version(spark, schema)
    return schema if version is None else f"{schema}_v{version}"


class Publication:
    """The versions of one layer.

    ``location`` is the folder for the layer's files; unset, the catalog chooses it.
    """

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None) -> None:
        self._spark, self.schema, self._location = spark, schema, location

    def _create(self, schema: str, clause: str = "") -> None:
        name = schema.rpartition(".")[2]
        where = f" LOCATION {_quoted(f'{self._location}/{name}')}" if self._location else ""
        self._spark.sql(f"CREATE SCHEMA {clause}{schema}{where}")

    def versions(self) -> list[int]:
        """All versions there are, staged ones among them."""
        catalog, _, name = self.schema.rpartition(".")
        where = f" IN {catalog}" if catalog else ""
        rows = self._spark.sql(f"SHOW SCHEMAS{where} LIKE '{name}_v*'").collect()
        found = (re.fullmatch(rf"`?{name}_v(\d+)`?", r[0].rpartition(".")[2]) for r in rows)
        return sorted(int(m[1]) for m in found if m)

    def stage(self) -> int:
        """Create the schema of a new version; two builds never share one."""
        self._create(self.schema, "IF NOT EXISTS ")
        version = max([0, *self.versions()]) + 1
        self._create(self.staged(version))
        return version

    def staged(self, version: int) -> str:
        return f"{self.schema}_v{version}"

    def switch(self, version: int) -> None:
        """Make a version the current one, point the views at it and prune old versions.

        A build that dies between the two leaves views of the version before; the next
        publication, or :meth:`point_views`, moves them.
        """
        self._spark.sql(f"ALTER SCHEMA {self.schema} SET DBPROPERTIES ('{PROPERTY}' = '{version}')")
        self.point_views()
        self.prune()

    def _tables(self, schema: str) -> list[Table]:
        # a session's temporary views are listed in every schema
        return [t for t in self._spark.catalog.listTables(schema) if not t.isTemporary]

    def point_views(self) -> None:
        """Set the view of each table of the current version; views of absent tables go."""
        version = current_version(self._spark, self.schema)
        if version is None:
            return
        held = {t.name: t for t in self._tables(self.staged(version))}
        for old in self._tables(self.schema):
            if old.tableType != "VIEW":
                # a table of that name from before the layer had versions
                self._spark.sql(f"DROP TABLE {self.schema}.{old.name}")
            elif old.name not in held:
                self._spark.sql(f"DROP VIEW {self.schema}.{old.name}")
        for name, table in held.items():
            comment = f" COMMENT {_quoted(table.description)}" if table.description else ""
            self._spark.sql(
                f"CREATE OR REPLACE VIEW {self.schema}.{name}{comment} "
                f"AS SELECT * FROM {self.staged(version)}.{name}"
            )

    def prune(self, kept: int = KEPT) -> None:
        """Drop versions older than the last ``kept`` published ones.

        Staged versions above the current one belong to builds that may still run; what a
        dead build left there goes once a later version is current.
        """
        current = current_version(self._spark, self.schema)
        older = [v for v in self.versions() if current is not None and v < current]
        for version in older[: max(0, len(older) - (kept - 1))]:
            self._spark.sql(f"DROP SCHEMA {self.staged(version)} CASCADE")

    def publish(self, tables: Mapping[str, Callable[[], DataFrame]], write: Write) -> int:
        """Write a layer as a new version and switch to it; returns the version.

        ``write(df, name)`` writes one table under its full name. If one fails, nothing of
        the current version has changed and the staged schema is dropped.
        """
        version = self.stage()
        try:
            run_jobs(
                {
                    name: partial(lambda n, make: write(make(), n), f"{self.staged(version)}.{name}", make)
                    for name, make in tables.items()
                }
            )
        except BaseException:
            self.discard(version)
            raise
        self.switch(version)
        return version

    def discard(self, version: int) -> None:
        """Drop a staged version that will not be published."""
        if version == current_version(self._spark, self.schema):
            raise ValueError(f"version {version} of {self.schema} is the current one")
        try:
            self._spark.sql(f"DROP SCHEMA IF EXISTS {self.staged(version)} CASCADE")
        except AnalysisException:
            # another build's pruning came first
            if self._spark.catalog.databaseExists(self.staged(version)):
                raise
