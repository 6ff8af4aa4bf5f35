"""Several tenants, each with Bronze, Silver and Gold schemas of its own.

What a tenant's rebuild writes lies in its own schemas, so the others' files stay as they
are. Over all tenants a table is the union of theirs under a ``tenant`` column. That column
is a constant in each part, so a filter on it takes the other tenants out of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart import contract
from starmart.config import MartConfig
from starmart.plans.mart import GoldTables, Star, build_all, write_table
from starmart.plans.scope import union_tenants
from starmart.plans.versions import Publication

LAYERS = ("bronze", "silver", "gold")


class Tenants:
    """The marts of several tenants by name.

    Their schemas must all differ. ``folder`` is where their files go; unset, the catalog
    chooses.
    """

    def __init__(
        self, spark: SparkSession, configs: Mapping[str, MartConfig], folder: str | None = None
    ) -> None:
        schemas = [cfg.schema(layer).lower() for cfg in configs.values() for layer in LAYERS]
        shared = sorted({s for s in schemas if schemas.count(s) > 1})
        if shared:
            raise ValueError(f"schemas of more than one tenant or layer: {shared}")
        self._spark, self.configs, self._folder = spark, dict(configs), folder

    def land(self, tenant: str, source: Mapping[str, DataFrame]) -> int:
        """Publish a tenant's Bronze, conformed to the contract; returns its version."""
        layer = Publication(self._spark, self.configs[tenant].schema("bronze"), self._folder)
        rows = {
            name: lambda name=name: contract.conform(source[name], name)
            for name in contract.TABLE_NAMES
        }
        return layer.publish(rows, write_table)

    def build(self, tenant: str, quarantine: str | None = None) -> dict[str, dict[str, int]]:
        """Rebuild one tenant's Silver and Gold from its Bronze."""
        return build_all(self._spark, self.configs[tenant], quarantine, self._folder)

    def star(self, tenant: str) -> Star:
        return GoldTables(self._spark, self.configs[tenant])

    def ask(
        self, question: Callable[[Star], DataFrame], tenants: Iterable[str] | None = None
    ) -> DataFrame:
        """A question's rows for each tenant, one below the other.

        Keys are a tenant's own, so each is asked by itself. Columns that a tenant lacks are
        NULL in its rows.
        """
        names = list(self.configs if tenants is None else tenants)
        return union_tenants({name: question(self.star(name)) for name in names})

    def table(self, name: str) -> DataFrame:
        """One Gold table of all tenants."""
        return self.ask(lambda star: getattr(star, name))
