"""Who sees which rows, and several marts side by side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.plans.mart import GOLD, Star


class ScopedStar(Star):
    """A star whose sales are limited to the zones one person is entitled to.

    ``zones`` has ``territory_id``; repeats do no harm. Sales without a zone belong to nobody
    and are hidden. Only sales and the zone dimension are scoped: customers, products and
    stock are shared.
    """

    def __init__(self, star: Star, zones: DataFrame) -> None:
        self.cfg = star.cfg
        for name in GOLD:
            setattr(self, name, getattr(star, name))
        zones = zones.select("territory_id")
        self.fact_sales = star.fact_sales.join(zones, "territory_id", "left_semi")
        self.dim_territory = star.dim_territory.join(zones, "territory_id", "left_semi")


def managed_zones(star: Star, principal: str) -> DataFrame:
    """The zones of a manager, known by e-mail.

    A semi-join keeps the estimate at the size of the zone table. An inner join would be
    estimated as a product, and the whole fact shuffled for it.
    """
    managers = star.dim_salesperson.filter(F.col("email") == principal).select(
        F.col("salesperson_id").alias("manager_id")
    )
    return star.dim_territory.join(managers, "manager_id", "left_semi").select("territory_id")


def union_tenants(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One Gold table of several tenants as one, with the tenant as first column.

    A column that some of them lack is NULL in their rows.
    """
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [df.select(F.lit(tenant).alias("tenant"), "*") for tenant, df in tables.items()],
    )
