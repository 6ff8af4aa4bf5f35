"""The mart's jobs: ``spark-submit`` this module or run ``python -m starmart JOB``.

  check    compare a source with the contract; exit code 1 if a whole table is absent
  land     export the contract's tables to JSON Lines and stop
  load     export, then replace the Bronze tables
  build    rebuild Silver and Gold from Bronze and check the keys
  ingest   take in the change files that have arrived
  apply    replace Bronze with a landed snapshot plus the change log
  advance  land a newer snapshot from a landed one plus the change log
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart import contract
from starmart.config import MartConfig
from starmart.plans.mart import CatalogTables, build_all
from starmart.plans.versions import current_schema
from starmart.session import configure
from starmart.sources import landing
from starmart.sources.jdbc import JdbcSource
from starmart.streaming.changes import BEFORE_EVERYTHING, ChangeLane


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="starmart", description=__doc__.split("\n")[0])
    jobs = main.add_subparsers(dest="job", required=True)

    source = argparse.ArgumentParser(add_help=False)
    where = source.add_mutually_exclusive_group(required=True)
    where.add_argument("--source-schema", help="catalog schema that holds the source tables")
    where.add_argument("--jdbc-url", help="database that holds the source tables")
    source.add_argument(
        "--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="user, driver, ..."
    )

    source.add_argument("--jdbc-partitions", type=int, default=16, help="id ranges per table")
    source.add_argument("--jdbc-fetch-size", type=int, default=10_000, help="rows per round trip")

    target = argparse.ArgumentParser(add_help=False)
    target.add_argument("--target", default="dev", choices=["dev", "prod"])
    target.add_argument("--catalog")
    target.add_argument("--bronze-schema", default=MartConfig.bronze_schema)
    target.add_argument("--currency", default=MartConfig.currency)

    folder = argparse.ArgumentParser(add_help=False)
    folder.add_argument("--folder", required=True, help="shared folder of the landed files")

    lane = argparse.ArgumentParser(add_help=False)
    lane.add_argument("--lane", required=True, help="shared folder of the change log")
    lane.add_argument("--tables", default=",".join(contract.TABLE_NAMES))

    jobs.add_parser("check", parents=[source])
    jobs.add_parser("land", parents=[source, folder])
    jobs.add_parser("load", parents=[source, folder, target])
    build = jobs.add_parser("build", parents=[target])
    build.add_argument("--quarantine", metavar="FOLDER", help="new shared folder for rows that do not fit")
    ingest = jobs.add_parser("ingest", parents=[lane])
    ingest.add_argument("--feed", required=True, help="folder where change files arrive")
    apply = jobs.add_parser("apply", parents=[lane, folder, target])
    apply.add_argument("--snapshot-lsn", type=int, default=BEFORE_EVERYTHING)
    advance = jobs.add_parser("advance", parents=[lane, folder])
    advance.add_argument("--snapshot-lsn", type=int, default=BEFORE_EVERYTHING)
    advance.add_argument("--position", type=int, required=True, help="the feed is complete up to here")
    advance.add_argument("--new-folder", required=True, help="shared folder of the new snapshot")
    return main


def source_tables(spark: SparkSession, args: argparse.Namespace) -> Mapping[str, DataFrame]:
    if args.jdbc_url:
        options = dict(option.split("=", 1) for option in args.jdbc_option)
        options = {"url": args.jdbc_url, **options}
        return JdbcSource(spark, options, args.jdbc_partitions, args.jdbc_fetch_size)
    schema = args.source_schema
    present = contract.introspect_catalog(spark, current_schema(spark, schema))
    cfg = MartConfig(bronze_schema=schema)
    return CatalogTables(spark, cfg, "bronze", sorted(present))


def config(args: argparse.Namespace) -> MartConfig:
    return MartConfig.for_target(
        args.target,
        catalog=args.catalog,
        bronze_schema=args.bronze_schema,
        currency=args.currency,
    )


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = source_tables(spark, args)
    # a database's catalog says it all: no table is opened
    catalog = isinstance(tables, JdbcSource)
    actual = tables.introspect() if catalog else contract.introspect(tables)
    report = contract.conformance(spark, actual)
    report.orderBy("table_name").show(len(contract.TABLES), truncate=False)
    try:
        full, total = contract.verdict(report)
    except contract.MissingTables as absent:
        print(absent)
        return 1
    print(f"{full}/{total} tables match the contract in full")
    return 0


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job == "check":
        return check(spark, args)
    if args.job in ("land", "load"):
        counts = landing.land(source_tables(spark, args), args.folder)
        for table, n in counts.items():
            print(f"{table:20} {n:12}")
        print(f"{len(counts)} tables, {sum(counts.values())} rows in {args.folder}")
        if args.job == "load":
            landing.publish(spark, args.folder, config(args))
    elif args.job == "build":
        for view, found in build_all(spark, config(args), args.quarantine).items():
            print(view, found)
    else:
        lane = ChangeLane(spark, args.lane, contract.table_list(args.tables))
        if args.job == "ingest":
            lane.start(lane.read_feed(args.feed)).awaitTermination()
        elif args.job == "advance":
            counts = lane.advance(args.folder, args.new_folder, args.position, args.snapshot_lsn)
            print(f"{len(counts)} tables, {sum(counts.values())} rows in {args.new_folder}")
        else:
            lane.publish(args.folder, config(args), args.snapshot_lsn)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return run(configure(SparkSession.builder.appName("starmart").getOrCreate()), args)


if __name__ == "__main__":
    sys.exit(main())
