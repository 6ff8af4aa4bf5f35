"""Batch lane, change lane and the full build."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart import contract
from starmart.config import MartConfig
from starmart.operators import assets, audit, constraints
from starmart.plans.mart import CatalogTables, GoldTables, Mart, build_all, write_gold
from starmart.plans.versions import Publication
from starmart.plans.vocabulary import catalog_comments
from starmart.sources import landing
from starmart.sources.retail import ConformedTables, RetailSource, order_changes
from starmart.streaming import changes
from starmart.streaming.changes import FEED_SCHEMA, ChangeLane, apply_changes
from tests.conftest import SF_DIR, ids, order, rows, sale


def names(prefix: str) -> MartConfig:
    tag = uuid.uuid4().hex[:8]
    return MartConfig(
        bronze_schema=f"{prefix}_b_{tag}",
        silver_schema=f"{prefix}_s_{tag}",
        gold_schema=f"{prefix}_g_{tag}",
        as_of=dt.date(2001, 8, 2),
    )


def multiset(df):
    return Counter(rows(df))


# ----------------------------------------------------------------------- batch lane


def test_landed_files_are_compressed(spark, tmp_path):
    orders = RetailSource(spark, SF_DIR)["sale_order"]
    n = landing.land_table(orders, "sale_order", str(tmp_path))
    files = list((tmp_path / "sale_order").glob("part-*"))
    assert sum(f.stat().st_size for f in files) < 100 * n  # plain lines take about 330 bytes
    assert landing.read_landed(spark, "sale_order", str(tmp_path)).count() == n


def test_landing_round_trip(spark, tmp_path):
    tricky = [
        ("1", '{"es_ES": "Pan, \\"dulce\\"", "en_US": "Bread"}', None, "1.50", "\n\t'", "true", ""),
        ("2", None, None, None, None, None, "ñ\\"),
    ]
    df = spark.createDataFrame(tricky, contract.schema("product_template"))
    assert landing.land_table(df, "product_template", str(tmp_path)) == 2
    back = landing.read_landed(spark, "product_template", str(tmp_path))
    assert multiset(back) == Counter(tricky)
    texts = [r[0] for r in spark.read.text(f"{tmp_path}/product_template").collect()]
    assert all(set(json.loads(t)) == set(contract.TABLES["product_template"]) for t in texts)
    assert sorted(r[0] for r in landing.as_json(df).collect()) == sorted(texts)


def test_reading_foreign_files(spark, tmp_path):
    folder = tmp_path / "uom_uom"
    folder.mkdir()
    (folder / "part.json").write_text(
        '{"id": 7, "name": {"en_US": "a,b", "es_ES": "c"}, "extra": 1}\n{"id": "8"}\n'
    )
    found = rows(landing.read_landed(spark, "uom_uom", str(tmp_path)))
    assert found == [("7", '{"en_US": "a,b", "es_ES": "c"}'), ("8", None)]
    (folder / "bad.json").write_text("not json\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        rows(landing.read_landed(spark, "uom_uom", str(tmp_path)))


def test_export_needs_every_table(spark, bronze, tmp_path):
    source = dict(bronze())
    del source["stock_quant"]
    with pytest.raises(contract.MissingTables, match="stock_quant"):
        landing.land(source, str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def test_full_build(spark, tmp_path):
    source = RetailSource(spark, SF_DIR)
    cfg = names("full")
    counts = landing.land(source, str(tmp_path))
    assert counts["sale_order"] == 1500 and sum(counts.values()) == sum(
        r.rows for r in landing.row_counts(source).collect()
    )
    landing.publish(spark, str(tmp_path), cfg)
    bronze = CatalogTables(spark, cfg, "bronze", contract.TABLE_NAMES)
    assert all(r.difference == 0 for r in audit.reconcile(source, bronze).collect())
    assert multiset(bronze["res_partner"]) == multiset(ConformedTables(source)["res_partner"])

    quality = build_all(spark, cfg)
    assert quality["silver_orders"]["status_is_known"] > 0
    assert quality["silver_orders"]["order_has_id"] == 0

    built, direct = GoldTables(spark, cfg), Mart(ConformedTables(source), cfg)
    assert multiset(built.fact_sales.select(*direct.fact_sales.columns)) == multiset(direct.fact_sales)
    for question in (assets.top_products, assets.sales_by_state):
        year = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))
        assert rows(question(built, *year)) == rows(question(direct, *year))
    comments = {(r.table_name, r.column_name) for r in
                catalog_comments(spark, cfg.schema("gold")).collect()}
    assert ("dim_customer", "state") in comments and ("fact_sales", "subtotal") in comments

    # A new version replaces the view; a star made before stays with its own.
    part = direct.fact_sales.filter("sale_year = 1997")
    Publication(spark, cfg.schema("gold")).publish({"fact_sales": lambda: part}, write_gold)
    years = lambda df: {r[0] for r in df.select("sale_year").distinct().collect()}
    assert years(spark.table(cfg.table("gold", "fact_sales"))) == {1997}
    assert years(GoldTables(spark, cfg, ["fact_sales"]).fact_sales) == {1997} < years(built.fact_sales)


def test_build_refuses_a_source_without_tables(spark):
    cfg = names("none")
    spark.sql(f"CREATE SCHEMA {cfg.schema('bronze')}")
    with pytest.raises(contract.MissingTables):
        build_all(spark, cfg)


# ---------------------------------------------------------------------- constraints


def test_constraint_report(mart):
    m = mart(
        [sale(1, 1), sale(2, 1, partner_id=None), sale(3, 1, partner_id=99), sale(4, 1, partner_id=99)],
        res_users=[{"id": 1, "login": "a"}, {"id": 1, "login": "b"}, {"id": 2, "login": "c"}],
    )
    found = {r.constraint_name: (r.checked, r.violations) for r in m.constraint_report().collect()}
    assert found["fk_sales_customer"] == (4, 2)
    assert found["pk_salesperson"] == (3, 1)
    assert found["nn_customer"] == (5, 0)
    assert found["pk_order"] == (4, 0)
    with pytest.raises(constraints.ConstraintViolation, match="fk_sales_customer on fact_sales: 2"):
        constraints.enforce(m.constraint_report())
    constraints.enforce(mart([sale(1, 1)]).constraint_report())
    empty = {r.constraint_name: r.checked for r in mart().constraint_report().collect()}
    assert len(empty) == 15 and empty["fk_sales_customer"] == empty["pk_order"] == 0


def test_null_keys_are_reported(mart):
    m = mart([sale(1, 1)])
    tables = {n: getattr(m, n) for n in ("dim_territory", "dim_salesperson", "dim_product",
                                         "fact_sales", "fact_inventory", "silver_orders")}
    tables["dim_customer"] = m.dim_customer.withColumn(
        "customer_id", F.when(F.col("customer_id") != 1, F.col("customer_id"))
    )
    found = {r.constraint_name: r.violations for r in constraints.report(tables).collect()}
    assert found["nn_customer"] == 1 and found["fk_sales_customer"] == 1


def test_company_currencies(bronze):
    b = bronze(sale_order=[order(1), order(2, currency_id=2), order(3, currency_id=None),
                           order(4, company_id=2, currency_id=2), order(5, company_id=None)])
    assert rows(audit.company_currencies(b)) == [(1, "Uno", "HNL", 3, 2), (2, "Dos", "USD", 1, 0)]


# ---------------------------------------------------------------------- change lane

UOM = "uom_uom"


def change(op, lsn, id, name=None, table=UOM):
    row = None if op == "D" else json.dumps({"id": str(id), "name": name})
    return (table, op, lsn, None, str(id), row)


def feed(spark, records):
    return spark.createDataFrame(records, FEED_SCHEMA)


def snapshot(spark, *pairs):
    return spark.createDataFrame(list(pairs), contract.schema(UOM))


def test_apply_changes(spark):
    snap = snapshot(spark, ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four"))
    records = [
        change("U", 11, 1, "uno"),
        change("D", 12, 2),
        change("D", 13, 3), change("I", 14, 3, "tres"),
        change("I", 15, 5, "cinco"), change("I", 15, 5, "cinco"),
        change("D", 21, 6), change("U", 16, 6, "late"),
        change("U", 9, 4, "already in the snapshot"), change("I", 8, 7, "deleted before it"),
        change("U", 99, 4, "other table", table="res_country"),
    ]
    want = {("1", "uno"), ("3", "tres"), ("4", "four"), ("5", "cinco")}
    got = apply_changes(snap, feed(spark, records), UOM, 10)
    assert set(rows(got)) == want and got.count() == 4
    assert got.columns == contract.TABLES[UOM]
    again = apply_changes(got, feed(spark, records), UOM, 10)
    assert set(rows(again)) == want


@pytest.mark.parametrize("image", [None, '{"id": "1", "name": '])
def test_a_broken_row_image_fails_the_job(spark, image):
    broken = feed(spark, [(UOM, "U", 1, None, "1", image)])
    with pytest.raises(Exception, match="without a row image|MALFORMED_RECORD"):
        apply_changes(snapshot(spark, ("1", "one")), broken, UOM).collect()


def fold(start, records):
    """The state after the changes, in plain Python."""
    state = dict(start)
    for _, op, _, _, key, row in sorted(records, key=lambda r: r[2]):
        if op == "D":
            state.pop(key, None)
        else:
            state[key] = json.loads(row)["name"]
    return set(state.items())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("IUD"), st.integers(1, 5)), min_size=1, max_size=25),
    st.randoms(use_true_random=False),
)
def test_changes_in_any_order_and_repeated(spark, steps, rnd):
    records = [change(op, lsn, key, f"v{lsn}") for lsn, (op, key) in enumerate(steps)]
    shuffled = records + rnd.sample(records, rnd.randint(0, len(records)))
    rnd.shuffle(shuffled)
    start = [("1", "a"), ("2", "b"), ("9", "c")]
    got = apply_changes(snapshot(spark, *start), feed(spark, shuffled), UOM)
    assert sorted(rows(got)) == sorted(fold(start, records))


def test_stream_survives_restarts_and_late_records(spark, tmp_path):
    """Each run ingests what is new; an update older than a seen delete does not revive a row."""
    incoming, lane_dir = tmp_path / "feed", str(tmp_path / "lane")
    incoming.mkdir()
    snap = snapshot(spark, ("1", "one"), ("2", "two"))

    def arrive(name, *records):
        keys = ("table", "op", "lsn", "commit_ts", "id")
        lines = [
            json.dumps({**dict(zip(keys, r)), "row": None if r[5] is None else json.loads(r[5])})
            for r in records
        ]
        (incoming / name).write_text("\n".join(lines) + "\n")

    def ingest():
        lane = ChangeLane(spark, lane_dir)
        lane.start(lane.read_feed(str(incoming), max_files=1)).awaitTermination()
        return set(rows(lane.current(UOM, snap)))

    arrive("a.json", change("D", 30, 2), change("U", 10, 1, "uno"))
    arrive("b.json", change("I", 20, 3, "tres"), change("I", 5, 8, "x", table="unknown_table"))
    assert ingest() == {("1", "uno"), ("3", "tres")}
    assert ingest() == {("1", "uno"), ("3", "tres")}
    arrive("c.json", change("U", 25, 2, "late"), change("U", 10, 1, "uno"), change("D", 40, 3))
    assert ingest() == {("1", "uno")}


def test_replayed_batch_replaces_its_folder(spark, tmp_path):
    lane = ChangeLane(spark, str(tmp_path))
    batch = feed(spark, [change("I", 1, 1, "a"), change("U", 2, 1, "b")])
    lane._append(batch, 0)
    lane._append(batch, 0)
    lane._append(feed(spark, [change("D", 3, 4)]), 1)
    log = lane.changes()
    assert sorted((r.batch, r.lsn, r.table) for r in log.collect()) == [(0, 2, UOM), (1, 3, UOM)]


@pytest.mark.parametrize(
    "spoiled", [{"table": None}, {"op": None}, {"op": "X"}, {"lsn": None}, {"id": None}]
)
def test_a_change_that_says_too_little_is_refused(spark, tmp_path, spoiled):
    record = dict(zip(("table", "op", "lsn", "commit_ts", "id", "row"), change("U", 2, 1, "b")))
    lane = ChangeLane(spark, str(tmp_path))
    batch = feed(spark, [change("I", 1, 1, "a"), tuple({**record, **spoiled}.values())])
    with pytest.raises(Exception, match="a change without table, id"):
        lane._append(batch, 0)


def test_without_a_batch_the_log_is_empty(spark, tmp_path):
    snap = snapshot(spark, ("1", "one"))
    assert rows(ChangeLane(spark, str(tmp_path)).current(UOM, snap)) == [("1", "one")]


@pytest.mark.parametrize("position", [0, 2, 3, 5])
def test_a_snapshot_moved_forward_gives_the_same_bronze(spark, tmp_path, position):
    lane = ChangeLane(spark, str(tmp_path / "lane"), [UOM])
    landing.land_table(snapshot(spark, ("1", "one"), ("2", "two")), UOM, str(tmp_path / "a"))
    lane._append(feed(spark, [change("U", 1, 1, "b"), change("D", 2, 2), change("I", 3, 3, "c")]), 0)
    lane._append(feed(spark, [change("U", 4, 1, "d"), change("D", 5, 3)]), 1)
    before = landing.read_landed(spark, UOM, str(tmp_path / "a"))
    lane.advance(str(tmp_path / "a"), str(tmp_path / "b"), position)
    after = landing.read_landed(spark, UOM, str(tmp_path / "b"))
    assert rows(lane.current(UOM, after, position)) == rows(lane.current(UOM, before)) == [("1", "d")]


def test_both_lanes_give_the_same_bronze(spark, tmp_path):
    """A reload of the final source equals snapshot plus change log, table by table."""
    source = ConformedTables(RetailSource(spark, SF_DIR))
    before = str(tmp_path / "before")
    landing.land(source, before)
    lane = ChangeLane(spark, str(tmp_path / "lane"))
    order_changes(source["sale_order"], 10**12).write.json(str(tmp_path / "feed"))
    lane.start(lane.read_feed(str(tmp_path / "feed"))).awaitTermination()
    cfg = names("cdc")
    lane.publish(before, cfg, 10**12)
    got = CatalogTables(spark, cfg, "bronze", contract.TABLE_NAMES)

    after = dict(source)
    after["sale_order"] = apply_changes(
        source["sale_order"], order_changes(source["sale_order"], 10**12), "sale_order", 10**12
    )
    reload_cfg = names("reload")
    landing.land(after, str(tmp_path / "after"))
    landing.publish(spark, str(tmp_path / "after"), reload_cfg)
    want = CatalogTables(spark, reload_cfg, "bronze", contract.TABLE_NAMES)
    for table in contract.TABLE_NAMES:
        assert got[table].exceptAll(want[table]).isEmpty(), table
        assert want[table].exceptAll(got[table]).isEmpty(), table


def test_new_order_appears_after_reload(mart, bronze):
    year = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    first = mart([sale(1, 10)])
    second = mart([sale(1, 10), sale(2, 5)])
    assert rows(assets.sales_by_territory(first, *year))[0][2] == 1
    assert rows(assets.sales_by_territory(second, *year))[0][2] == 2
    assert ids(second.silver_orders, "order_id") == [1, 2]


def test_changes_at_one_position_give_one_result(spark):
    """The order in which they arrive does not choose between them."""
    change = [("sale_order", op, 5, None, "1", row) for op, row in (("U", "b"), ("U", "a"), ("I", "z"))]
    for feed in (change, change[::-1], change[1:] + change[:1]):
        last = changes.latest(spark.createDataFrame(feed, changes.FEED_SCHEMA)).collect()
        assert [(r["op"], r["row"]) for r in last] == [("U", "b")]


def test_written_tables_are_compressed_by_zstd(spark, tmp_path):
    from starmart.plans.mart import write_table

    name = f"packed_{tmp_path.name}".replace("-", "_")
    write_table(spark.range(9).selectExpr("concat('S', id) AS ref"), name)
    files = spark.table(name).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files), files
    spark.sql(f"DROP TABLE {name}")
