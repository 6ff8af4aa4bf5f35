"""Changes applied to buckets: same rows as the full apply, and only touched files move."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from starmart.sources.retail import ConformedTables, RetailSource, order_changes
from starmart.streaming.buckets import Buckets, StateLane
from starmart.streaming.changes import ChangeLane, apply_changes
from tests.conftest import SF_DIR, rows
from tests.test_lanes import UOM, change, feed, fold, multiset, snapshot


def files(tmp_path, table=UOM, n=8):
    folder = tmp_path / "bronze" / table / f"of={n}"
    return {
        p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in folder.glob("bucket=*/*.parquet")
    }


@pytest.fixture
def bronze(spark, tmp_path):
    made = Buckets(spark, str(tmp_path / "bronze"), 8, [UOM], 10)
    made.load(UOM, snapshot(spark, *[(str(k), f"n{k}") for k in range(60)], (None, "no id"), ("7", "again")))
    return made


def test_untouched_buckets_keep_their_files(spark, bronze, tmp_path):
    before = files(tmp_path)
    touched = bronze.apply(feed(spark, [change("U", 11, 3, "drei"), change("D", 12, 99), change("U", 9, 4, "old")]))
    after = files(tmp_path)
    moved = {int(b.split("=")[1]) for b in after if after[b] != before.get(b)}
    assert set(touched) == {UOM} and moved == set(touched[UOM]) and 1 <= len(moved) <= 2 < len(before)
    got = multiset(bronze.current(UOM))
    assert got[("3", "drei")] == 1 and got[("4", "n4")] == 1 and got[(None, "no id")] == 1
    assert got[("7", "n7")] == got[("7", "again")] == 1
    assert bronze.apply(feed(spark, [change("U", 12, 3, "x", table="res_country")])) == {}
    assert files(tmp_path) == after


def test_any_order_of_applications(spark, tmp_path):
    rng = random.Random(3)
    records = [change(rng.choice("IUD"), 20 + lsn, rng.randrange(9), f"v{lsn}") for lsn in range(60)]
    start = [(str(k), f"n{k}") for k in range(5)]
    for attempt in range(2):
        bronze = Buckets(spark, str(tmp_path / f"b{attempt}"), 4, [UOM])
        bronze.load(UOM, snapshot(spark, *start))
        parts = rng.sample(records, len(records))
        for k in range(0, 60, 20):
            bronze.apply(feed(spark, parts[k : k + 20] + parts[k : k + 3]))
        bronze.apply(feed(spark, records[:10]))
        assert sorted(rows(bronze.current(UOM))) == sorted(fold(start, records))


def test_forgetting_marks(spark, bronze, tmp_path):
    bronze.apply(feed(spark, [change("D", 20, 1), change("D", 30, 2)]))
    marks = lambda: {r.id for r in bronze._stored(UOM).where("op = 'D'").collect()}
    rest = multiset(bronze.current(UOM))
    assert marks() == {"1", "2"}
    before = files(tmp_path)
    bronze.forget(UOM, 25)
    assert marks() == {"2"} and multiset(bronze.current(UOM)) == rest
    assert sum(files(tmp_path)[b] != before[b] for b in before) == 1
    bronze.apply(feed(spark, [change("U", 29, 2, "too late")]))
    assert multiset(bronze.current(UOM)) == rest


def test_equal_positions_have_one_winner(spark, bronze):
    both = [change("U", 40, 5, "a"), change("U", 40, 5, "b"), change("D", 40, 6), change("U", 40, 6, "kept")]
    for records in (both, both[::-1]):
        bronze.apply(feed(spark, records))
        got = dict(rows(bronze.current(UOM)))
        assert (got["5"], got["6"]) == ("b", "kept")


@pytest.mark.parametrize("image", [None, '{"id": "1", "name": '])
def test_a_broken_row_image_changes_no_bucket(spark, bronze, tmp_path, image):
    before, rest = files(tmp_path), multiset(bronze.current(UOM))
    with pytest.raises(Exception, match="without a row image|MALFORMED_RECORD"):
        bronze.apply(feed(spark, [(UOM, "U", 50, None, "1", image)]))
    assert files(tmp_path) == before and multiset(bronze.current(UOM)) == rest


def test_late_and_repeated_changes_over_batches_and_restarts(spark, tmp_path):
    incoming = tmp_path / "feed"
    incoming.mkdir()
    bronze = Buckets(spark, str(tmp_path / "bronze"), 4, [UOM])
    bronze.load(UOM, snapshot(spark, ("1", "one"), ("2", "two")))

    def arrive(name, *records):
        keys = ("table", "op", "lsn", "commit_ts", "id")
        lines = [json.dumps({**dict(zip(keys, r)), "row": r[5] and json.loads(r[5])}) for r in records]
        (incoming / name).write_text("\n".join(lines) + "\n")

    def ingest():
        lane = StateLane(spark, str(tmp_path / "lane"), bronze)
        changes = ChangeLane(spark, str(tmp_path)).read_feed(str(incoming), max_files=1)
        lane.start(changes).awaitTermination()
        return set(rows(bronze.current(UOM)))

    arrive("a.json", change("D", 30, 2), change("U", 10, 1, "uno"))
    arrive("b.json", change("I", 20, 3, "tres"), change("I", 5, 8, "x", table="unknown_table"))
    assert ingest() == {("1", "uno"), ("3", "tres")}
    assert ingest() == {("1", "uno"), ("3", "tres")}
    arrive("c.json", change("U", 25, 2, "late"), change("U", 10, 1, "uno"), change("D", 40, 3))
    assert ingest() == {("1", "uno")}
    arrive("d.json", change("U", 35, 3, "late too"), change("I", 41, 2, "back"))
    assert ingest() == {("1", "uno"), ("2", "back")}
    arrive("e.json", change("X", 50, 1))
    with pytest.raises(Exception, match="a change without table, id"):
        ingest()


def test_buckets_equal_the_full_apply(spark, tmp_path):
    orders = ConformedTables(RetailSource(spark, SF_DIR))["sale_order"]
    changes = order_changes(orders, 10**12)
    bronze = Buckets(spark, str(tmp_path), 16, ["sale_order"], 10**12)
    bronze.load("sale_order", orders)
    bronze.apply(changes.where(F.col("lsn") % 3 == 0))
    bronze.apply(changes.where(F.col("lsn") % 3 != 0))
    want = apply_changes(orders, changes, "sale_order", 10**12)
    assert multiset(bronze.current("sale_order")) == multiset(want)


def test_the_feed_of_the_state_lane_is_compressed(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "shared_dir", lambda _: str(tmp_path))
    assert entry.bronze_cdc_state(spark, "/root/testdata/sf0.001").count() > 0
    files = list(tmp_path.glob("state-*/feed/part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)


def test_rows_without_a_change_are_moved_once_and_kept_as_often_as_they_were(spark, bronze, monkeypatch):
    plans, write = [], Buckets._write
    monkeypatch.setattr(
        Buckets, "_write", lambda self, df, *a: plans.append(df._jdf.queryExecution().toString()) or write(self, df, *a)
    )
    bronze.apply(feed(spark, [change("U", 11, 7, "sieben"), change("U", 12, 3, "drei")]))
    physical = plans[0].partition("== Physical Plan ==")[2]
    assert physical.count("Exchange") == 1 and "Join" not in physical
    got = multiset(bronze.current(UOM))
    assert got[(None, "no id")] == 1 and got[("7", "sieben")] == 1 and got[("3", "drei")] == 1
    assert ("7", "again") not in got and ("7", "n7") not in got and got[("4", "n4")] == 1
