"""Differences by content: equal to a multiset difference, whatever the ranges."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from starmart.operators import audit
from tests.conftest import rows

SCHEMA = "id string, name string, n bigint, `odd name` string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    some = lambda *x: rng.choice(x)
    made = [(str(k), some("a", "b", None, ""), some(1, None, 2**40), some("x", None)) for k in range(300)]
    return made + made[:5] + [(None, "a", 1, None)] * 3 + [(None, None, None, None)]


@pytest.mark.parametrize("levels, bits", [(2, 10), (1, 1), (3, 2)])
def test_row_differences_equal_a_multiset_difference(spark, levels, bits):
    source = table(1)
    rng = random.Random(2)
    target = [r for r in source if rng.random() > 0.05] + rng.sample(source, 9)
    target += [("7", None, 1, "x"), ("7", "", 1, "x"), ("new", "a", None, "x"), (None, "z", 1, "")]
    want = Counter(source)
    want.subtract(Counter(target))
    want = sorted(((*r, n) for r, n in want.items() if n), key=repr)
    found = audit.row_differences(frame(spark, source), frame(spark, target), "id", levels, bits)
    assert sorted(rows(found), key=repr) == want


def test_one_lost_and_one_added_do_not_cancel_out(spark):
    a, b = frame(spark, [("1", "a", 1, "x"), ("2", "b", 2, "y")]), frame(spark, [("1", "a", 1, "x"), ("3", "b", 2, "y")])
    assert a.count() == b.count()
    assert sorted(rows(audit.content_difference(a, b))) == [("2", "lost", 1, 0, None), ("3", "added", 0, 1, None)]


def test_altered_rows_name_their_columns(spark):
    source = [("1", "a", 1, None), ("2", "b", 2, "y"), ("3", None, 3, ""), ("4", "d", 4, "z"), (None, "n", 5, "x")]
    target = [("1", "a", 1, ""), ("2", "c", None, "y"), ("3", "", 3, ""), ("4", "d", 4, "z"), ("4", "e", 4, "z"), (None, "m", 5, "x")]
    found = audit.content_difference(frame(spark, source), frame(spark, target))
    assert sorted(rows(found), key=repr) == sorted(
        [
            ("1", "altered", 1, 1, "odd name"),
            ("2", "altered", 1, 1, "name, n"),
            ("3", "altered", 1, 1, "name"),
            ("4", "added", 0, 1, None),
            (None, "lost", 1, 0, None),
            (None, "added", 0, 1, None),
        ],
        key=repr,
    )


def test_equal_tables_in_another_order_and_empty_ones(spark):
    data = table(4)
    shuffled = random.Random(5).sample(data, len(data))
    columns = ["n", "odd name", "id", "name"]
    assert audit.content_difference(frame(spark, data), frame(spark, shuffled).select(*[f"`{c}`" for c in columns])).isEmpty()
    assert audit.content_difference(frame(spark, []), frame(spark, [])).isEmpty()
    lost = audit.content_difference(frame(spark, data), frame(spark, []))
    assert {r.kind for r in lost.collect()} == {"lost"}
    with pytest.raises(ValueError, match="columns differ"):
        audit.row_differences(frame(spark, data), frame(spark, data).drop("n"))


def test_one_altered_row_of_many_is_found_without_a_product(spark, tmp_path):
    spark.range(20_000).selectExpr("string(id) AS id", "md5(string(id)) AS name").write.parquet(str(tmp_path / "a"))
    source = spark.read.parquet(str(tmp_path / "a"))
    target = source.selectExpr("id", "CASE WHEN id = '77' THEN 'x' ELSE name END AS name")
    found = audit.row_differences(source, target)
    assert sorted(r.net for r in found.collect()) == [-1, 1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def _shuffled(spark, frame) -> int:
    """Bytes that the exchanges of a frame's run have written."""
    rows = frame.collect()
    plan, total = [frame._jdf.queryExecution().executedPlan()], 0
    seen = set()
    while plan:
        node = plan.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            plan.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            if node.id() in seen:
                continue
            seen.add(node.id())
            plan.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        plan += [children.apply(k) for k in range(children.size())]
    assert rows
    return total


def test_only_rows_that_differ_are_shuffled_whole(spark, tmp_path):
    # each range differs, as one row in twenty does; a row is 320 bytes that do not compress
    name = "concat_ws('', transform(sequence(1, 10), k -> md5(string(id * 10 + k))))"
    spark.range(40_000).selectExpr("string(id) AS id", f"{name} AS name").write.parquet(str(tmp_path / "a"))
    source = spark.read.parquet(str(tmp_path / "a"))
    target = source.selectExpr("id", "CASE WHEN id % 20 = 7 THEN 'x' ELSE name END AS name")
    found = audit.row_differences(source, target)
    assert sorted(r.net for r in found.collect()) == [-1] * 2_000 + [1] * 2_000
    whole = 2 * 40_000 * 160  # hexadecimal digits are half a byte
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if all sides were large
    try:
        assert _shuffled(spark, audit.row_differences(source, target)) < whole / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
