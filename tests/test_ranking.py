"""Places in an order, and terms against values, compared with plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starmart.functions.text import fold_text
from starmart.operators.ranking import numbered
from starmart.plans import vocabulary


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_places(spark, n):
    rng = random.Random(n)
    # a third of the rows share one key, some keys are missing, some rows are repeated
    keys = [None if rng.random() < 0.1 else 7 if rng.random() < 0.33 else rng.randrange(40) for _ in range(n)]
    rows = [(k, f"t{rng.randrange(300)}") for k in keys]
    frame = spark.createDataFrame(rows, "id int, `a b` string").repartition(6)
    found = numbered(frame, [F.desc("id")])
    assert found.columns == ["id", "a b", "place"]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r)[:2] for r in found.orderBy("place").collect()] == want
    assert sorted(r["place"] for r in found.collect()) == list(range(1, n + 1))


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_terms(spark, distance):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abñÁ ") for _ in range(rng.randrange(7)))
    values = [("d", word()) for _ in range(80)] + [("e", "Zona Sur"), ("d", "zona sur"), ("e", None)]
    terms = [word() for _ in range(40)] + ["zona sur", "zna sur", None, "ona sr", "Zona  Sur"]
    found = vocabulary.match_terms(
        spark.createDataFrame(values, "dimension string, value string"),
        spark.createDataFrame([(t,) for t in terms], "term string"),
        distance,
    )
    trim = lambda t: fold_text(t.strip(" "))
    want = {
        (t, d, v, levenshtein(trim(t), trim(v)))
        for t in terms if t is not None for d, v in values if v is not None
    }
    want = {w for w in want if w[3] <= distance}
    assert {tuple(r) for r in found.collect()} == want
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
