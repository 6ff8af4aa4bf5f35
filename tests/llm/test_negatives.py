"""Hard negatives against plain Python on odd rows, and Strassen products against plain ones."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from starmart.llm.negatives import Heap, hard_negatives, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (100, 65, 71), (64, 64, 64), (5, 200, 90), (40, 0, 40)])
def test_strassen(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    assert (strassen(a, b) == a @ b).all()
    a[:, :1], b[:1] = 2**40, 2**22  # sums inside wrap around, the result does not
    assert (strassen(a, b) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(4)
    owner, score, ids = rng.integers(0, 9, 500), rng.integers(-4, 4, 500), rng.integers(0, 50, 500)
    score[:3] = np.iinfo(np.int64).min, np.iinfo(np.int64).max, 0
    rows = np.arange(500)
    want = []
    for o in range(9):
        mine = sorted((-int(s), int(i), int(r)) for p, s, i, r in zip(owner, score, ids, rows, strict=True) if p == o)
        want += [(o, -s, i, r) for s, i, r in mine[:5]]
    heap = Heap(5)
    for part in np.array_split(rng.permutation(500), 7):
        heap.merge(owner[part], score[part], ids[part], rows[part])
    assert [tuple(map(int, e)) for e in zip(*heap.entries, strict=True)] == want


def brute(rows):
    ok = []
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= 2**54 for x in v):
            continue
        ok.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, (i, label, v) in enumerate(ok):
        if i % 100:
            continue
        scored = sorted((-dot(v, w), j, lab == label) for n, (j, lab, w) in enumerate(ok) if n != k)
        for p, pid, _ in [x for x in scored if x[2]][:5]:
            ps = -p
            hard = [(-s, j) for s, j, same in scored if not same and 80 * ps <= -100 * s <= 100 * ps]
            out += [(i, pid, r, j, ps, s) for r, (s, j) in enumerate(hard[:5], 1)]
    return sorted(out)


SCHEMA = "vec_id bigint, label int, embedding array<double>, row int, a int, c int, v string, anchor int"


def rows():
    rng = random.Random(9)
    base = [[rng.gauss(0, 0.3) for _ in range(20)] for _ in range(6)]
    near = lambda: [x + rng.gauss(0, 0.08) for x in rng.choice(base)]
    out = [(i, rng.randrange(10), near()) for i in range(900)]
    copy = near()
    out += [(1000 + i, i % 3, copy) for i in range(150)]  # a crowd of ties with different labels
    out += [(2000, None, near()), (2100, 1, None), (2200, 1, [1.0, None]), (2300, 2, [float("nan")] * 20)]
    out += [(2400, 2, [float("inf")] * 20), (None, 3, near()), (2500, 4, [0.0] * 20), (2600, 4, []), (2700, 5, near()[:9])]
    out += [(2800, 5, [1e40] * 20), (2900, 6, [-x for x in copy]), (-100, -3, near()), (-7, -10, near())]
    out += [out[100], out[100], (100, 8, near())]
    return [(*r, 1, 2, 3, "x", 4) for r in out]


@pytest.mark.parametrize("tile", [(1024, 8192), (2, 64)])
def test_hard_negatives(spark, tile):
    want = brute(rows())
    have = hard_negatives(spark.createDataFrame(rows(), SCHEMA), *tile)
    assert have.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in have.collect()) == want and len(want) > 200


def test_no_rows(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(100, 1, [1.0], 1, 2, 3, "x", 4)], SCHEMA)).count() == 0
