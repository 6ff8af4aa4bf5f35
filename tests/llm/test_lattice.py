"""Lattice scores against a sum over all segmentations, and the base score in plain Python."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import lattice
from starmart.llm.lattice import Pieces, load_pieces, score_texts

SOME = {b" a": 3.0, b"ab": 2.0, b"b": 1.0, b" ab": 1.5, b"bab": 0.5, b"a": 1.0, b" ": 0.7}


def brute(pieces: Pieces, word: bytes) -> float:
    """Log of the sum over every way to cut the word."""
    text, total = b" " + word, 0.0
    for cuts in itertools.product((False, True), repeat=len(text) - 1):
        parts, begin = [], 0
        for k, cut in enumerate([*cuts, True]):
            if cut:
                parts.append(text[begin : k + 1])
                begin = k + 1
        if all(p in pieces.place for p in parts):
            total += math.exp(sum(pieces.log[pieces.place[p]] for p in parts))
    return math.log(total) + pieces.log[-1]


def test_spelling_sums_all_segmentations():
    pieces = Pieces(SOME)
    words = [b"", b"a", b"abab", b"babab", b"\x00ab", "é".encode(), b"abbabaabab"]
    assert np.allclose(pieces.spell(words), [brute(pieces, w) for w in words])
    long = b"ab" * 3000
    assert len(long) > lattice.LONG
    some = long[:600]
    assert math.isclose(pieces._spell_long(some), pieces.spell([some])[0] - pieces.log[-1])
    assert np.isfinite(pieces.spell([long])).all()


def test_expected_uses_are_the_slope_of_the_spelling():
    pieces = Pieces(SOME)
    words = [b"abab", b"bab", b"aabb"]
    found = pieces.expected(words)
    for k in [*pieces.place.values(), len(pieces.log) - 1]:
        step = 1e-6
        pieces.log[k] += step
        up = pieces.spell(words).sum()
        pieces.log[k] -= 2 * step
        down = pieces.spell(words).sum()
        pieces.log[k] += step
        assert math.isclose((up - down) / (2 * step), found[k], abs_tol=1e-5)


def test_learning_raises_the_likelihood():
    pieces, words = load_pieces(), [w.encode() for w in ("thean", "inther", "anther", "thein")]
    before = pieces.spell(words).sum()
    for _ in range(3):
        pieces = pieces.learned(pieces.expected(words), 1.0)
        after = pieces.spell(words).sum()
        assert after > before
        before = after


SCHEMA = "doc_id bigint, text string, key int, row int, n int, score int, rare int, base int"


def rows() -> list[tuple]:
    rng = random.Random(5)
    common = [a + b for a in ("the", "An", "or") for b in ("in", "st", "")]
    texts = [" ".join(rng.choice(common) + rng.choice(["", "", ",", "er"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["", None, " \t\n", "x" * 5000 + " end", "n\x00ul É é", "the " * 9000, texts[3]]
    out = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "the or"), (None, None)]
    return [(*r, 1, 2, 3, 4, 5, 6) for r in out]


@pytest.mark.parametrize("common", [0, 7, 200_000])
def test_scores(spark, common):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    data = [(i, [*(t or "").encode().lower().split(), b""]) for i, t, *_ in rows()]
    c = Counter(w for i, ws in data if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice)))
    pieces = load_pieces()
    for _ in range(lattice.ROUNDS):
        pieces = pieces.learned(pieces.expected([w for w in c if w]))

    def score(w: bytes) -> tuple[float, float]:
        arc = max(c[w] - d, 0) / n
        if not w:
            return math.log10(arc), 0.0
        spelled = pieces.spell([w])[0]
        rest = math.log(d * v / n) + spelled
        arc = math.log(arc) if arc else -math.inf
        return np.logaddexp(arc, rest) / math.log(10), spelled / math.log(10)

    known = {w: score(w) for _, ws in data for w in ws}
    want = sorted(
        (
            (i, held(i), len(ws), sum(w in c for w in ws), n)
            + (sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws),)
            + tuple(sum(known[w][k] for w in ws) for k in (0, 1))
            for i, ws in data
        ),
        key=repr,
    )
    have = score_texts(spark.createDataFrame(rows(), SCHEMA), common=common)
    assert have.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    have = sorted((tuple(r) for r in have.collect()), key=repr)
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in have], [r[5:] for r in want], rtol=1e-9)


def test_probabilities_sum_to_one_over_the_words():
    """Words of up to three bytes of a tiny alphabet hold nearly all of a short model's mass."""
    pieces = Pieces(SOME)
    pieces.log[:] = -50.0
    for p, q in ((b" a", 0.3), (b" ", 0.1), (b"b", 0.1)):
        pieces.log[pieces.place[p]] = math.log(q)
    pieces.log[-1] = math.log(0.5)
    words = [bytes(w) for n in range(0, 12) for w in itertools.product(b"ab", repeat=n) if w.count(97) < 2]
    assert math.isclose(sum(np.exp(pieces.spell(words))), 0.4 * 0.5 / 0.9, rel_tol=1e-6)


def test_no_rows_and_no_training_rows(spark):
    frame = lambda some: score_texts(spark.createDataFrame(some, SCHEMA))
    assert frame([]).count() == 0
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = frame([(only, "the or", 1, 2, 3, 4, 5, 6)]).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in row] == [(True, 3, 0, 0, 0.0)]
    assert row[0].score < 0
