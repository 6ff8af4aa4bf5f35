"""Repaired conversations against plain recursion, whole and cut into small blocks."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import numpy as np
import pytest
import xxhash

from starmart.llm import structure

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, slab int, c string, cost int, row int"
SPACES = " \t\n\x0b\f\r"


def signed_hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (value >> 63 << 64)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), signed_hash(r[2])))


def damage(i, turn, role, text):
    name = lambda x: " " if x is None else str(x)
    h = zlib.crc32(f"{name(i)}:{name(turn)}".encode()) % 20
    role, text = name(role), name(text)
    if h == 1:
        text = ""
    if h == 2:
        text = "".join(x for x in text if x not in ".!?")
    row = (turn, "user" if h == 4 else role, text)
    return [row] * (0 if h == 0 else 2 if h == 3 else 1)


def report(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    kinds = [role[:1] for _, role, _ in rows]
    turns = {t for t, *_ in rows if t is not None}
    illegal = sum(a + b not in ("su", "ua", "au") or len(a + b) < 2 for a, b in zip(kinds, kinds[1:], strict=False))
    n = len(rows)

    @cache
    def best(i, done, inserted):
        """Cheapest edits from row i on, given the role initials so far as a state."""
        found = []
        if i == n and done in ("", "ua"):
            found.append((0, "", ()))
        wanted = {"": "user", "s": "user", "u": "assistant", "ua": "user"}[done]
        after = {"user": "u", "assistant": "ua"}[wanted]
        if inserted < 3:
            c, a, r = best(i, after, inserted + 1)
            found.append((c + 2, "I" + a, (wanted + ":", *r)))
        if i < n:
            _, role, text = rows[i]
            c, a, r = best(i + 1, done, 0)
            found.append((c + 3, "D" + a, r))
            if faults[i] in ("", "t"):
                extra = faults[i] == "t"
                c, a, r = best(i + 1, after, 0)
                found.append((c + 2 + extra, "R" + a, (f"{wanted}:{text}", *r)))
                if role[:1] == wanted[0] or (role[:1] == "s" and done == ""):
                    c, a, r = best(i + 1, "s" if role[:1] == "s" else after, 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *r)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    hashed = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in "bdt"), illegal, cost, audit, hashed)


def conversations():
    rng = random.Random(11)
    texts = ["So it is.", "Is it?", "no end", "  ", "", "Yes!\n ", " ", "a.b", "end. \x0b", "Ünd."]
    roles = ["user", "assistant", "system", "tool", "", "User", "another", None]
    weights = [9, 9, 3, 1, 1, 1, 1, 1]
    rows = []
    for conv in range(150):
        turns = sorted(rng.choice([None, *range(-2, 14)]) or 99 for _ in range(rng.randrange(1, 14)))
        for k, t in enumerate(turns):
            text = None if rng.random() < 0.03 else f"{k} {rng.choice(texts)}" if rng.random() < 0.7 else rng.choice(texts)
            rows.append((conv, None if t == 99 else t, rng.choices(roles, weights)[0], text))
    rows += [(500, k, ("user", "assistant")[k % 2], f"{k // 7} {rng.choice(texts)}") for k in range(90)]
    rows += [(None, k % 5, "user", f"n{k}.") for k in range(9)] + [(600, 1, "user", "x" * 40_000)] * 2
    rows += [(700 + k, 1, "user", "Alone.") for k in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1 << 11, 4, 1])
def test_repair_equals_plain_recursion(spark, monkeypatch, block):
    monkeypatch.setattr(structure, "BLOCK", block)
    rows = conversations()
    frame = spark.createDataFrame([(*r, 1, 2, "c", 3, 4) for r in rows], SCHEMA)
    want = []
    for conv in {r[0] for r in rows}:
        want.append((conv, *report(order([x for r in rows if r[0] == conv for x in damage(*r)]))))
    have = structure.repair_damaged(frame)
    assert have.columns == ["conv_id", *structure.REPORT]
    have = sorted((tuple(r) for r in have.collect()), key=repr)
    assert any("R" in r[7] for r in have) and any("I" in r[7] for r in have) and any(r[7] == "" for r in have)
    assert have == sorted(want, key=repr)


def test_ranks_choose_the_least_of_equally_cheap_paths():
    costs, exits, audits = structure.least_paths(["484"], np.array([structure.ACCEPT]))
    assert (costs[0, 0], audits[0][0], exits[0, 0]) == (2, "KKK", 2)
    costs, exits, audits = structure.least_paths(["4", "44444444", ""], np.array([structure.ACCEPT] * 3))
    assert [a[0] for a in audits] == ["K", "KRKRKRKR", ""]
    assert costs[:, 0].tolist() == [2, 8, 0] and exits[:, 0].tolist() == [2, 3, 0]


def test_no_rows(spark):
    assert structure.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
