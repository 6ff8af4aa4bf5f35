"""The license scan against a plain alignment of every template with every whole text."""

from __future__ import annotations

import random

import pytest

from starmart.llm import licenses
from starmart.llm.licenses import TEMPLATES, WORD, scan
from tests.llm.test_operators import prose

TEXT = "doc_id bigint, text string"


def plain(template: list[str], words: list[str]) -> int:
    """Words met by the best alignment over the whole table: skips and changes cost 0.3."""
    above = [(0.0, 0)] * (len(words) + 1)
    for want in template:
        row = [(above[0][0] - 0.3, above[0][1])]
        for j, word in enumerate(words, 1):
            met = word == want
            across = (above[j - 1][0] + (1 if met else -0.3), above[j - 1][1] + met)
            skipped = (above[j][0] - 0.3, above[j][1])
            more = (row[-1][0] - 0.3, row[-1][1])
            row.append(max(across, skipped, more, key=lambda s: s[0]))
        above = row
    return max(above, key=lambda s: s[0])[1]


def damaged(text: str, seed: int, share: float) -> str:
    """Some words changed, some left out, some put in."""
    rng, out = random.Random(seed), []
    for word in text.split():
        fate = rng.random()
        if fate < share:
            out += rng.choice([["xyzzy"], [], [word, "plugh"]])
        else:
            out.append(word)
    return " ".join(out)


def test_finds_are_those_of_a_plain_alignment(spark):
    names = list(TEMPLATES)
    texts = {}
    for i, name in enumerate(names):
        body = damaged(TEMPLATES[name], i, 0.08 if i % 2 else 0.0)
        texts[i] = f"{prose(i, 15)} {body} {prose(100 + i, 10)}"
    frame = spark.createDataFrame(list(texts.items()), TEXT)
    found: dict[tuple, list] = {}
    for r in scan(frame).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        words = WORD.findall(text.lower())
        want = {}
        for name in names:
            template = WORD.findall(TEMPLATES[name].lower())
            n = plain(template, words)
            if n >= licenses.COVERAGE * len(template):
                want[name] = n
        have = found.get(i, [])
        assert bool(have) == bool(want), (i, names[i])
        for r in have:
            assert want[r["template"]] == r["matched_words"], (i, r)
        # what is not reported lies within something that covers more words
        most = max((r["end_word"] - r["start_word"] for r in have), default=0)
        assert all(n <= most for name, n in want.items() if name not in {r["template"] for r in have})


def test_nested_finds_belong_to_the_larger(spark):
    notice = TEMPLATES["Apache-2.0"]
    bsd = f"Copyright (c) 2001 Nobody. All rights reserved.\n{TEMPLATES['BSD-3-Clause']}"
    lines = f"{TEMPLATES['MIT-line']} {prose(1, 9)} {TEMPLATES['MIT-line']}\nAll rights reserved."
    frame = spark.createDataFrame([(1, notice), (2, bsd), (3, lines)], TEXT)
    found = sorted((r["doc_id"], r["start_word"], r["template"]) for r in scan(frame).collect())
    assert found == [
        (1, 0, "Apache-2.0"),
        (2, 4, "All-rights-reserved"),
        (2, 7, "BSD-3-Clause"),
        (3, 0, "MIT-line"),
        (3, 14, "MIT-line"),
        (3, 19, "All-rights-reserved"),
    ]


@pytest.mark.parametrize("most", [1, 60, 300])
def test_an_index_in_parts_finds_the_same(spark, most):
    texts = [(i % 7, f"{prose(i, 5)} {damaged(t, i, 0.05)}") for i, t in enumerate(TEMPLATES.values())]
    texts += [texts[0], texts[0], (None, texts[3][1]), (None, None), (9, ""), (9, " ")]
    frame = spark.createDataFrame(texts, TEXT)
    assert len(licenses.parts_of({n: WORD.findall(t.lower()) for n, t in TEMPLATES.items()}, most)) > 1
    whole, parts = scan(frame), scan(frame, max_index=most)
    assert whole.schema == parts.schema
    assert sorted(map(tuple, parts.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_odd_rows_long_texts_and_clashing_columns(spark):
    long = " ".join(["copies of the Software"] * 20_000)
    data = [
        (1, prose(1, 60_000) + " " + TEMPLATES["ISC"], 1, "a", 2),
        (2, long, 1, "a", 2),
        (3, "All rights reserved. " * 3, 1, "a", 2),
        (3, "All rights reserved. " * 3, 1, "a", 2),
    ]
    clash = "doc_id bigint, text string, text_key int, template string, start_word int"
    found = scan(spark.createDataFrame(data, clash))
    got = sorted((r["doc_id"], r["start_word"], r["template"]) for r in found.collect())
    ends = [(3, at, "All-rights-reserved") for at in (0, 0, 3, 3, 6, 6)]
    assert got == [(1, 60_000, "ISC"), *ends]
    assert scan(spark.createDataFrame(data, clash), {}).count() == 0
    assert scan(spark.createDataFrame(data, clash), {"short": "two words"}).count() == 0
    assert scan(spark.createDataFrame([], TEXT)).count() == 0
