"""Results of operators 5, 8 and 9 against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import language, mixing, quality
from starmart.llm.common import table
from tests.conftest import SF_DIR


def plain_viterbi(scores: np.ndarray) -> float:
    """The best sum over all paths, a switch of language costing its penalty."""
    best = np.zeros(scores.shape[1])
    for row in scores:
        best = np.array([max(best[k], (best - language.SWITCH).max()) + row[k] for k in range(len(row))])
    return float(best.max())


def path_value(scores: np.ndarray, path) -> float:
    steps = sum(scores[k, lang] for k, lang in enumerate(path))
    return float(steps - language.SWITCH * sum(a != b for a, b in zip(path, path[1:], strict=False)))


def test_language_paths_are_the_best_ones():
    rng = np.random.default_rng(6)
    model = language.Model([("de", 1, 3), ("en", 2, 4), ("fr", 3, 5), ("ru", 9, 1)])
    n_words = np.array([7, 0, 1, 30, 2, 0, 12])
    scores = rng.normal(0, 8, (int(n_words.sum()), 4)).astype(np.float32)
    path = model.path(scores, n_words)
    first = 0
    for n in n_words:
        own, found = scores[first : first + n].astype(float), path[first : first + n]
        if n:
            assert path_value(own, found) == pytest.approx(plain_viterbi(own), abs=1e-3)
        first += n


def test_language_of_a_text_is_that_of_most_letters():
    rows = [(lang, k, 50 + 7 * k * (i + 1) % 23) for i, lang in enumerate(("de", "en")) for k in range(0, language.BUCKETS, 97)]
    rows += [(lang, language.BUCKETS + language.NAMES.index("Latin"), 10_000) for lang in ("de", "en")]
    model = language.Model(rows)
    texts = ["der hund schläft im haus", "", "a b c d e", "x" * 500, "the quick brown fox über", "123"]
    for text, (lang, score, spans) in zip(texts, model.label(texts), strict=True):
        words = re.findall(r"[^\W\d_]+", text)
        if not words:
            assert (lang, score, spans) == ("und", 0.0, [])
            continue
        held = Counter()
        assert spans[0]["start"] == 0 and spans[-1]["stop"] == len(words)
        for span in spans:
            held[span["lang"]] += sum(len(w) for w in words[span["start"] : span["stop"]])
        assert held[lang] == max(held.values()) and score == pytest.approx(held[lang] / sum(held.values()))


def test_mix_sizes_targets_and_takes(spark):
    docs = table(spark, SF_DIR, "documents").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    of = {d.doc_id: d.source for d in docs}
    sizes = defaultdict(int)
    for i, source in of.items():
        sizes[source] += size[i]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, full = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / weights for s in order}
        over = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    have = {r.doc_id: r for r in mixing.op8_mixing(spark, SF_DIR).collect()}
    assert set(have) == set(size) and len(have) == len(docs)
    taken = defaultdict(int)
    for i, row in have.items():
        assert (row["size"], row["source_size"]) == (size[i], sizes[of[i]])
        assert row["target"] == pytest.approx(target[of[i]], rel=1e-9)
        assert 0 <= row["taken"] <= 2 * size[i]
        taken[of[i]] += row["taken"]
    assert all(taken[s] == pytest.approx(target[s], rel=0.1) for s in order)
    again = mixing.op8_mixing(spark, SF_DIR).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, have.values()))


def test_quality_keeps_the_top_by_gumbel_keys_of_the_ratio(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    good_ids = {r.doc_id for r in labels.where("quality = 1").collect()}
    marks = [r.quality for r in labels.where("quality IN (0, 1)").collect()]
    hashes = quality.Hashes()
    grams = {r.doc_id: quality.buckets(r.text, hashes) for r in docs.collect()}
    raw, good = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, found in grams.items():
        np.add.at(raw, found, 1)
        if i in good_ids:
            np.add.at(good, found, 1)
    p = (raw + 0.5) / (raw + 0.5).sum()
    log = np.log((good + quality.PRIOR * p) / (good.sum() + quality.PRIOR) / p)
    have = quality.resample(docs, labels).collect()
    assert {r.doc_id for r in have} == set(grams)
    assert all(r.log_weight == pytest.approx(float(log[grams[r.doc_id]].sum()), abs=1e-6) for r in have)
    k = round(sum(marks) / len(marks) * len(have))
    last = sorted((r.gumbel_key for r in have), reverse=True)[k - 1]
    assert all(r.kept == (r.gumbel_key >= last) for r in have) and sum(r.kept for r in have) >= k
