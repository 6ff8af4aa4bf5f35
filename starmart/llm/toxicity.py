"""Toxicity classifier with a counterfactual penalty (operator 1).

A logistic model over the words of a text. Words that tell toxic from clean labelled texts
apart become features. In each labelled sentence that names a group, the identity term is
swapped for the others of its group; the squared change of the score is a penalty of the
fit, so that a term gains no weight that its counterparts lack, seen in training or not.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import stored, table

#: Identity terms that may stand for one another, by group.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("woman", "man", "girl", "boy", "female", "male", "transgender"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
    ("immigrant", "refugee", "foreigner", "native", "citizen"),
    ("disabled", "blind", "deaf", "autistic", "healthy"),
    ("christ", "muslim", "jude", "hindu", "buddhist", "atheist"),
    ("frau", "mann", "junge", "schwuler", "lesbe", "ausländer", "flüchtling"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("femme", "homme", "fille", "garçon", "immigré", "réfugié", "étranger"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
    ("mujer", "hombre", "chica", "chico", "inmigrante", "refugiado", "extranjero"),
)
#: Labelled rows the model is fitted on at most, taken in the order of a hash of the id.
MAX_LABELLED = 50_000
#: Words that become features at most, the most telling ones, and how telling they must be.
MAX_FEATURES = 20_000
LEAST_CHI2 = 16.0
LEAST_TEXTS = 3
#: Words a task counts before it hands them on.
COUNTED = 500_000
RIDGE, FAIRNESS, STEPS = 1e-3, 1.0, 400

TOKEN = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
SWAPS = {
    term: sorted({t for g in IDENTITY_TERMS if term in g for t in g} - {term})
    for group in IDENTITY_TERMS
    for term in group
}


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a NULL id has no remainder and no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``id, toxic`` of at most ``limit`` labelled training documents with different texts."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")
    )
    light = docs.where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")
    )
    return (
        light.join(marks, "id")
        .groupBy("key")
        .agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(limit)
        .select("id", "toxic")
    )


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def word_counts(train: DataFrame) -> DataFrame:
    """``word, toxic, clean``: training texts of each label that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            known = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array([c[w] for w in known], pa.int64()) for c in counts]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(known, pa.string()), columns[1], columns[0]],
                names=["word", "toxic", "clean"],
            )

        for batch in batches:
            for text, toxic in zip(_texts(batch, 0), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(set(TOKEN.findall(text.lower())))
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield out()
        yield out()

    return (
        train.select("text", "toxic")
        .mapInArrow(run, "word string, toxic bigint, clean bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def telling_words(counts: DataFrame, toxic: int, clean: int) -> list[str]:
    """Words whose presence depends on the label by a chi-square test, bounded."""
    n, t, c = float(toxic + clean), F.col("toxic"), F.col("clean")
    off = t * (clean - c) - c * (toxic - t)
    below = (t + c) * (n - t - c) * float(max(toxic, 1)) * float(max(clean, 1))
    chi2 = F.when(below > 0, n * off * off / below)
    rows = (
        counts.where(t + c >= LEAST_TEXTS)
        .select("word", chi2.alias("chi2"))
        .where(F.col("chi2") >= LEAST_CHI2)
        .orderBy(F.col("chi2").desc(), "word")
        .limit(MAX_FEATURES)
        .collect()
    )
    return [r["word"] for r in rows]


def swapped_terms(text: str) -> Counter:
    """How often a sentence of the text has term a where its counterfactual has term b."""
    pairs: Counter = Counter()
    for sentence in SENTENCE.split(text.lower()):
        for term in set(TOKEN.findall(sentence)) & SWAPS.keys():
            pairs.update((term, other) for other in SWAPS[term])
    return pairs


def training_rows(train: DataFrame, words: list[str]) -> tuple[list, dict]:
    """Features and labels of the sample, with multiplicity, and counts of swapped pairs."""
    index = {w: i for i, w in enumerate(words)}
    schema = "toxic int, ids array<int>, a string, b string, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, pairs = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(_texts(batch, 0), batch.column(1).to_pylist(), strict=True):
                found = index.keys() & set(TOKEN.findall(text.lower()))
                seen[toxic, tuple(sorted(index[w] for w in found))] += 1
                pairs.update(swapped_terms(text))
        rows = [(y, list(ids), None, None, n) for (y, ids), n in seen.items()]
        rows += [(None, None, a, b, n) for (a, b), n in pairs.items()]
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["toxic", "ids", "a", "b", "n"],
        )

    rows = (
        train.select("text", "toxic")
        .mapInArrow(run, schema)
        .groupBy("toxic", "ids", "a", "b")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    pairs = {(r["a"], r["b"]): r["n"] for r in rows if r["ids"] is None}
    return [(r["toxic"], r["ids"], r["n"]) for r in rows if r["ids"] is not None], pairs


def fit(rows: list, pairs: dict, words: list[str], fairness: float = FAIRNESS) -> dict[str, float]:
    """Weights by word and the intercept under ``""``, by accelerated gradient descent.

    Minimises the mean log loss + ``RIDGE`` |w|^2 + ``fairness`` times the mean squared change
    of the score over all counterfactual pairs.
    """
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    if not rows:
        return {"": -math.log(99.0)}
    index = {w: i for i, w in enumerate(words)}
    y = np.array([r[0] for r in rows], float)
    n = np.array([r[2] for r in rows], float)
    size = [len(r[1]) for r in rows]
    at = np.repeat(np.arange(len(rows)), size)
    ids = np.array([i for r in rows for i in r[1]], np.int64)
    swaps = sorted((index[a], index[b], m) for (a, b), m in pairs.items())
    a, b, m = (np.array([s[i] for s in swaps], np.int64) for i in range(3))
    share = m / max(m.sum(), 1)
    # clean and toxic texts count as if they were equally many, the intercept is set after
    weight = n / np.where(y == 1, max(n[y == 1].sum(), 1), max(n[y == 0].sum(), 1)) / 2
    w, bias = np.zeros(len(words)), 0.0
    look, look_bias = w, bias
    curve = np.bincount(ids, weight[at] * np.array(size, float)[at], len(words)).max(initial=1.0)
    rate = 1.0 / (0.25 * (curve + 1.0) + 2 * RIDGE + 8 * fairness)
    for step in range(STEPS):
        z = np.bincount(at, look[ids], len(rows)) + look_bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        slope = np.bincount(ids, error[at], len(words)) + 2 * RIDGE * look
        change = 2 * fairness * share * (look[a] - look[b])
        slope += np.bincount(a, change, len(words)) - np.bincount(b, change, len(words))
        new, new_bias = look - rate * slope, look_bias - rate * error.sum()
        pull = step / (step + 3)
        look, look_bias = new + pull * (new - w), new_bias + pull * (new_bias - bias)
        w, bias = new, new_bias
    return {"": float(bias), **{x: float(v) for x, v in zip(words, w, strict=True) if v}}


def train_weights(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> dict[str, float]:
    sample = stored(labelled_sample(docs, labels, max_labelled), "labelled")
    # at most ``max_labelled`` rows of two numbers: the one side here with a proven bound
    texts = docs.select("doc_id", "text")
    train = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("text", "toxic")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {"": math.log(99.0) if n.get(1) else -math.log(99.0)}
    words = telling_words(word_counts(train), n[1], n[0])
    words += sorted(SWAPS.keys() - set(words))
    rows, pairs = training_rows(train, words)
    return fit(rows, pairs, words)


def score_texts(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``, from the text alone."""
    bias = weights.get("", 0.0)
    known = {w: v for w, v in weights.items() if w}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in _texts(batch, 2):
                found = known.keys() & set(TOKEN.findall(text.lower()))
                z = bias + sum(known[w] for w in sorted(found))
                scores.append(1 / (1 + math.exp(-max(-35.0, min(35.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels of documents that are not held out, then score all.

    NULL and empty texts get the score of a text without telling words. A document with
    several labels is toxic if one says so; labels other than 0 and 1 do not count. With
    labels of one kind only, or none, every text gets the same score. Other columns than
    ``doc_id`` and ``text`` are not read.
    """
    return score_texts(docs, train_weights(docs, labels))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
