"""Language identification of mixed text (operator 5).

Models are counts of hashed letter trigrams and of scripts by language, over all training
texts. The script of a word narrows its candidate languages; a Viterbi path over the words'
scores, with a penalty for each switch, labels spans. The text's language is the one whose
spans hold most letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import table

#: First code points of script ranges; letters outside any named one are 0.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"),
    (0x20000, "Han"), (0x30000, "Other"),
)
BUCKETS = 1 << 15
#: Share of a language's letters from which a script is one of its own.
OWN_SCRIPT = 0.01
#: What a switch of language costs, and a word in a foreign script, in logarithms.
SWITCH, FOREIGN = 8.0, -50.0
#: Numbers in a block of letter scores.
BLOCK = 1 << 24
#: Languages a task counts before it hands them on.
LANGUAGES = 200

STARTS = np.array([s[0] for s in SCRIPTS])
NAMES = sorted({s[1] for s in SCRIPTS})
CODES = np.array([NAMES.index(s[1]) for s in SCRIPTS])


@cache
def _letters() -> np.ndarray:
    """Per code point 2 for a letter, 1 for a mark that letters carry, else 0."""
    kinds = {"L": 2, "M": 1}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def read_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all letters the trigram's bucket; of all words the first letter, script and text.

    Words are runs of letters and marks with at least one letter. A NUL, which here parts the
    texts, is no letter and stands in a text for any other such character.
    """
    raw = "\0".join(["", *(t.lower().replace("\0", " ") for t in texts), ""])
    code = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.cumsum(code == 0) - 1  # the text each code point is in, counted from -1 + 1
    kind = _letters()[code]
    code = np.where(kind, code, 0).astype(np.uint64)
    at = np.flatnonzero(code)
    if len(at):
        first = np.flatnonzero(code[at - 1] == 0)
        bare = np.maximum.reduceat(kind[at], first) < 2
        code[at[np.repeat(bare, np.diff(np.append(first, len(at))))]] = 0
        at = np.flatnonzero(code)
    mixed = (
        code[at - 1] * np.uint64(0x9E3779B97F4A7C15)
        + code[at] * np.uint64(0xC2B2AE3D27D4EB4F)
        + code[at + 1] * np.uint64(0x165667B19E3779F9)
    )
    bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)
    first = np.flatnonzero(code[at - 1] == 0)
    script = CODES[np.searchsorted(STARTS, code[at[first]].astype(np.int64), "right") - 1]
    return bucket.astype(np.int64), first, script, of[at[first]]


def letter_counts(docs: DataFrame) -> DataFrame:
    """``lang, feature, n``: trigram buckets, and below zero scripts, of training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])],
                    names=["lang", "feature", "n"],
                )
            counts.clear()

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for text, lang in rows:
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                own = counts.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                for part in _parts(texts, BLOCK // 8):
                    bucket, first, script, _ = read_words(texts[part])
                    own[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                    size = np.diff(np.append(first, len(bucket)))
                    own[BUCKETS:] += np.bincount(script, size, len(NAMES)).astype(np.int64)
            if len(counts) > LANGUAGES:
                yield from out()
        yield from out()

    return (
        docs.where("text IS NOT NULL AND lang IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .select("text", "lang")
        .mapInArrow(run, "lang string, feature bigint, n bigint")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
    )


def _parts(texts: list[str], letters: int) -> Iterator[slice]:
    """Slices of the texts that hold about so many letters each."""
    first = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= letters:
            yield slice(first, k + 1)
            first, held = k + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


class Model:
    """Logarithms of trigram probabilities by language, and the scripts each language uses."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.langs = sorted({r[0] for r in rows})
        index = {name: i for i, name in enumerate(self.langs)}
        counts = np.zeros((BUCKETS + len(NAMES), len(self.langs)))
        for lang, feature, n in rows:
            counts[feature, index[lang]] = n
        grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
        self.log = np.log(grams / grams.sum(axis=0)).astype(np.float32)
        self.own = scripts >= OWN_SCRIPT * np.maximum(scripts.sum(axis=0), 1)

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each word in each language, its letters, and the text it is in."""
        bucket, first, script, of = read_words(texts)
        if not len(first):
            none = np.zeros(0, np.int64)
            return np.zeros((0, len(self.langs)), np.float32), none, none
        score = np.add.reduceat(self.log[bucket], first, axis=0)
        own = self.own[script]
        known = own.any(axis=1, keepdims=True)
        score = np.where(known, np.where(own, score, score + FOREIGN), 0)
        return score, np.diff(np.append(first, len(bucket))), of

    def path(self, scores: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Best language of each word; texts follow one another with ``n_words`` words each.

        One step takes the k-th word of all texts that have one, the longest texts first.
        """
        langs = np.arange(scores.shape[1])
        order = np.argsort(-n_words, kind="stable")
        start = (np.cumsum(n_words) - n_words)[order]
        longest = int(n_words.max(initial=0))
        alive = np.searchsorted(-n_words[order], -np.arange(longest), "left")
        came = np.zeros(scores.shape, np.int16)
        best = np.zeros((len(order), len(langs)), np.float32)
        for k in range(longest):
            at = start[: alive[k]] + k
            value = best[: alive[k]]
            top = value.argmax(axis=1)
            switched = (value[np.arange(len(top)), top] - SWITCH)[:, None]
            came[at] = np.where(value >= switched, langs, top[:, None])
            best[: alive[k]] = np.maximum(value, switched) + scores[at]
        found = np.zeros(len(scores), np.int64)
        now = best.argmax(axis=1)
        for k in range(longest - 1, -1, -1):
            at = start[: alive[k]] + k
            found[at] = now[: alive[k]]
            now[: alive[k]] = came[at, now[: alive[k]]]
        return found

    def label(self, texts: list[str]) -> Iterator[tuple[str, float, list[dict]]]:
        """Language, share of its letters, and spans of words ``[start, stop)`` of each text."""
        if not self.langs:
            yield from (("und", 0.0, []) for _ in texts)
            return
        for part in _parts(texts, max(1, BLOCK // len(self.langs))):
            yield from self._label(texts[part])

    def _label(self, texts: list[str]) -> Iterator[tuple[str, float, list[dict]]]:
        scores, size, of = self.word_scores(texts)
        n_words = np.bincount(of, minlength=len(texts))
        found = self.path(scores, n_words)
        held = np.bincount(
            of * len(self.langs) + found, size, len(texts) * len(self.langs)
        ).reshape(len(texts), -1)
        first = np.cumsum(n_words) - n_words
        turn = np.flatnonzero((np.diff(found) != 0) | (np.diff(of) != 0)) + 1
        for k in range(len(texts)):
            if not n_words[k]:
                yield "und", 0.0, []
                continue
            a, b = first[k], first[k] + n_words[k]
            cut = turn[np.searchsorted(turn, a, "right") : np.searchsorted(turn, b, "left")]
            edges = [int(a), *cut.tolist(), int(b)]
            spans = [
                {"start": x - int(a), "stop": y - int(a), "lang": self.langs[found[x]]}
                for x, y in zip(edges, edges[1:], strict=False)
            ]
            top = int(held[k].argmax())
            yield self.langs[top], float(held[k, top] / held[k].sum()), spans


def learn(docs: DataFrame) -> Model:
    """The model of the training rows; it has languages times ``BUCKETS`` numbers."""
    return Model([tuple(r) for r in letter_counts(docs).collect()])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, spans``.

    ``spans`` are runs of words, that is of letters, in one language. NULL texts and texts
    without a letter are ``und`` with score 0 and no span, and so is everything if nothing
    could be learned. Equal sums go to the first language by name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])
        )
        for batch in batches:
            found = list(model.label([t or "" for t in batch.column(2).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], kind),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(
        run,
        "doc_id bigint, held_out boolean, lang_pred string, score double, "
        "spans array<struct<start:int,stop:int,lang:string>>",
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select("doc_id", "held_out", "lang_pred", "score")
