"""Quality by importance resampling (operator 9).

Two bag-of-hashed-n-grams models, one of the texts that labels call good and one of all
texts, give each document the logarithm of its importance weight. Adding Gumbel noise and
taking the largest k is sampling k documents without replacement by those weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import as_row, stored, table

BUCKETS = 1 << 14
#: N-grams of the whole corpus that the good texts' model starts from.
PRIOR = 10_000.0
REMEMBERED = 1 << 19
#: N-grams that are counted at once.
COUNTED = 1 << 20
#: Good labelled texts the target model is fitted on at most, in the order of a hash of the id.
MAX_GOOD = 50_000
BINS = 1024
#: Keys that are sorted on the driver to find the last of the top k.
FEW = 10_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class Kinds(dict):
    """Capitals to X, small letters to x, digits to 0, other characters to themselves."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        kind = "X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c
        self[code] = ord(kind)
        return self[code]


KINDS = Kinds()


@lru_cache(maxsize=1 << 14)
def run_hash(kinds: str) -> int:
    """Hash of the kinds without repeats; words are many, their kinds are few."""
    return xxhash.xxh64_intdigest("".join(c for c, _ in groupby(kinds)), 1)


def form_hash(word: str) -> int:
    """What a word looks like: runs of capitals, small letters, digits and other characters."""
    if word.isalpha() and word.islower():
        return run_hash("x")
    return run_hash(word.translate(KINDS))


class Hashes(dict):
    """Numbers of words; their hashes and those of their forms lie at that place of two arrays.

    All are forgotten when a bound is reached, between texts.
    """

    def __init__(self) -> None:
        super().__init__()
        self.word, self.shape = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.word):
            self.word, self.shape = np.tile(self.word, 2), np.tile(self.shape, 2)
        self.word[at] = xxhash.xxh64_intdigest(word.lower())
        self.shape[at] = form_hash(word)
        self[word] = at
        return at

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) >= REMEMBERED:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.word[at], self.shape[at]


def buckets(text: str | None, hashes: Hashes) -> np.ndarray:
    """Buckets of a text's words, word pairs, and triples of forms.

    A form also says whether its word repeats the one before.
    """
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64)
    word, shape = hashes.of(words)
    shape[1:] += (word[1:] == word[:-1]).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    edge = np.concatenate(([np.uint64(7)], shape, [np.uint64(7)]))
    grams = np.concatenate(
        (
            word,
            word[:-1] * ODD + word[1:] + np.uint64(1),
            (edge[:-2] * ODD + edge[1:-1]) * ODD + edge[2:] + np.uint64(2),
        )
    )
    grams = (grams ^ (grams >> np.uint64(31))) * ODD
    return (grams >> np.uint64(50)).astype(np.int64)


def gram_counts(docs: DataFrame, labels: DataFrame, max_good: int = MAX_GOOD) -> DataFrame:
    """``bucket, good, raw``: n-grams of the labelled good texts and of all texts."""
    good = (
        labels.where("quality = 1 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_good"))
        .distinct()
        .orderBy(F.xxhash64("_good"))
        .limit(max_good)
    )
    # at most ``max_good`` ids: a bound that holds at any size, so no text need move
    texts = docs.select("doc_id", "text")
    marked = texts.join(
        F.broadcast(stored(good, "good")), F.col("doc_id") == F.col("_good"), "left"
    ).select("text", F.col("_good").isNotNull().alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = Hashes(), np.zeros((2, BUCKETS), np.int64)
        waiting: tuple[list, list] = ([], [])
        size = 0

        def count() -> None:
            for row, found in zip(counts, waiting, strict=True):
                if found:
                    row += np.bincount(np.concatenate(found), minlength=BUCKETS)
                found.clear()

        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1), strict=True):
                found = buckets(text.as_py(), hashes)
                waiting[1].append(found)
                if good.as_py():
                    waiting[0].append(found)
                size += len(found)
                if size >= COUNTED:
                    count()
                    size = 0
        count()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(counts[0]), pa.array(counts[1])],
            names=["bucket", "good", "raw"],
        )

    return (
        marked.mapInArrow(run, "bucket bigint, good bigint, raw bigint")
        .groupBy("bucket")
        .agg(F.sum("good").alias("good"), F.sum("raw").alias("raw"))
    )


def log_weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Per bucket the logarithm of its probability in good texts over that in all texts."""
    good, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in gram_counts(docs, labels).collect():
        good[row["bucket"]], raw[row["bucket"]] = row["good"], row["raw"]
    if not good.sum():
        return np.zeros(BUCKETS)
    p = (raw + 0.5) / (raw + 0.5).sum()
    return np.log((good + PRIOR * p) / (good.sum() + PRIOR) / p)


def weigh(docs: DataFrame, labels: DataFrame, seed: int = 42) -> DataFrame:
    """One row per input row: ``doc_id, text_key, log_weight, gumbel_key``."""
    log = log_weights(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            weight = [float(log[buckets(t, hashes)].sum()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weight, pa.float64())],
                names=["doc_id", "text_key", "log_weight"],
            )

    uniform = F.expr(
        f"(shiftrightunsigned(xxhash64({seed}, doc_id, text_key), 11) + 0.5D) / 9007199254740992D"
    )
    return (
        docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text"), "text")
        .mapInArrow(run, "doc_id bigint, text_key bigint, log_weight double")
        .withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    )


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value: histograms narrow the range until few values are left."""
    values = keys.select(F.col(column).alias("x")).where("x IS NOT NULL")
    low, high = values.agg(F.min("x"), F.max("x")).first()
    while True:
        inside = values.where(F.col("x").between(low, high))
        width = (high - low) / BINS
        if width <= 0 or low + width == low:
            return high
        bins = (
            inside.groupBy(F.least(F.floor((F.col("x") - low) / width), F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()
        )
        for row in sorted(bins, key=lambda r: -r["bin"]):
            if k <= row["n"]:
                break
            k -= row["n"]
        low, high = row["low"], row["high"]
        if row["n"] <= FEW:
            left = values.where(F.col("x").between(low, high)).collect()
            return sorted((r["x"] for r in left), reverse=True)[k - 1]


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 42
) -> DataFrame:
    """One row per input row: ``doc_id, text_key, log_weight, gumbel_key, kept``.

    ``share`` of the documents are drawn; unset, it is the share of good ones among the
    labels (all, without labels). NULL and empty texts weigh 1, as a text of no evidence.
    Rows repeated whole have one key and are kept or rejected together, as are ties at the
    last place. Only ``doc_id`` and ``text``, and of the labels ``doc_id`` and ``quality``,
    are read.
    """
    keys = stored(weigh(docs, labels, seed), "weights")
    if share is None:
        share = labels.agg(F.avg(F.when(F.col("quality") == 1, 1.0).when(F.col("quality") == 0, 0.0))).first()[0]
        share = 1.0 if share is None else share
    k = round(share * keys.count())
    last = kth_largest(keys, "gumbel_key", k) if k else float("inf")
    return keys.withColumn("kept", F.col("gumbel_key") >= F.lit(last))


def keep_good(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The input rows, all columns, that the resampling keeps."""
    kept = (
        resample(docs, labels, share)
        .where("kept")
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .distinct()
    )
    keyed = as_row(docs).withColumn("key", F.xxhash64("row.text"))
    same = (F.col("key") == F.col("_key")) & F.col("row.doc_id").eqNullSafe(F.col("_id"))
    return keyed.join(kept, same, "left_semi").select("row.*")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return resample(docs, labels).drop("text_key")
