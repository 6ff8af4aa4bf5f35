"""Repeated passages by super-k-mer partitioning (operator 6).

A window is ``window`` consecutive words. Its minimiser is the least hash of the word grams
in it, so equal windows have equal minimisers. Consecutive windows of a document that share
a minimiser make one piece, packed as one string. Pieces travel to the bucket of their
minimiser, where the windows are cut out and sorted, and runs of equal windows show the
smallest document each starts in. A minimiser that occurs in one document only cannot hold a
repeated window, so its pieces stay at home. Whole repeated pieces are collapsed before they
travel. Minimisers with more than ``CROWD`` different pieces (a line with a third of all
documents around it) are not brought together: their windows are compared by 128-bit digest
in an ordinary aggregation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import as_row, stored, table

WINDOW = 50
#: Words of the grams that minimisers are taken from.
GRAM = 8
#: Different pieces of one minimiser that one task sorts at a time.
CROWD = 200
#: Pieces of crowded minimisers that a task takes at a time.
CHUNK = 1000
#: Word hashes a task remembers.
REMEMBERED = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def pieces(
    words: list[bytes], hashes: WordHashes, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each piece of a document."""
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    one = np.array([hashes[w] for w in words], np.uint64)
    last = len(words) - gram + 1
    grams = one[:last].copy()
    for j in range(1, gram):
        grams *= ODD
        grams += one[j : j + last]
    grams ^= grams >> np.uint64(31)
    grams *= ODD
    grams ^= grams >> np.uint64(29)
    span, reach, least = window - gram + 1, 1, grams
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[:n], least[span - reach : span - reach + n])
    first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    return first, np.diff(np.append(first, n)), least[first].view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def minimisers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The different minimisers of each document: ``doc_id, text_key, minimiser``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [
                np.unique(pieces(t.split(), hashes, window, gram)[2]) for t in _texts(batch, 2)
            ]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                    pa.array(np.concatenate([*found, np.zeros(0, np.int64)])),
                ],
                names=["doc_id", "text_key", "minimiser"],
            )

    return docs.mapInArrow(run, "doc_id bigint, text_key bigint, minimiser bigint")


def packed_pieces(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The pieces whose minimisers are named in ``shared``, packed.

    ``docs``: ``doc_id, text_key, text, shared``.
    """
    schema = (
        "doc_id bigint, text_key bigint, minimiser bigint, start int, n int, "
        "piece binary, packed binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(_texts(batch, 2)):
                words = text.split()
                wanted = batch.column(3)[i].values.to_numpy()
                firsts, counts, least = pieces(words, hashes, window, gram)
                hit = np.isin(least, wanted)
                for first, n, m in zip(
                    firsts[hit].tolist(), counts[hit].tolist(), least[hit].tolist(), strict=True
                ):
                    pack = b" ".join(words[first : first + n + window - 1])
                    row = (ids[i], keys[i], m, first, n, xxhash.xxh3_128_digest(pack), pack)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "text_key", "minimiser", "start", "n", "piece", "packed"],
            )

    return docs.mapInArrow(run, schema)


def _runs(flags: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of consecutive numbers as (first, count)."""
    for _, group in groupby(enumerate(flags), lambda x: x[1] - x[0]):
        part = [x[1] for x in group]
        yield part[0], len(part)


def _windows(packed: bytes, window: int) -> list[bytes]:
    words = packed.split(b" ")
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    return [packed[a:b] for a, b in zip(starts, ends[window - 1 :].tolist(), strict=False)]


def sorted_buckets(rows: DataFrame, window: int) -> DataFrame:
    """``piece, runs``: its windows that start in a smaller document than its own first.

    ``rows``: ``minimiser, piece, packed, first_doc``, at most ``CROWD`` of a minimiser.
    """

    def repeated(group: list[tuple]) -> Iterator[tuple[bytes, list[dict]]]:
        entries = sorted(
            (w, doc, k, at)
            for k, (_, _, packed, doc) in enumerate(group)
            for at, w in enumerate(_windows(packed, window))
        )
        flags: dict[int, list[int]] = {}
        for _, same in groupby(entries, lambda e: e[0]):
            same = list(same)
            for _, doc, k, at in same[1:]:
                if doc > same[0][1]:
                    flags.setdefault(k, []).append(at)
        for k, at in flags.items():
            yield group[k][1], [{"run": a, "n": n} for a, n in _runs(sorted(at))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[0][0] != row[0]:
                    out.extend(repeated(group))
                    group = []
                group.append(row)
            yield _run_batch(out)
            out = []
        if group:
            out.extend(repeated(group))
        yield _run_batch(out)

    return (
        rows.select("minimiser", "piece", "packed", "first_doc")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(run, "piece binary, runs array<struct<run:int,n:int>>")
    )


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    runs = pa.list_(pa.struct([("run", pa.int32()), ("n", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], runs)],
        names=["piece", "runs"],
    )


def _least(packs: list[bytes], docs: list[int], window: int) -> dict[bytes, int]:
    """The smallest document of each window, by the window's digest."""
    least: dict[bytes, int] = {}
    for packed, doc in zip(packs, docs, strict=True):
        for w in _windows(packed, window):
            digest = xxhash.xxh3_128_digest(w)
            if least.get(digest, doc) >= doc:
                least[digest] = doc
    return least


def crowded_buckets(rows: DataFrame, window: int) -> DataFrame:
    """The same for minimisers with many pieces, by digests of single windows.

    Pieces are dealt into chunks of about ``CHUNK``. A chunk sends each different window once,
    with its smallest document, to the part that settles the window's digest, and learns
    which of them start earlier elsewhere. So a window that all pieces share travels once a
    chunk, and chunks and parts stay of one size however large the crowd is.
    """
    parts = max(1, math.ceil(rows.count() / CHUNK))
    chunked = rows.select(
        "piece", "packed", "first_doc", F.expr(f"pmod(xxhash64(piece), {parts})").alias("chunk")
    )

    def send(chunk: pa.Table) -> pa.Table:
        packs, docs = chunk["packed"].to_pylist(), chunk["first_doc"].to_pylist()
        by_part: dict[int, list] = {}
        for digest, doc in _least(packs, docs, window).items():
            part = int.from_bytes(digest[:8], "big") % parts
            by_part.setdefault(part, []).append((digest, doc))
        return _letters([(p, chunk["chunk"][0].as_py(), x) for p, x in by_part.items()])

    def settle(letters: pa.Table) -> pa.Table:
        rows = list(zip(*(letters[c].to_pylist() for c in ("chunk", "digests", "docs")), strict=True))
        least: dict[bytes, int] = {}
        for _, digests, docs in rows:
            for digest, doc in zip(digests, docs, strict=True):
                if least.get(digest, doc) >= doc:
                    least[digest] = doc
        answers = []
        for chunk, digests, docs in rows:
            found = [
                (x, least[x]) for x, doc in zip(digests, docs, strict=True) if least[x] < doc
            ]
            answers.append((letters["part"][0].as_py(), chunk, found))
        return _letters(answers)

    def flag(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        packs, docs = chunk["packed"].to_pylist(), chunk["first_doc"].to_pylist()
        least = _least(packs, docs, window)
        for digests, found in zip(
            answers["digests"].to_pylist(), answers["docs"].to_pylist(), strict=True
        ):
            least.update(zip(digests, found, strict=True))
        out = []
        for piece, packed, doc in zip(chunk["piece"].to_pylist(), packs, docs, strict=True):
            at = [
                k
                for k, w in enumerate(_windows(packed, window))
                if least[xxhash.xxh3_128_digest(w)] < doc
            ]
            if at:
                out.append((piece, [{"run": a, "n": n} for a, n in _runs(at)]))
        return pa.Table.from_batches([_run_batch(out)])

    letter = "part bigint, chunk bigint, digests array<binary>, docs array<bigint>"
    sent = chunked.groupBy("chunk").applyInArrow(send, letter)
    settled = sent.groupBy("part").applyInArrow(settle, letter)
    return (
        chunked.groupBy("chunk")
        .cogroup(settled.groupBy("chunk"))
        .applyInArrow(flag, "piece binary, runs array<struct<run:int,n:int>>")
    )


def _letters(rows: list[tuple[int, int, list[tuple[bytes, int]]]]) -> pa.Table:
    return pa.table(
        {
            "part": pa.array([r[0] for r in rows], pa.int64()),
            "chunk": pa.array([r[1] for r in rows], pa.int64()),
            "digests": pa.array([[x[0] for x in r[2]] for r in rows], pa.list_(pa.binary())),
            "docs": pa.array([[x[1] for x in r[2]] for r in rows], pa.list_(pa.int64())),
        }
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Word spans ``[from, to)`` that also stand in a document with a smaller id.

    ``docs``: ``doc_id, text_key, text``. Returns ``doc_id, text_key, spans``.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram has at least one word and fits the window")
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    light = stored(minimisers(known, window, gram), "minimisers")
    shared = (
        light.groupBy("minimiser")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .where("lo < hi")
    )
    wanted = (
        light.join(shared.select("minimiser"), "minimiser", "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("minimiser").alias("shared"))
    )
    cut = known.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "shared")
    packed = stored(packed_pieces(cut, window, gram), "pieces")

    firsts = packed.groupBy("minimiser", "piece").agg(F.min("doc_id").alias("first_doc"))
    crowds = firsts.groupBy("minimiser").agg(F.count("*").alias("crowd")).where("crowd > 1")
    whole = packed.groupBy("minimiser", "piece", "packed").agg(F.min("doc_id").alias("first_doc"))
    together = stored(whole.join(crowds, "minimiser"), "buckets")
    runs = sorted_buckets(together.where(F.col("crowd") <= CROWD), window).union(
        crowded_buckets(together.where(F.col("crowd") > CROWD), window)
    )

    at = packed.select("doc_id", "text_key", "minimiser", "start", "n", "piece").join(
        firsts, ["minimiser", "piece"]
    )
    later = at.where("doc_id > first_doc").select(
        "doc_id", "text_key", "start", F.expr("array(struct(0 AS run, n))").alias("runs")
    )
    first = (
        at.where("doc_id = first_doc")
        .join(runs, "piece")
        .select("doc_id", "text_key", "start", "runs")
    )
    spans = F.expr(
        "transform(runs, r -> struct(start + r.run AS start, "
        f"start + r.run + r.n + {window - 1} AS stop))"
    )
    return (
        later.union(first)
        .groupBy("doc_id", "text_key")
        .agg(F.flatten(F.collect_list(spans)).alias("spans"))
    )


def kept_mask(n_words: int, spans: list[dict]) -> np.ndarray:
    turn = np.zeros(n_words + 1, np.int64)
    for span in spans:
        turn[span["start"]] += 1
        turn[span["stop"]] -= 1
    return np.cumsum(turn)[:-1] == 0


def strip_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per input row: ``doc_id, text_key, n_words, n_removed, kept, kept_sha256``.

    ``kept`` are the kept words joined by single spaces. Only ``doc_id`` and ``text`` are
    read. A NULL text has no words; a text with fewer words than a window stays whole. Rows
    of one ``doc_id`` never count against each other, so a row repeated whole stays. A NULL
    ``doc_id`` has no place in the order: such a row keeps all its words and takes none from
    others.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    spans = repeated_spans(docs, window, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(_texts(batch, 2), batch.column(3).to_pylist(), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if found:
                    mask = kept_mask(len(words), found)
                    words = [w for w, keep in zip(words, mask.tolist(), strict=True) if keep]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["doc_id", "text_key", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return (
        docs.join(spans, ["doc_id", "text_key"], "left")
        .select("doc_id", "text_key", "text", "spans")
        .mapInArrow(
            run,
            "doc_id bigint, text_key bigint, n_words bigint, n_removed bigint, "
            "kept string, kept_sha256 string",
        )
    )


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The input rows, all columns, without the words of repeated passages.

    A text that loses words keeps the others joined by single spaces, and ``n_chars``, if
    there is such a column, counts what is left. Texts that lose nothing stay as they are; a
    document that loses every word goes.
    """
    keyed = as_row(docs).withColumn("key", F.xxhash64("row.text"))
    light = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    spans = stored(repeated_spans(light, window, gram), "spans").toDF("_id", "_key", "_spans")

    @F.pandas_udf("string")
    def rest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            if found is None:
                out.append(None)
                continue
            words = text.encode().split()
            mask = kept_mask(len(words), found)
            out.append(b" ".join(w for w, keep in zip(words, mask.tolist(), strict=True) if keep).decode())
        return pd.Series(out, dtype=object)

    joined = keyed.join(
        spans, (F.col("row.doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left"
    )
    # texts that lose nothing do not go through Python
    touched = F.col("_spans").isNotNull()
    left = joined.withColumn("rest", rest(F.when(touched, F.col("row.text")), "_spans"))
    left = left.where("_spans IS NULL OR rest <> ''")
    row = F.col("row").withField("text", F.coalesce("rest", "row.text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        count = F.when(touched, F.length("rest").cast(kind)).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", count)
    return left.select(row.alias("row")).select("row.*")


def op6_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return strip_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The contract in SQL, by a digest of every window.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS digest
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts) AS starts),
firsts AS (SELECT digest, min(doc_id) AS first_doc FROM windows GROUP BY digest),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (digest) WHERE doc_id > first_doc),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS rest
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM texts) AS w
  ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
