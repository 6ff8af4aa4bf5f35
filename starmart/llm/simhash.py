"""SimHash near-duplicates through deletion-variant signatures (operator 7).

A 64-bit fingerprint is cut into two halves, fewer than the three that would leave one half
equal at two differing bits: of two halves one differs by at most one bit. Each half is
indexed once for each bit with that bit deleted, so that fingerprints within reach meet in
an equality join on a variant, where their distance is verified. Buckets of more than
``CROWD`` fingerprints are cut again by the other half, by the same rule, until none is
left, so no bucket compares all its pairs and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import as_row, components, stored, table

SEED = 42
#: Fingerprints of one bucket that are compared pair by pair; larger buckets are cut again.
CROWD = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 17


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for k in range(0, len(ends), BLOCK):
        part = zip(starts[k : k + BLOCK], ends[k : k + BLOCK], strict=False)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(ends)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Rows of ``(doc_id, text_key, fp)``, one for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), found], names=["doc_id", "text_key", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def _variants(rows: DataFrame, width: int) -> DataFrame:
    """The buckets of ``(fp, parent, start)``: ``width`` bits from ``start`` on are still free.

    The low six bits of a bucket's key say which half and which deleted bit it stands for.
    """
    half = width // 2
    variant = F.explode(F.array([F.lit(32 * h + i) for h in (0, 1) for i in range(half)]))
    cut = rows.select("*", variant.alias("variant")).select(
        "*",
        F.expr(f"start + shiftright(variant, 5) * {half}").alias("at"),
        F.expr(f"start + (1 - shiftright(variant, 5)) * {half}").alias("rest"),
    )
    kept = F.expr(
        f"shiftrightunsigned(fp, at) & {(1 << half) - 1}L & ~shiftleft(1L, variant & 31)"
    )
    key = F.xxhash64("parent", "variant", kept).bitwiseAND(F.lit(~63))
    return cut.select(
        "fp",
        F.col("rest").alias("start"),
        key.bitwiseOR(F.col("variant").cast("bigint")).alias("key"),
    )


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints ``fp`` at 1 to ``max_bits`` differing bits.

    Together the pairs hold every link, some of them more than once.
    """
    if not 1 <= max_bits <= 3:
        raise ValueError("two halves serve 1 to 3 differing bits")
    rows = prints.select("fp", F.lit(0).cast("bigint").alias("parent"), F.lit(0).alias("start"))
    found, width = [], 64
    while True:
        # a fingerprint is in a bucket once, so none has more than 1/64 of the rows to move
        buckets = _variants(rows, width).repartition("key")
        shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        members = stored(buckets.join(shared.hint("shuffle_hash"), "key"), "members")
        few = members.where(F.col("n") <= CROWD)
        left, right = few.alias("l"), few.alias("r")
        pair = left.join(
            right,
            (F.col("l.key") == F.col("r.key"))
            & (F.col("l.fp") < F.col("r.fp"))
            & (F.bit_count(F.expr("l.fp ^ r.fp")) <= max_bits),
        )
        found.append(pair.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
        rows = members.where(F.col("n") > CROWD).select("fp", F.col("key").alias("parent"), "start")
        width //= 2
        if width < 2 or rows.isEmpty():
            break
    if width < 2:  # every bit but the deleted ones is fixed: the rest is a handful
        left, right = rows.alias("l"), rows.alias("r")
        pair = left.join(
            right,
            (F.col("l.parent") == F.col("r.parent"))
            & (F.col("l.fp") < F.col("r.fp"))
            & (F.bit_count(F.expr("l.fp ^ r.fp")) <= max_bits),
        )
        found.append(pair.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def near_classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, text_key, fingerprint, component_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Texts that are NULL,
    empty or blank have the fingerprint zero, which links like any other. Rows of one
    ``doc_id`` and rows repeated whole each keep their own result row. A NULL ``doc_id`` is
    never a component's name unless the component holds no other. No rows, no result.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(links(nodes, max_bits))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of = member.join(named, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(
        "doc_id",
        "text_key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each class, with all columns: that of the smallest ``doc_id``.

    NULL ids come last; among texts of one id the text's hash decides; rows repeated whole
    leave one.
    """
    classes = stored(near_classes(docs, shingle, max_bits), "classes")
    # a component without any id is named by its fingerprint
    by = ["component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    return first_rows(docs, classes, by)


def first_rows(docs: DataFrame, classes: DataFrame, by: list[Column | str]) -> DataFrame:
    """The rows of ``docs`` that come first in each class of ``doc_id, text_key`` rows."""
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    chosen = classes.groupBy(*by).agg(F.min(order).alias("o")).select("o.doc_id", "o.text_key")
    copies = classes.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    same = lambda x, y: x["doc_id"].eqNullSafe(y["doc_id"]) & (x["text_key"] == y["text_key"])
    chosen = chosen.join(copies, same(chosen, copies)).select(
        chosen["doc_id"].alias("_id"), chosen["text_key"].alias("_key"), "n"
    )
    joined = as_row(docs).withColumn("key", F.xxhash64("row.text")).join(
        chosen, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    )
    once = joined.where("n = 1").select("row.*")
    again = joined.where("n > 1").dropDuplicates(["_id", "_key"]).select("row.*")
    return once.union(again)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_classes(docs).select("doc_id", "fingerprint", "component_id")
