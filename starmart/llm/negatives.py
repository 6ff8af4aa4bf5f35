"""Hard negatives by Strassen products of integer tiles (operator 13).

Anchors and candidates are dealt into blocks; a tile is one block of each. Its scores are one
matrix product in int64 by Strassen's recursion: halves of both factors, padded with zeros to
even sizes, seven products of sums instead of eight. Integers wrap around in the sums and wrap
back, so a score is exact whenever it fits 64 bits.

A tile keeps, per anchor, a heap of the best positives; heaps of tiles merge into the heap of
all candidates. The positives found open a window of scores each, and a second pass over the
tiles fills and merges a heap of the best negatives per window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import stored, table

POSITIVES, NEGATIVES = 5, 5
#: Every so many-th id is an anchor.
EVERY = 100
#: Factor of the components before they are cut to integers.
SCALE = 256
#: A negative's least share of its positive's score, in fifths.
LEAST = 4
#: Anchors and candidates of a tile, and candidates multiplied at once.
ANCHORS, CANDIDATES, SLICE = 1_024, 8_192, 2_048
#: Sides down to which halving goes on.
LEAF = 16


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    x, y, z = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * x, 2 * z), np.int64)
    out[:x, :z] = p1 + p4 - p5 + p7
    out[:x, z:] = p3 + p5
    out[x:, :z] = p2 + p4
    out[x:, z:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heap:
    """The best ``size`` entries per owner: highest score, then smallest id, then row."""

    FIELDS = ("owner", "score", "id", "row")

    def __init__(self, size: int) -> None:
        self.size = size
        self.entries = tuple(np.zeros(0, np.int64) for _ in self.FIELDS)

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        every = [np.concatenate(x) for x in zip(self.entries, (owner, score, ids, rows), strict=True)]
        # ~score falls as score rises, and unlike -score it never overflows
        order = np.lexsort((every[3], every[2], ~every[1], every[0]))
        owners = every[0][order]
        place = np.arange(len(order)) - np.searchsorted(owners, owners)
        best = order[place < self.size]
        self.entries = tuple(x[best] for x in every)


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to one width."""
    column = vectors.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns), default=0)


def _tile(anchors: pa.Table, candidates: pa.Table):
    """Scores of a tile, slice by slice, with the slice's ids, rows and labels."""
    width = _width(anchors["v"], candidates["v"])
    left = _matrix(anchors["v"], width)
    for k in range(0, len(candidates), SLICE):
        part = candidates.slice(k, SLICE)
        scores = strassen(left, np.ascontiguousarray(_matrix(part["v"], width).T))
        yield scores, *(part[c].to_numpy() for c in ("vec_id", "row", "label"))


POSITIVE = "anchor bigint, score bigint, id bigint, row bigint"


def _positives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    heap = Heap(POSITIVES)
    if len(anchors) and len(candidates):
        own, label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        for scores, ids, rows, labels in _tile(anchors, candidates):
            may = (label[:, None] == labels[None]) & (own[:, None] != rows[None])
            if len(ids) > POSITIVES:
                # nothing below the last place of this slice can enter the heap
                ranked = np.where(may, scores, np.iinfo(np.int64).min)
                last = np.partition(ranked, -POSITIVES, axis=1)[:, -POSITIVES]
                may &= scores >= last[:, None]
            i, j = np.nonzero(may)
            heap.merge(own[i], scores[i, j], ids[j], rows[j])
    return pa.table(dict(zip(("anchor", "score", "id", "row"), heap.entries, strict=True)))


NEGATIVE = "anchor bigint, place int, score bigint, id bigint, row bigint"


def _negatives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    heaps = [Heap(NEGATIVES) for _ in range(POSITIVES)]
    if len(anchors) and len(candidates):
        own, label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        tops = anchors["tops"].to_pylist()
        # an empty window has its least score above its greatest
        low = np.ones((len(own), POSITIVES), np.int64)
        high = np.zeros((len(own), POSITIVES), np.int64)
        for i, some in enumerate(tops):
            for k, top in enumerate(some):
                if top >= 0:
                    low[i, k], high[i, k] = -(-LEAST * top // 5), top
        for scores, ids, rows, labels in _tile(anchors, candidates):
            reach = (scores >= low.min(1)[:, None]) & (scores <= high.max(1)[:, None])
            i, j = np.nonzero(reach & (label[:, None] != labels[None]))
            found = scores[i, j]
            for k, heap in enumerate(heaps):
                inside = (found >= low[i, k]) & (found <= high[i, k])
                heap.merge(own[i[inside]], found[inside], ids[j[inside]], rows[j[inside]])
    parts = [
        pa.table(
            {
                "anchor": heap.entries[0],
                "place": np.full(len(heap.entries[0]), k + 1, np.int32),
                **dict(zip(("score", "id", "row"), heap.entries[1:], strict=True)),
            }
        )
        for k, heap in enumerate(heaps)
    ]
    return pa.concat_tables(parts)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, v`` of the rows that take part, see ``hard_negatives``."""
    numbers = F.col("embedding").cast("array<double>")
    bound = F.lit(float(2**62 // SCALE))
    fits = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
    label = F.col("label").cast("decimal(20,0)")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fits).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        moved.cast("bigint").alias("label"),
        F.transform(numbers, lambda x: F.floor(x * SCALE).cast("bigint")).alias("v"),
    )


def _tiles(anchors: DataFrame, candidates: DataFrame, function, schema: str, blocks: tuple[int, int]) -> DataFrame:
    """Apply a function to each block of anchors with each block of candidates."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = anchors.select("*", dealt(blocks[0]).alias("a"), every(blocks[1]).alias("c"))
    right = candidates.select("*", every(blocks[0]).alias("a"), dealt(blocks[1]).alias("c"))
    # both sides come from one table: new names for one keep their columns apart
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(function, schema)


def _first(found: DataFrame, keys: list[str], size: int, place: str) -> DataFrame:
    """Merge the heaps of all tiles."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return found.withColumn(place, F.row_number().over(order)).where(F.col(place) <= size)


def hard_negatives(
    vectors: DataFrame, anchors_in_tile: int = ANCHORS, candidates_in_tile: int = CANDIDATES
) -> DataFrame:
    """One row per anchor, positive and negative: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    Reads ``vec_id, embedding, label``. Rows with a NULL label or vector, or a NULL or
    non-finite component, take no part; nor do rows with a NULL id, which could not be named,
    and rows with a component of 2^54 or more, whose scores no BIGINT holds. Shorter vectors
    are compared as if zeros followed; empty ones score 0. Repeated rows and rows of one id
    are rows of their own: each can be anchor, positive and negative. Equal scores go by
    the smaller id. An anchor without positives, a positive with a negative score, or one
    without negatives in its window, has no row; no rows, no result.

    All candidates meet all anchors in tiles of bounded size, dealt by a hash of the row, so no
    label or group of copies weighs on one task. Each tile gives at most five entries per anchor
    and window, and merging keeps five of them before they are shuffled.
    """
    rows = stored(integer_vectors(vectors), "integer-vectors")
    anchors = rows.where(F.col("vec_id") % EVERY == 0)
    n, anchor_n = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % EVERY == 0)).first()
    blocks = (max(1, -(-anchor_n // anchors_in_tile)), max(1, -(-n // candidates_in_tile)))
    best = _tiles(anchors, rows, _positives, POSITIVE, blocks)
    positives = stored(_first(best, ["anchor"], POSITIVES, "place"), "positives")
    tops = positives.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("tops")
    )
    windows = anchors.join(tops, F.col("row") == F.col("anchor")).drop("anchor")
    hard = _tiles(windows, rows, _negatives, NEGATIVE, blocks)
    ranked = _first(hard, ["anchor", "place"], NEGATIVES, "rank").select(
        "anchor", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank"
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        ranked.join(positives.drop("row"), ["anchor", "place"])
        .join(named, "anchor")
        .select(
            "anchor_id",
            F.col("id").alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            F.col("score").alias("positive_score"),
            "negative_score",
        )
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
