"""Embedding near-duplicates with an inverted multi-index (operator 4).

Vectors are cut into halves, each with a codebook of its own; the pairs of codes are the
cells of a product grid, in which every vector is indexed. Each vector visits the cells
nearest to it, in the order in which a multi-sequence traversal meets them, as many as a
sample needed to meet the target share of the hardest links. Cosines are then computed.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import components, stored, table

THRESHOLD = 0.93
#: Codes of a half; vectors the codebooks are fitted on at most, by a hash of the id.
CODES = 32
MAX_SAMPLE = 10_000
ROUNDS = 12
#: Share of the links right at the threshold whose cell is visited from one end.
RECALL = 0.99
#: Vectors of a block; pairs are compared block by block.
BLOCK = 2_000


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ book.T + (book**2).sum(1)[None]


def _codebook(rows: np.ndarray, codes: int) -> np.ndarray:
    """Centres of k-means, from evenly spaced rows of the sample."""
    book = rows[np.linspace(0, len(rows) - 1, min(codes, len(rows))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _nearest(rows, book).argmin(axis=1)
        for k in np.unique(near):
            book[k] = rows[near == k].mean(axis=0)
    return book


@cache
def _staircase(codes: tuple[int, int], visits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in the two sorted code lists that can be among the nearest ``visits`` cells.

    A cell with ranks (a, b) comes after the (a + 1)(b + 1) - 1 cells that are no farther.
    """
    pairs = [
        (a, b)
        for a in range(min(codes[0], visits))
        for b in range(min(codes[1], visits // (a + 1)))
    ]
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])


class Index:
    """Codebooks of both halves and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, threshold: float, recall: float, codes: int) -> None:
        self.half = sample.shape[1] // 2
        self.books = (
            _codebook(sample[:, : self.half], codes),
            _codebook(sample[:, self.half :], codes),
        )
        self.visits = self._visits_for(sample, threshold, recall)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            _nearest(rows[:, : self.half], self.books[0]),
            _nearest(rows[:, self.half :], self.books[1]),
        )

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.distances(rows)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def _visits_for(self, sample: np.ndarray, threshold: float, recall: float) -> int:
        """Cells to visit so that ``recall`` of neighbours right at the threshold are met."""
        noise = np.random.default_rng(42).normal(size=sample.shape)
        noise -= (noise * sample).sum(1)[:, None] * sample
        norm = np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        other = threshold * sample + np.sqrt(1 - threshold**2) * noise / norm
        a, b = self.distances(sample)
        want = self.cells(other)
        ranks = []
        for k in range(0, len(sample), 500):
            grid = (a[k : k + 500, :, None] + b[k : k + 500, None, :]).reshape(
                len(a[k : k + 500]), -1
            )
            own = np.take_along_axis(grid, want[k : k + 500, None], axis=1)
            ranks.append((grid < own).sum(axis=1))
        return int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1

    def visited(self, rows: np.ndarray) -> np.ndarray:
        """The cells each row visits, its own among them."""
        a, b = self.distances(rows)
        by_a, by_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        x, y = _staircase((a.shape[1], b.shape[1]), self.visits)
        far = np.take_along_axis(a, by_a, 1)[:, x] + np.take_along_axis(b, by_b, 1)[:, y]
        if self.visits < len(x):
            best = np.argpartition(far, self.visits - 1, axis=1)[:, : self.visits]
        else:
            best = np.broadcast_to(np.arange(len(x)), far.shape)
        return np.take_along_axis(by_a, x[best], 1) * b.shape[1] + np.take_along_axis(
            by_b, y[best], 1
        )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _usable(vectors: DataFrame) -> DataFrame:
    """Vectors that may link: id, label, finite components, not all zero."""
    return vectors.where(
        "vec_id IS NOT NULL AND label IS NOT NULL "
        "AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        "AND exists(v, x -> x <> 0)"
    )


def fit(vectors: DataFrame, threshold: float, recall: float, codes: int) -> tuple[Index, int] | None:
    """Index fitted on a bounded sample, and the length that most vectors have.

    There is none where no vector can be halved.
    """
    length = vectors.where("size(v) > 1").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return None
    rows = (
        vectors.where(F.size("v") == length["n"])
        .orderBy(F.xxhash64("rep"), "rep")
        .limit(MAX_SAMPLE)
        .select("v")
        .toArrow()
    )
    return Index(_unit(_matrix(rows["v"])), threshold, recall, codes), length["n"]


def _walk(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable over the links (a, b), which are places in ``ids``."""
    root = ids.copy()
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == root).all():
            return root
        root = new


def links(vectors: DataFrame, index: Index | None, length: int, threshold: float) -> DataFrame:
    """``rep, n, root`` per block of pairs: links found there, and whom they lead to.

    ``vectors``: different ``(label, v)``, each with a ``rep`` of its own and ``weight`` copies.
    A pair that both ends visit counts once, at the visit of the smaller ``rep``. Vectors of
    another length than the index has are compared with all others of their label and length,
    in blocks.
    """
    wide = len(index.books[1]) if index else 1
    schema = (
        "rep bigint, weight bigint, label string, v array<double>, cell int, visits array<int>"
    )

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.list_value_length(batch.column(3)).to_numpy()
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                rows = _unit(_matrix(some.column(3)))
                if index and size == length:
                    cells, seen = index.cells(rows), index.visited(rows)
                else:
                    cells = np.zeros(len(rows), np.int64)
                    seen = cells[:, None]
                yield pa.RecordBatch.from_arrays(
                    [
                        *some.columns[:3],
                        pa.array(list(rows), pa.list_(pa.float64())),
                        pa.array(cells, pa.int32()),
                        pa.array(list(seen.astype(np.int32)), pa.list_(pa.int32())),
                    ],
                    names=["rep", "weight", "label", "v", "cell", "visits"],
                )

    # only equal lengths are compared, so the length is a part of the label from here on
    label = F.concat(F.size("v").cast("string"), F.lit(":"), "label").alias("label")
    placed = stored(vectors.select("rep", "weight", label, "v").mapInArrow(place, schema), "placed")
    # a strip is a row of the grid: a vector goes once to each strip it visits
    member = placed.withColumn("strip", F.expr(f"cell div {wide}"))
    prober = placed.withColumn(
        "strip", F.explode(F.expr(f"array_distinct(transform(visits, c -> c div {wide}))"))
    )
    parts = lambda x: (
        x.groupBy("label", "strip").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    )
    sizes = (
        parts(member)
        .withColumnRenamed("parts", "m")
        .join(parts(prober).withColumnRenamed("parts", "p"), ["label", "strip"])
    )
    sizes = stored(sizes, "strips")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.expr(f"pmod(xxhash64(rep), {own})").alias(f"b{own}")
        return (
            rows.join(sizes, ["label", "strip"])
            .select("*", mine, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(f"b{other}"))
            .drop("m", "p")
        )

    key = ["label", "strip", "bm", "bp"]
    columns = [*key, "rep", "weight", "v", "cell", "visits"]

    def compare(probers: pa.Table, members: pa.Table) -> pa.Table:
        out = {"rep": [], "n": [], "root": []}
        if len(probers) and len(members):
            x, y = _matrix(probers["v"]), _matrix(members["v"])
            xi, yi = probers["rep"].to_numpy(), members["rep"].to_numpy()
            cell_x, cell_y = probers["cell"].to_numpy(), members["cell"].to_numpy()
            seen_x = [set(c) for c in probers["visits"].to_pylist()]
            seen_y = [set(c) for c in members["visits"].to_pylist()]
            pairs = [
                (i, j)
                for i, j in np.argwhere((x @ y.T >= threshold) & (xi[:, None] != yi[None]))
                if cell_y[j] in seen_x[i] and (xi[i] < yi[j] or cell_x[i] not in seen_y[j])
            ]
            if pairs:
                i, j = np.array(pairs).T
                ids, at = np.unique(np.concatenate((xi[i], yi[j])), return_inverse=True)
                a, b = at[: len(i)], at[len(i) :]
                n = np.bincount(a, members["weight"].to_numpy()[j], len(ids))
                n += np.bincount(b, probers["weight"].to_numpy()[i], len(ids))
                out = {"rep": ids, "n": n.astype(np.int64), "root": _walk(a, b, ids)}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return (
        dealt(prober, "p", "m")
        .select(columns)
        .groupBy(*key)
        .cogroup(dealt(member, "m", "p").select(columns).toDF(*columns).groupBy(*key))
        .applyInArrow(compare, "rep bigint, n bigint, root bigint")
    )


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, codes: int = CODES
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Reads ``vec_id, embedding, label``. Only equal labels that are not NULL, and equal lengths,
    are compared; vectors that are NULL, empty, zero, or hold a NULL or non-finite component
    link with nothing. Rows of one label and vector link with each other; they are compared
    as one. Rows that share an id are rows of their own. A row without links is its own
    component and kept; one with a NULL id links with nothing, has a NULL component and is kept.
    """
    named = vectors.select(
        F.col("vec_id").cast("bigint"),
        F.col("label").cast("string"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    unique = stored(
        _usable(named)
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
        .select(F.monotonically_increasing_id().alias("rep"), "*"),
        "vectors",
    )
    index, length = fit(unique, threshold, recall, codes) or (None, 0)
    found = stored(links(unique, index, length, threshold), "links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    placed = stored(
        unique.join(counts, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select("*", F.coalesce("root", "rep").alias("class")),
        "classes",
    )
    lowest = placed.groupBy("class").agg(F.min("low").alias("component"))
    known = placed.join(lowest, "class").select(
        F.col("label").alias("_label"),
        F.col("v").alias("_v"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component",
    )
    mine = F.col("vec_id").isNotNull() & (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v"))
    component = F.coalesce("component", "vec_id")
    return named.join(known, mine, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op4_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs of a label, and the smallest id reachable over the links.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT a AS vec_id, b AS reached FROM l
  UNION
  SELECT r.vec_id, l.b FROM r JOIN l ON r.reached = l.a
), m AS (SELECT vec_id, min(reached) AS low FROM r GROUP BY vec_id
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links,
  least(e.vec_id, coalesce(low, e.vec_id))::BIGINT AS component_id,
  e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
"""
