"""Mixing sources to target weights with a hypergeometric splitting tree (operator 8).

Only DataFrame and SQL functions. A source's documents are cut into blocks of words, which a
keyed hash permutes. Whole passes and the head of one more pass give the blocks that come
nearest to the source's target; their number is its quota. The quotas of all sources are
split from the root down: each node hands its left half of the shards a number of blocks of
each source drawn from the multivariate hypergeometric distribution, and the rest to the
right half. The leaves say which ranks of a source's permuted blocks a shard takes, so that
shards are disjoint; each shard orders its blocks by another hash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import stored, table, words

#: Weights of the sources in order, the mix as a share of all words, the most
#: passes over one source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
#: Words of a block; a document's last block may be shorter.
BLOCK_WORDS = 128
#: Blocks of a shard, and of one range of a source's permutation, on average.
SHARD_BLOCKS = 50_000
RANGE_BLOCKS = 16_384
#: Standard deviations around the mean in which a draw is sought.
REACH = 12


def documents_of(docs: DataFrame) -> DataFrame:
    """One row per input row without its text; ``twin`` numbers rows that are repeated whole."""
    return (
        docs.select(
            F.col("doc_id").cast("bigint"),
            F.xxhash64("text").alias("text_key"),
            F.col("source").cast("string"),
            F.size(words(F.col("text"))).cast("bigint").alias("size"),
        )
        .groupBy("doc_id", "text_key", "source", "size")
        .agg(F.count("*").alias("n"))
        .select(
            "doc_id",
            "text_key",
            "source",
            "size",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("twin"),
        )
    )


def targets(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """``source, idx, source_size, blocks, weight, target`` of each source.

    Sorted by cap and weight, the sources that stop at their cap come first; what is left of
    the mix is shared by weight among the rest.
    """
    sums = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.ceil(F.col("size") / block)).cast("bigint").alias("blocks"),
    )
    everything = W.partitionBy(F.lit(1))
    turn = ", ".join(str(w) for w in weights)
    weighed = (
        sums.withColumn(
            "idx", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
        )
        .withColumn("weight", F.expr(f"double(array({turn})[idx % {len(weights)}])"))
        .withColumn("cap", F.col("source_size") * float(passes))
    )
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "idx")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) * share)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = weighed.withColumn("level", level).withColumn(
        "place", F.row_number().over(by_ratio)
    )
    free = F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct("place", "level"))
    return levelled.withColumn("at", F.min(free).over(everything)).select(
        "source",
        "idx",
        "source_size",
        "blocks",
        "weight",
        F.least("cap", F.col("at.level") * F.col("weight")).alias("target"),
    )


def _draw(total: str, good: str, n: str, u: str) -> str:
    """SQL: a hypergeometric number of good ones among ``n`` of ``total``, by inversion."""
    low = f"greatest(0L, {n} - ({total} - {good}))"
    high = f"least({n}, {good})"
    mean = f"({n} * double({good}) / greatest({total}, 1L))"
    spread = (
        f"({REACH} * sqrt({mean} * (1 - double({good}) / greatest({total}, 1L)) "
        f"* ({total} - {n}) / greatest({total} - 1, 1L)) + {REACH})"
    )
    steps = (
        f"sequence(greatest({low}, bigint({mean} - {spread})), "
        f"least({high}, bigint({mean} + {spread})))"
    )
    ratio = (
        f"double({good} - k) * double({n} - k) "
        f"/ (double(k + 1) * double({total} - {good} - {n} + k + 1))"
    )
    whole = (
        f"aggregate(s, named_struct('w', 1D, 'sum', 0D), (a, k) -> "
        f"named_struct('w', a.w * ({ratio}), 'sum', a.sum + a.w)).sum"
    )
    pick = (
        f"aggregate(s, named_struct('w', 1D, 'sum', 0D, 'k', s[0] - 1), (a, k) -> "
        f"named_struct('w', a.w * ({ratio}), 'sum', a.sum + a.w, "
        f"'k', if(a.sum <= {u} * x, k, a.k))).k"
    )
    return (
        f"transform(array({steps}), s -> transform(array({whole}), x -> {pick})[0])[0]"
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """Quotas ``idx, quota`` dealt to ``shards`` shards: ``idx, shard, from, to`` (ranks)."""
    node = quotas.agg(
        F.expr("transform(array_sort(collect_list(struct(idx, quota))), x -> x.quota)").alias("q")
    ).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "q")
    uniform = (
        f"(shiftrightunsigned(xxhash64({seed}, lo, hi, acc.i), 11) / 9007199254740992D)"
    )
    left = F.expr(
        "aggregate(q, named_struct('rest', aggregate(q, 0L, (a, x) -> a + x), 'n', "
        "bigint(floor(aggregate(q, 0L, (a, x) -> a + x) * double(div) / (hi - lo))), "
        "'i', 0, 'out', cast(array() AS array<bigint>)), (acc, g) -> "
        f"transform(array({_draw('acc.rest', 'g', 'acc.n', uniform)}), d -> named_struct("
        "'rest', acc.rest - g, 'n', acc.n - d, 'i', acc.i + 1, "
        "'out', concat(acc.out, array(d))))[0]).out"
    )
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        halved = node.withColumn("div", F.expr("(hi - lo) div 2")).withColumn(
            "l", F.when(F.col("hi") - F.col("lo") > 1, left)
        )
        node = halved.select(
            F.explode(
                F.expr(
                    "if(l IS NULL, array(named_struct('lo', lo, 'hi', hi, 'q', q)), array("
                    "named_struct('lo', lo, 'hi', int(lo + div), 'q', l), "
                    "named_struct('lo', int(lo + div), 'hi', hi, "
                    "'q', zip_with(q, l, (a, b) -> a - b))))"
                )
            ).alias("n")
        ).select("n.*")
        node = stored(node, "tree")
    order = W.partitionBy("idx").orderBy("shard")
    return node.select(F.col("lo").alias("shard"), F.posexplode("q").alias("idx", "n")).select(
        "idx",
        "shard",
        (F.sum("n").over(order) - F.col("n")).alias("from"),
        F.sum("n").over(order).alias("to"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block: int = BLOCK_WORDS,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents, the targets and the blocks of the mix.

    Blocks: ``shard, position, source, doc_id, text_key, twin, pass, block, first_word,
    n_words``. ``position`` counts from 1 within the shard. Only ``doc_id``, ``text`` and
    ``source`` are read. NULL and blank texts have size 0 and give no block; a NULL source
    is a source, the last; rows repeated whole are documents of their own. A source without
    words has the target 0. Same rows, same mix, in whatever order they come.
    """
    rows = stored(documents_of(docs), "sizes")
    sources = stored(targets(rows, weights, share, passes, block), "targets")
    cut = (
        rows.where("size > 0")
        .join(sources.drop("weight"), rows["source"].eqNullSafe(sources["source"]))
        .drop(sources["source"])
        .withColumn("block", F.explode(F.expr(f"sequence(0L, (size - 1) div {block})")))
        .withColumn("n_words", F.least(F.lit(block), F.col("size") - F.col("block") * block))
        .withColumn("u", F.xxhash64(F.lit(seed), "doc_id", "text_key", "twin", "block"))
        .withColumn("bits", F.expr(f"int(ceil(greatest(0D, log2(blocks / {RANGE_BLOCKS}D))))"))
        .withColumn("range", F.expr("if(bits = 0, 0L, shiftrightunsigned(u, 64 - bits))"))
        .select(
            "idx", "source", "doc_id", "text_key", "twin", "block", "n_words", "u", "range"
        )
    )
    cut = stored(cut, "blocks")
    # ranks and word sums along the permutation: first over ranges, then within each
    part = W.partitionBy("idx").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        cut.groupBy("idx", "range")
        .agg(F.count("*").alias("n"), F.sum("n_words").alias("w"))
        .select(
            "idx",
            "range",
            F.coalesce(F.sum("n").over(part), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("w").over(part), F.lit(0)).alias("w_before"),
        )
    )
    within = W.partitionBy("idx", "range").orderBy("u", "doc_id", "text_key", "twin", "block")
    ranked = (
        cut.withColumn("rank", F.row_number().over(within))
        .withColumn("sum", F.sum("n_words").over(within.rowsBetween(W.unboundedPreceding, 0)))
        .join(ranges, ["idx", "range"])
        .withColumn("rank", F.col("rank") - 1 + F.col("n_before"))
        .withColumn("sum", F.col("sum") + F.col("w_before"))
        .join(sources.select("idx", "source_size", "blocks", "target"), "idx")
        .withColumn("full", F.expr(f"least({passes}L, bigint(floor(target / source_size)))"))
        # a block belongs to the last, partial pass if the target lies beyond its middle
        .withColumn("head", F.expr("target - full * source_size > sum - n_words / 2D"))
    )
    ranked = stored(ranked, "ranked")
    quotas = ranked.groupBy("idx").agg(
        F.sum(F.col("full") + F.col("head").cast("bigint")).alias("quota")
    )
    quotas = stored(quotas.where("quota > 0"), "quotas")
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / SHARD_BLOCKS))
    numbered = quotas.withColumn(
        "slot", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("idx")) - 1
    )
    dealt = split_quotas(numbered.select(F.col("slot").alias("idx"), "quota"), shards, seed)
    cuts = (
        dealt.groupBy("idx")
        .agg(F.array_sort(F.collect_list("to")).alias("cuts"))
        .withColumnRenamed("idx", "slot")
        .join(numbered.select("slot", "idx"), "slot")
        .select("idx", "cuts")
    )
    blocks = (
        ranked.withColumn(
            "pass",
            F.explode(
                F.expr("filter(sequence(0L, full), p -> p < full OR (p = full AND head))")
            ),
        )
        .withColumn("rank", F.col("rank") + F.col("pass") * F.col("blocks"))
        .join(cuts, "idx")
        .withColumn("shard", F.size(F.expr("filter(cuts, c -> c <= rank)")))
    )
    local = W.partitionBy("shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "u", "pass"), "doc_id", "text_key", "twin", "block", "pass"
    )
    blocks = blocks.select(
        "shard",
        F.row_number().over(local).alias("position"),
        "source",
        "doc_id",
        "text_key",
        "twin",
        "pass",
        "block",
        (F.col("block") * block).alias("first_word"),
        "n_words",
    )
    return rows, sources, blocks


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The blocks of the mix with their words, joined by single spaces."""
    _, _, blocks = mix(docs, **options)
    of = (
        blocks.groupBy("doc_id", "text_key", "source")
        .agg(
            F.collect_list(
                F.struct("shard", "position", "pass", "block", "first_word", "n_words")
            ).alias("parts")
        )
        .toDF("_id", "_key", "_source", "parts")
    )
    texts = (
        docs.select(
            F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("key"),
            F.col("source").cast("string"), "text",
        )
        .dropDuplicates(["doc_id", "key", "source"])
    )
    joined = texts.join(
        of,
        (F.col("key") == F.col("_key"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_source")),
    )
    return (
        joined.select("doc_id", "source", words(F.col("text")).alias("w"), "parts")
        .select("doc_id", "source", "w", F.explode("parts").alias("p"))
        .select(
            "p.shard", "p.position", "doc_id", "source", "p.pass", "p.block", "p.first_word",
            "p.n_words",
            F.expr("array_join(slice(w, int(p.first_word) + 1, int(p.n_words)), ' ')").alias("text"),
        )
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sources, blocks = mix(table(spark, sf_dir, "documents"))
    key = ["doc_id", "text_key", "source", "twin"]
    taken = blocks.groupBy(*key).agg(F.sum("n_words").alias("taken")).toDF(
        "_id", "_key", "_source", "_twin", "taken"
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.col("text_key") == F.col("_key"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("twin") == F.col("_twin"))
    )
    of = sources.select(F.col("source").alias("_of"), "source_size", "target")
    return (
        rows.join(taken, same, "left")
        .join(of, F.col("source").eqNullSafe(F.col("_of")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        )
    )
