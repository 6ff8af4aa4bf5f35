"""Benchmark decontamination with a positional inverted index (operator 10).

Only DataFrame functions. Corpus counts of the test terms rank the terms of each window. For
its two rarest terms the index stores, per term and text, the positions. The list of the
rarest term and that of the second, each shifted by its term's offset, are intersected, which
takes time in proportion to the lists; what is left is compared with the text word by word.
Proximity matches come from the same two lists. Texts, not documents, are indexed, so copies
and repeated rows share their lists, and each input row has a row of its own in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import as_row, lower_ascii, stored, table, words

WINDOW = 10
#: What stands between words: ASCII other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    return words(lower_ascii(text), BETWEEN)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Different windows of the items: ``phrase, n, terms, items`` (ids as strings)."""
    cut = items.select(F.col("item_id").cast("string"), tokens(F.col("text")).alias("w")).select(
        "item_id",
        F.explode(
            F.expr(
                f"CASE WHEN size(w) = 0 THEN array() WHEN size(w) < {window} THEN array(w) "
                f"ELSE transform(sequence(0, size(w) - {window}), i -> slice(w, i + 1, {window})) END"
            )
        ).alias("terms"),
    )
    return cut.groupBy("terms").agg(F.collect_set("item_id").alias("items")).select(
        F.array_join("terms", " ").alias("phrase"), F.size("terms").alias("n"), "terms", "items"
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: ``term, text_key, positions`` of the given terms in all texts."""
    at = docs.select(F.xxhash64("text").alias("text_key"), tokens(F.col("text")).alias("w")).select(
        "text_key", F.posexplode("w").alias("pos", "term")
    )
    return (
        at.join(terms, "term", "left_semi")
        .groupBy("term", "text_key")
        .agg(F.collect_set("pos").alias("positions"))
    )


def ranked_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The terms of each window from the rarest on: ``phrase, rank, term, offset``.

    A window with a term that no document has is left out: it cannot occur.
    """
    term = windows.select("phrase", F.posexplode("terms").alias("offset", "term"))
    vocabulary = stored(term.select("term").distinct(), "vocabulary")
    counts = (
        docs.select(F.explode(tokens(F.col("text"))).alias("term"))
        .join(vocabulary, "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    by = W.partitionBy("phrase")
    return (
        term.join(counts, "term", "left")
        .withColumn("least", F.min(F.coalesce("df", F.lit(0))).over(by))
        .withColumn("rank", F.row_number().over(by.orderBy("df", "offset")))
        .where("least > 0")
        .select("phrase", "rank", "term", "offset")
    )


def phrase_candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``text_key, cands``: each window with the ``starts`` at which its two rarest terms stand
    rightly; a start before the text's first word is among them."""
    windows = stored(windows, "windows")
    ranked = stored(ranked_terms(docs, windows).where("rank <= 2"), "anchors")
    first = ranked.where("rank = 1").select("phrase", "term", "offset")
    second = ranked.where("rank = 2").select(
        "phrase", F.col("term").alias("term2"), F.col("offset").alias("offset2")
    )
    lookup = (
        first.join(second, "phrase", "left")
        .join(windows.select("phrase", "n", "items"), "phrase")
        .groupBy("term")
        .agg(
            F.collect_list(
                F.struct(
                    "phrase",
                    "n",
                    "items",
                    "term",
                    "offset",
                    F.coalesce("term2", "term").alias("term2"),
                    F.coalesce("offset2", "offset").alias("offset2"),
                )
            ).alias("windows")
        )
    )
    index = stored(postings(docs, ranked.select("term").distinct()), "postings")
    lists = (
        index.join(lookup, "term", "left")
        .groupBy("text_key")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("lists"),
            F.flatten(F.collect_list("windows")).alias("windows"),
        )
    )
    # a list holds the positions of a term; shifted by its offset, the starts of the window
    met = F.expr(
        "filter(transform(filter(windows, w -> map_contains_key(lists, w.term2)), "
        "w -> named_struct('phrase', w.phrase, 'n', w.n, 'items', w.items, 'starts', "
        "array_intersect(transform(lists[w.term], p -> p - w.offset), "
        "transform(lists[w.term2], p -> p - w.offset2)))), c -> size(c.starts) > 0)"
    )
    return lists.select("text_key", met.alias("cands")).where("size(cands) > 0")


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each input row as ``row``, its ``words``, and as ``hits`` the occurrences of item windows.

    A hit is ``(phrase, n, items, starts)``. Only ``text``, and ``item_id`` and ``text`` of
    the items, are read. NULL and empty texts have no words and no hits; an item without
    words has no window; an item with a NULL id hits words but is not named.
    """
    cands = phrase_candidates(docs, item_windows(items, window))
    joined = as_row(docs).withColumn("text_key", F.xxhash64("row.text"))
    joined = joined.join(cands, "text_key", "left")
    exact = F.expr(
        "filter(transform(cands, c -> named_struct('phrase', c.phrase, 'n', c.n, 'items', c.items, "
        "'starts', filter(c.starts, s -> s >= 0 AND "
        "array_join(slice(words, greatest(s, 0) + 1, c.n), ' ') = c.phrase))), h -> size(h.starts) > 0)"
    )
    return joined.withColumn("words", tokens(F.col("row.text"))).select(
        "row", "words", F.when(F.col("cands").isNotNull(), exact).alias("hits")
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per input row: counts of words, hit words and items, and whether it is hit."""
    names = F.expr(
        "coalesce(array_sort(array_distinct(flatten(transform(hits, h -> h.items)))), array())"
    ).cast("array<string>")
    hit = F.expr(
        "coalesce(size(array_distinct(flatten(flatten(transform(hits, "
        "h -> transform(h.starts, s -> sequence(s, s + h.n - 1))))))), 0)"
    )
    return (
        phrase_matches(docs.select("doc_id", "text"), items, window)
        .withColumn("hits", F.expr("if(size(hits) > 0, hits, NULL)"))
        .select(
            "row.doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            F.when(F.col("hits").isNotNull(), hit).otherwise(0).cast("bigint").alias("n_hit"),
            names.alias("items"),
        )
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The input rows, all columns, whose texts hold no item window."""
    found = phrase_matches(docs, items, window)
    return found.where("coalesce(size(hits), 0) < 1").select("row.*")


def proximity_matches(
    docs: DataFrame, items: DataFrame, span: int, rarest: int = 3, window: int = WINDOW
) -> DataFrame:
    """``text_key, phrase, items, at``: where a window's rarest terms stand close together.

    ``at`` are the positions of the rarest term that have each of the next ``rarest - 1``
    within ``span`` words, in any order.
    """
    windows = stored(item_windows(items, window), "windows")
    ranked = stored(ranked_terms(docs, windows).where(F.col("rank") <= rarest), "anchors")
    index = stored(postings(docs, ranked.select("term").distinct()), "postings")
    lists = ranked.join(index, "term").groupBy("phrase", "text_key").agg(
        F.collect_list(F.struct("rank", "positions")).alias("lists")
    )
    near = F.expr(
        "filter(filter(lists, l -> l.rank = 1)[0].positions, p -> forall(lists, l -> "
        f"exists(l.positions, x -> abs(x - p) <= {span})))"
    )
    size = ranked.groupBy("phrase").agg(F.count("*").alias("terms"))
    return (
        lists.join(size, "phrase")
        .where("size(lists) = terms")
        .select("phrase", "text_key", F.array_sort(near).alias("at"))
        .where("size(at) > 0")
        .join(windows.select("phrase", "items"), "phrase")
        .select("text_key", "phrase", "items", "at")
    )


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items)


#: The contract in SQL, by all windows of both sides.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM p
), dw AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, sizes WHERE len(w) >= n)
), h AS (SELECT doc_id, k, n, item_id FROM dw JOIN p USING (n, phrase)
), c AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS x FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
