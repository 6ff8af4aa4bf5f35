"""Language-model score by a subword lattice (operator 11).

The pieces of an existing vocabulary span a lattice over each word: every way to cut the word
into pieces is a path, and the word's spelling probability is the sum over all paths, by a
forward recursion in logarithms. Pieces never reach over a space, so a text's lattice falls
apart into those of its words, and each different word is solved once.

The vocabulary is taken as it is. Its scores order the pieces; by their rank they give the
weights that learning starts from and is held to. Expectation-maximisation over the different
training words, each with weight one, then sets the weights to what the corpus needs. A word
seen in training is also an arc of its own, with its discounted share of all tokens; what the
discounts free goes to the spelled paths:

    P(word) = max(c - d, 0) / N + d V / N * P(pieces spell word)

so the text's probability, with its end, sums to one over all texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import stored, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Rounds of expectation-maximisation, and words' worth of evidence behind the file's order.
ROUNDS, PRIOR = 2, 1_000.0
#: Flattens the head of the weights that ranks give.
HEAD = 10.0
#: Commonest words whose values travel to every task; all others are joined.
COMMON = 200_000
#: Different words a task counts before it passes them on.
REMEMBERED = 1 << 19
#: Bytes of words whose lattices are solved at once; a longer word is solved byte by byte.
BLOCK, LONG = 1 << 17, 1_024
#: Longest word that is its own key; longer ones are named by a digest.
KEY = 32
LN10 = math.log(10)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces as bytes, a space for the word's begin, and the logarithms of their weights."""

    def __init__(self, weights: dict[bytes, float]) -> None:
        every = {bytes([b]): 0.0 for b in range(256)} | weights
        self.place = {piece: k for k, piece in enumerate(every)}
        self.longest = max(map(len, every))
        w = np.array(list(every.values()), np.float64)
        # the last weight is that of a word's end
        w = np.append(np.maximum(w, w[w > 0].min() / 10 if (w > 0).any() else 1.0), 0.0)
        w[-1] = w.sum() / 4
        self.known = _by_size(self.place)
        self.start = w / w.sum()
        self.log = np.log(self.start)

    def learned(self, expected: np.ndarray, prior: float = PRIOR) -> Pieces:
        """The same pieces, weighed by expected counts and the weights at the start."""
        other = object.__new__(Pieces)
        other.place, other.known, other.longest, other.start = self.place, self.known, self.longest, self.start
        other.log = np.log((expected + prior * self.start) / (expected.sum() + prior))
        return other

    def lattice(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Arcs ``source, target, piece, depth`` of all words, and the last node of each word.

        Nodes are the places before, between and after the bytes. Arcs are in the order of
        their target's place in its word, so that words are solved side by side.
        """
        text = np.frombuffer(b"".join(b" " + w + b"\0" for w in words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        last = np.cumsum(sizes) - 1
        left = np.repeat(last, sizes) - np.arange(len(text))  # bytes to the word's end
        begin = np.repeat(last - sizes + 1, sizes)
        at = np.flatnonzero(left > 0)
        tail = np.zeros(len(at), np.uint64)
        full = tail
        found = []
        for size in range(1, self.longest + 1):
            if size > 1:
                more = left[at] >= size
                at, tail, full = at[more], tail[more], full[more]
            here = text[at + size - 1].astype(np.uint64)
            tail, full = tail << np.uint64(8) | here, full * MULTIPLIER + here
            if size not in self.known:
                continue
            hashes, tails, places = self.known[size]
            spot = np.minimum(np.searchsorted(hashes, full), len(hashes) - 1)
            same = np.flatnonzero((hashes[spot] == full) & (tails[spot] == tail))
            found.append((at[same], np.full(len(same), size), places[spot[same]]))
        source, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        target = source + size
        depth = target - begin[source]
        order = np.argsort(depth * len(text) + target, kind="stable")
        return source[order], target[order], piece[order], depth[order], last

    def forward(self, arcs: tuple[np.ndarray, ...]) -> np.ndarray:
        """Log-probability of reaching each node; first nodes of words have 0."""
        source, target, piece, depth, last = arcs
        reached = np.zeros(last[-1] + 1)
        for a, b in _runs(depth):
            _log_sums(reached, target[a:b], reached[source[a:b]] + self.log[piece[a:b]])
        return reached

    def spell(self, words: list[bytes]) -> np.ndarray:
        """Log-probability that pieces and a word's end spell each word."""
        out = np.empty(len(words))
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        for some in _blocks(short, words):
            arcs = self.lattice([words[k] for k in some])
            out[some] = self.forward(arcs)[arcs[-1]] + self.log[-1]
        for k in (k for k, w in enumerate(words) if len(w) > LONG):
            out[k] = self._spell_long(words[k]) + self.log[-1]
        return out

    def _spell_long(self, word: bytes) -> float:
        text, reached, log = b" " + word, [0.0], self.log.tolist()
        for j in range(1, len(text) + 1):
            terms = []
            for back in range(1, len(reached) + 1):
                k = self.place.get(text[j - back : j])
                if k is not None:
                    terms.append(reached[-back] + log[k])
            top = max(terms)
            reached.append(top + math.log(sum(math.exp(t - top) for t in terms)))
            del reached[: -self.longest]
        return reached[-1]

    def expected(self, words: Iterable[bytes]) -> np.ndarray:
        """Expected uses of each piece over all paths of the words, the last: of their end."""
        parts = [w[k : k + LONG] for w in words for k in range(0, len(w), LONG)]
        out = np.zeros(len(self.log))
        for some in _blocks(range(len(parts)), parts):
            source, target, piece, depth, last = arcs = self.lattice([parts[k] for k in some])
            reached = self.forward(arcs)
            onward = np.zeros(len(reached))
            # from the back: what follows the targets is known before their sources
            start = depth - (target - source)
            order = np.argsort(start * len(reached) + source, kind="stable")
            for a, b in reversed(_runs(start[order])):
                some_arcs = order[a:b]
                here = onward[target[some_arcs]] + self.log[piece[some_arcs]]
                _log_sums(onward, source[some_arcs], here)
            word = np.searchsorted(last, target)
            use = reached[source] + self.log[piece] + onward[target] - reached[last[word]]
            out += np.bincount(piece, np.exp(use), len(out))
            out[-1] += len(some)
        return out


def _by_size(place: dict[bytes, int]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: sorted hashes of the pieces, the last eight bytes of each, and its place."""
    known = {}
    with np.errstate(over="ignore"):
        for size in {len(p) for p in place}:
            some = [p for p in place if len(p) == size]
            rows = np.frombuffer(b"".join(some), np.uint8).reshape(-1, size).astype(np.uint64)
            full, tail = np.zeros(len(some), np.uint64), np.zeros(len(some), np.uint64)
            for column in rows.T:
                full, tail = full * MULTIPLIER + column, tail << np.uint64(8) | column
            order = np.argsort(full)
            known[size] = (full[order], tail[order], np.array([place[p] for p in some])[order])
    return known


def _runs(depth: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(depth)) + 1
    return list(zip([0, *edges], [*edges, len(depth)], strict=True)) if len(depth) else []


def _log_sums(into: np.ndarray, at: np.ndarray, terms: np.ndarray) -> None:
    """Set ``into`` to the log of the sum of terms at each place; equal places are neighbours."""
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    top = np.maximum.reduceat(terms, first)
    sums = np.add.reduceat(np.exp(terms - np.repeat(top, np.diff(np.r_[first, len(at)]))), first)
    into[at[first]] = top + np.log(sums)


def _blocks(places: Iterable[int], words: list[bytes]) -> Iterator[list[int]]:
    """Places of words of like length, about ``BLOCK`` bytes at a time."""
    some, size = [], 0
    for k in sorted(places, key=lambda k: len(words[k])):
        some.append(k)
        size += len(words[k]) + 2
        if size >= BLOCK:
            yield some
            some, size = [], 0
    if some:
        yield some


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Pieces of a vocabulary file, weighed by the rank of their score in it.

    A file of merges scores a piece by its rank; such scores only order the pieces, so weights
    fall with the rank as word frequencies do. Control signs and pieces with a space inside
    cannot stand in a word and are left out.
    """
    from sentencepiece import SentencePieceProcessor

    file = SentencePieceProcessor(model_file=path)
    scored = []
    for k in range(file.get_piece_size()):
        piece = file.id_to_piece(k).replace("▁", " ").encode()
        if not (file.is_control(k) or file.is_unknown(k) or file.is_byte(k) or b" " in piece[1:]):
            scored.append((-file.get_score(k), piece))
    return Pieces({piece: 1 / (rank + HEAD) for rank, (_, piece) in enumerate(sorted(scored))})


def key_of(word: bytes) -> bytes:
    return word if len(word) <= KEY else word[:8] + blake2b(word, digest_size=KEY).digest()


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or b"").lower().split()


def _texts(docs: DataFrame) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return docs.select(
        F.col("doc_id").cast("bigint"), held_out.alias("held_out"), F.encode("text", "utf-8").alias("text")
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``key, word, n, known``: every different word, how often it occurs in all and in
    training texts. ``word`` is NULL if it is its own key. The end of a text is the word ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            words = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([key_of(w) for w in words], pa.binary()),
                    pa.array([w if len(w) > KEY else None for w in words], pa.binary()),
                    pa.array([counts[0][w] + counts[1][w] for w in words], pa.int64()),
                    pa.array([counts[0][w] for w in words], pa.int64()),
                ],
                names=["key", "word", "n", "known"],
            )
            counts[0].clear()
            counts[1].clear()
            return batch

        for batch in batches:
            for held_out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[held_out].update(words_of(text))
                counts[held_out][b""] += 1
                if len(counts[0]) + len(counts[1]) >= REMEMBERED:
                    yield rows()
        yield rows()

    return (
        _texts(docs)
        .select("held_out", "text")
        .mapInArrow(run, "key binary, word binary, n bigint, known bigint")
        .groupBy("key")
        .agg(F.max("word").alias("word"), F.sum("n").alias("n"), F.sum("known").alias("known"))
    )


def learn(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Weights after some rounds over the different training words.

    What reaches the driver is one number per piece of the vocabulary.
    """
    seen = words.where("known > 0 AND key <> X''").select(F.coalesce("word", "key"))
    for _ in range(rounds):
        now = pieces

        def run(batches: Iterator[pa.RecordBatch], now: Pieces = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(now.log))
            for batch in batches:
                total += now.expected(batch.column(0).to_pylist())
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["k", "n"])

        expected = np.zeros(len(pieces.log))
        for row in seen.mapInArrow(run, "k bigint, n double").groupBy("k").agg(F.sum("n").alias("n")).collect():
            expected[row["k"]] = row["n"]
        pieces = pieces.learned(expected)
    return pieces


class Totals:
    """Training tokens, different ones, and the discount, from counts of counts."""

    def __init__(self, words: DataFrame) -> None:
        c = F.col("known")
        row = words.agg(
            F.sum(c).alias("tokens"),
            F.count_if(c > 0).alias("types"),
            F.count_if(c == 1).alias("once"),
            F.count_if(c == 2).alias("twice"),
        ).first()
        self.tokens, self.types = row["tokens"] or 0, row["types"]
        once, twice = row["once"], row["twice"]
        self.discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def mixed(self, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Logarithm to base 10 of a token's probability; ``spelled`` is to base e."""
        if not self.tokens:
            return (spelled + math.log(0.5)) / LN10
        with np.errstate(divide="ignore"):
            arc = np.log(np.maximum(count - self.discount, 0.0) / self.tokens)
        rest = math.log(self.discount * self.types / self.tokens)
        return np.logaddexp(arc, rest + spelled) / LN10


VALUES = "key binary, n bigint, known boolean, base double, score double, lattice double"


def word_values(words: DataFrame, totals: Totals, pieces: Pieces) -> DataFrame:
    """``VALUES`` of every different word; ``lattice`` is of its spelling alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, long, n, count = batch.columns
            text = [w if w is not None else k for k, w in zip(names.to_pylist(), long.to_pylist(), strict=True)]
            known = count.to_numpy()
            spelled = pieces.spell(text)
            end = np.array([not w for w in text], bool)
            # a text's end is an arc only; nothing spells it
            score = totals.mixed(known, np.where(end, -np.inf if totals.tokens else 0.0, spelled))
            yield pa.RecordBatch.from_arrays(
                [
                    names,
                    n,
                    pa.array(known > 0),
                    pa.array(totals.base(known)),
                    pa.array(score),
                    pa.array(np.where(end, 0.0, spelled) / LN10),
                ],
                names=["key", "n", "known", "base", "score", "lattice"],
            )

    return words.select("key", "word", "n", "known").mapInArrow(run, VALUES)


SUMS = ["n_known", "base_score", "score", "lattice_score"]


def _first_sums(docs: DataFrame, common: dict[bytes, int], values: np.ndarray) -> DataFrame:
    """Each text's sums over its common words, and its other words with their counts."""
    get, padded = common.get, np.vstack((values, np.zeros(values.shape[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, tokens, rare = [], [], []
            for text in batch.column(3).to_pylist():
                words = words_of(text)
                words.append(b"")
                places = [get(w, -1) for w in words]
                sums.append(padded[places].sum(axis=0))
                tokens.append(len(words))
                others = Counter(w for w, k in zip(words, places, strict=True) if k < 0)
                rare.append([{"key": key_of(w), "times": n} for w, n in others.items()])
            by = np.array(sums).reshape(-1, len(SUMS))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(tokens, pa.int64()),
                    *[pa.array(by[:, k]) for k in range(len(SUMS))],
                    pa.array(rare, pa.list_(pa.struct([("key", pa.binary()), ("times", pa.int64())]))),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", *SUMS, "rare"],
            )

    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known double, base_score double, "
        "score double, lattice_score double, rare array<struct<key: binary, times: bigint>>"
    )
    return (
        _texts(docs)
        .select(F.monotonically_increasing_id().alias("row"), "*")
        .mapInArrow(run, schema)
    )


def score_texts(
    docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, common: int = COMMON
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, lattice_score``, all scores logarithms to base 10.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. NULL and empty texts
    hold one token, their end. A NULL id is a training text. Repeated rows count as often as
    they stand there and each has a row. Texts and words have no length limit. Without training
    texts the file's weights spell all words and ``train_tokens`` is 0; no rows, no result.
    ``lattice_score`` is of the spelling alone, with no word arcs and no end.

    The ``common`` most frequent words travel to all tasks: 200,000 keys of at most 40
    bytes, at any size. Each other word holds at most that fraction of all tokens; the texts'
    counts of those words are joined by word.
    """
    words = stored(word_counts(docs), "words")
    totals = Totals(words)
    pieces = learn(words, load_pieces(vocabulary), rounds)
    values = stored(word_values(words, totals, pieces), "word-values")
    top = values.orderBy(F.desc("n"), "key").limit(common).select("key", "known", "base", "score", "lattice")
    known = top.toArrow()
    table_of = np.column_stack([known[c].to_numpy().astype(np.float64) for c in ("known", "base", "score", "lattice")])
    places = {k: i for i, k in enumerate(known["key"].to_pylist()) if len(k) <= KEY}
    texts = stored(_first_sums(docs, places, table_of), "first-sums")
    each = F.explode("rare").alias("w")
    rest = (
        texts.select("row", each)
        .select("row", "w.key", "w.times")
        .join(values.withColumnRenamed("score", "word_score"), "key")
        .select(
            "row",
            F.lit(None).cast("bigint").alias("doc_id"),
            F.lit(None).cast("boolean").alias("held_out"),
            F.lit(0).cast("bigint").alias("n_tokens"),
            *[
                (F.col(v).cast("double") * F.col("times")).alias(s)
                for v, s in zip(("known", "base", "word_score", "lattice"), SUMS, strict=True)
            ],
        )
    )
    return (
        texts.drop("rare")
        .union(rest)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            *[F.sum(s).alias(s) for s in SUMS],
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            F.round("n_known").cast("bigint").alias("n_known"),
            F.lit(totals.tokens).cast("bigint").alias("train_tokens"),
            *SUMS[1:],
        )
    )


def op11_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
