"""Conversation structure repair by prefix-doubling path ranking (operator 12).

A repaired conversation has the roles ``(system? (user assistant)+)?``. A node is a place
between rows and a state of that pattern; edits are arcs: Keep, Rerole and Delete pass a row,
Insert does not. A cost DP finds the arcs of cheapest paths. Those are ranked by the audit
letters of their next 1, 2, 4, ... edits: the rank for twice the length is that of the pair of
an arc's own rank and the rank of the node where its half ends, and pointers to that node
double with it. The ranks choose each node's arc, the pointers lay out the least path.

Conversations are cut into blocks of rows. A block's costs are a 4 x 4 matrix, joined with the
blocks behind it by doubling; then each block ranks its own arcs for each state it may be
entered in, and the states are settled by doubling again. No step but the last sees more of a
conversation than a block; the last streams its rows in order, as a hash of them must.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import stored, table

#: Rows of a block at most; divides the numbers that a partition gives its rows.
BLOCK = 1 << 11
#: Padded places whose arcs are ranked at once.
PLACES = 1 << 17
FAR = 1 << 40
CONV = ["none", "c"]
SPACES = " \\t\\n\\u000B\\f\\r"

# States are begin, after system, after user, after assistant.
STATES = 4
REROLE = [2, 2, 3, 2]  # also where Insert leads
KEPT = {"s": [1, -1, -1, -1], "u": [2, 2, -1, 2], "a": [-1, -1, 3, -1], "": [-1, -1, -1, -1]}
ACCEPT = [0, 4, 2, 0]  # cheapest insertions from a state to the end
TAIL = ["", "II", "I", ""]
ROLES = {2: "user", 3: "assistant"}
DELETE, INSERT, KEEP, RELABEL = 1, 2, 3, 4  # in the order of their letters
LETTERS = np.array(["", "D", "I", "K", "R"])
RULE_COST = {DELETE: 3, INSERT: 2, KEEP: 0, RELABEL: 2}
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
CLASSES = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _tables() -> tuple[np.ndarray, ...]:
    """Per code, a role's class times four plus a fault: where Keep leads, and the costs of
    passing the row by each edit."""
    keep = np.full((16, STATES), -1)
    cost = np.full((5, 16, STATES), FAR)
    for code in range(16):
        kind, fault = divmod(code, 4)
        cost[DELETE, code] = RULE_COST[DELETE]
        if fault in (BLANK, DUPLICATE):
            continue
        open_end = int(fault == TRUNCATED)
        keep[code] = KEPT[CLASSES[kind : kind + 1]]
        cost[KEEP, code][keep[code] >= 0] = RULE_COST[KEEP] + open_end
        cost[RELABEL, code] = RULE_COST[RELABEL] + open_end
    return keep, cost


KEEP_TO, COSTS = _tables()
MOVES = {
    DELETE: np.broadcast_to(np.arange(STATES), (16, STATES)),
    KEEP: np.maximum(KEEP_TO, 0),
    RELABEL: np.broadcast_to(np.array(REROLE), (16, STATES)),
}


def _inserted(costs: np.ndarray) -> np.ndarray:
    """Costs to the end when rows may also be inserted here."""
    for _ in range(STATES - 1):
        costs = np.minimum(costs, RULE_COST[INSERT] + costs[..., REROLE])
    return costs


def _before(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end before rows of the given codes, from those after them."""
    best = np.full(after.shape, FAR)
    for edit, to in MOVES.items():
        ahead = np.take_along_axis(after, to[codes], axis=-1)
        best = np.minimum(best, COSTS[edit][codes] + ahead)
    return _inserted(best)


def _chunks(codes: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of like length: their numbers, lengths, and padded codes."""
    length = np.fromiter(map(len, codes), np.int64, len(codes))
    order = np.argsort(-length, kind="stable")
    while len(order):
        n = max(1, PLACES // (int(length[order[0]]) + 1))
        some, order = order[:n], order[n:]
        padded = np.zeros((len(some), int(length[some[0]])), np.int64)
        for row, k in enumerate(some):
            padded[row, : length[k]] = [int(c, 16) for c in codes[k]]
        yield some, length[some], padded


def matrices(codes: list[str]) -> np.ndarray:
    """Per block the cheapest cost from each state before it to each state after it."""
    out = np.empty((len(codes), STATES, STATES), np.int64)
    for some, length, padded in _chunks(codes):
        # one column of the matrix per state that may come after
        after = np.full((len(some), STATES, STATES), FAR)
        after[:, np.arange(STATES), np.arange(STATES)] = 0
        for i in reversed(range(padded.shape[1])):
            inside = i < length
            shape = (int(inside.sum()), STATES)
            row = np.broadcast_to(padded[inside, i, None], shape)
            after[inside] = _before(row, after[inside])
        out[some] = after.transpose(0, 2, 1)
    return np.minimum(out, FAR)


def least_paths(codes: list[str], after: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Per block and state before it: cost to the end, state after it, audit letters.

    ``after`` are the costs to the end behind each block.
    """
    costs = np.empty((len(codes), STATES), np.int64)
    exits = np.empty((len(codes), STATES), np.int64)
    audits: list[list[str]] = [[] for _ in codes]
    for some, length, padded in _chunks(codes):
        n, most = padded.shape
        cost = np.repeat(after[some][:, None], most + 1, axis=1)
        for i in reversed(range(most)):
            inside = i < length
            cost[inside, i] = _before(padded[inside, i], cost[inside, i + 1])
        path, letter = _ranked(cost, length, padded)
        costs[some] = cost[:, 0]
        exits[some] = (path[:, -1] % STATES).reshape(n, STATES)
        for row, text in enumerate(LETTERS[letter[path]]):
            audits[some[row // STATES]].append("".join(text))
    return costs, exits, audits


def _ranked(cost: np.ndarray, length: np.ndarray, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least paths from the nodes before each block, and the letter chosen at each node."""
    n, most = padded.shape
    node = np.arange(n * (most + 1) * STATES).reshape(n, most + 1, STATES)
    inside = np.arange(most)[None, :, None] < length[:, None, None]
    here, ahead = cost[:, :-1], cost[:, 1:]
    arcs = []
    for edit, to in MOVES.items():
        cheap = COSTS[edit][padded] + np.take_along_axis(ahead, to[padded], axis=2) == here
        target = np.take_along_axis(node[:, 1:], to[padded], axis=2)
        arcs.append((edit, cheap & inside, target))
    cheap = RULE_COST[INSERT] + here[..., REROLE] == here
    arcs.append((INSERT, cheap & inside, node[:, :-1][..., REROLE]))
    source = np.concatenate([node[:, :-1][ok] for _, ok, _ in arcs])
    end = np.concatenate([target[ok] for _, ok, target in arcs])
    letter = np.concatenate([np.full(int(ok.sum()), edit) for edit, ok, _ in arcs])
    path = node[:, 0].reshape(-1, 1)
    rank, chosen = letter, np.zeros(node.size, np.int64)
    while True:
        order = np.lexsort((rank, source))
        first = order[np.r_[True, np.diff(source[order]) > 0]] if len(order) else order
        node_rank, reached = np.zeros(node.size, np.int64), np.arange(node.size)
        node_rank[source[first]] = rank[first]
        reached[source[first]] = end[first]
        chosen[source[first]] = letter[first]
        path = np.concatenate((path, reached[path]), axis=1)
        if not node_rank[path[:, -1]].any():
            return path, chosen
        _, rank = np.unique(rank * (node_rank.max() + 1) + node_rank[end], return_inverse=True)
        rank, end = rank + 1, reached[end]


# ---------------------------------------------------------------------------- rows in Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the query plants, by a checksum of ``conv_id:turn``."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(named("role")).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.regexp_replace(named("text"), "[.!?]", ""))
        .otherwise(named("text"))
        .alias("text"),
        fault.alias("fault"),
    ).where("fault <> 0")
    copies = F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int")))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``place``, which grows along each conversation, and ``code``."""
    trimmed = F.expr(f"trim(TRAILING '{SPACES}' FROM text)")
    named = stored(
        rows.select(
            F.col("conv_id").isNull().alias("none"),
            F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("c"),
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "conversation-rows",
    )
    key = [*CONV, "turn", "role", F.xxhash64("text"), "row"]
    placed = stored(
        named.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select(
            *CONV,
            "turn",
            "role",
            "text",
            F.monotonically_increasing_id().alias("place"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.when(trimmed == "", BLANK)
            .when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), FINE)
            .otherwise(TRUNCATED)
            .alias("fault"),
        ),
        "placed-rows",
    )
    first = placed.groupBy(*CONV, "role", "digest").agg(F.min("place").alias("place"))
    fault = (
        F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE)
        .otherwise(F.col("fault"))
    )
    kind = F.instr(F.lit(CLASSES), F.substring("role", 1, 1)) - 1
    kind = F.when(F.substring("role", 1, 1) == "", 3).when(kind < 0, 3).otherwise(kind)
    seen = first.select("place", F.lit(True).alias("first"))
    return stored(
        placed.join(seen, "place", "left").select(
            *CONV, "turn", "role", "text", "place", F.lower(F.hex(kind * 4 + fault)).alias("code")
        ),
        "coded-rows",
    )


def _product(a: Column, b: Column) -> Column:
    """Cheapest ways through two 4 x 4 matrices, held as arrays of 16."""
    cell = lambda e: F.array_min(
        F.array(F.lit(FAR), *[F.get(a, e - e % 4 + k) + F.get(b, e % 4 + 4 * k) for k in range(STATES)])
    )
    return F.transform(F.sequence(F.lit(0), F.lit(15)), cell)


def _joined(blocks: DataFrame, column: str, join, step: int) -> DataFrame:
    """Combine each block's ``column`` with that of the block ``step`` places on, by doubling,
    until it covers all blocks in that direction."""
    longest = blocks.agg(F.max("n")).first()[0] or 0
    now, reach = blocks, 1
    while reach < longest:
        other = now.select(
            *CONV, (F.col("number") - step * reach).alias("number"), F.col(column).alias("other")
        )
        whole = F.when(F.col("other").isNull(), F.col(column)).otherwise(join(F.col(column), F.col("other")))
        now = stored(
            now.join(other, [*CONV, "number"], "left").withColumn(column, whole).drop("other"), "doubled"
        )
        reach *= 2
    return now


def _blocks(coded: DataFrame) -> DataFrame:
    """One row per block: ``slab`` and its codes, its ``number`` of ``n`` in the conversation,
    and the costs behind it."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "code")))
    letters = F.array_join(F.transform(ordered, lambda r: r["code"]), "")
    whole = Window.partitionBy(*CONV)
    blocks = stored(
        coded.groupBy(*CONV, F.expr(f"place div {BLOCK}").alias("slab"))
        .agg(letters.alias("codes"))
        .withColumns({"number": F.row_number().over(whole.orderBy("slab")), "n": F.count("*").over(whole)}),
        "blocks",
    )

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = matrices(batch["codes"].to_pylist()).reshape(-1, STATES * STATES)
            kept = [batch[c] for c in (*CONV, "number", "n")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(list(flat), pa.list_(pa.int64()))], names=[*CONV, "number", "n", "costs"]
            )

    behind = (
        blocks.where("n > 1")
        .select(*CONV, "number", "n", "codes")
        .mapInArrow(costs, "none boolean, c bigint, number int, n bigint, costs array<bigint>")
    )
    behind = _joined(stored(behind, "block-costs"), "costs", _product, 1)
    end = F.array(*[F.lit(x).cast("bigint") for x in ACCEPT])
    into = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda s: F.array_min(F.array(*[F.get("costs", s * 4 + k) + ACCEPT[k] for k in range(STATES)])),
    )
    behind = behind.select(*CONV, (F.col("number") - 1).alias("number"), into.alias("after"))
    return blocks.join(behind, [*CONV, "number"], "left").withColumn("after", F.coalesce("after", end))


def _chosen(blocks: DataFrame) -> DataFrame:
    """``slab, state, audit, cost`` of each block on the least path of its conversation."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = np.array(batch["after"].to_pylist(), np.int64).reshape(-1, STATES)
            costs, exits, audits = least_paths(batch["codes"].to_pylist(), after)
            kept = [batch[c] for c in (*CONV, "slab", "number", "n")]
            found = [
                pa.array(list(costs), pa.list_(pa.int64())),
                pa.array(list(exits), pa.list_(pa.int64())),
                pa.array(audits, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(
                [*kept, *found], names=[*CONV, "slab", "number", "n", "costs", "exits", "audits"]
            )

    schema = (
        "none boolean, c bigint, slab bigint, number int, n bigint, costs array<bigint>, "
        "exits array<bigint>, audits array<string>"
    )
    found = stored(
        blocks.select(*CONV, "slab", "number", "n", "codes", "after").mapInArrow(paths, schema), "paths"
    )
    follow = lambda later, earlier: F.transform(earlier, lambda s: F.get(later, s.cast("int")))
    entered = _joined(found.where("n > 1").select(*CONV, "number", "n", "exits"), "exits", follow, -1)
    entered = entered.select(
        *CONV, (F.col("number") + 1).alias("number"), F.get("exits", F.lit(0)).cast("int").alias("state")
    )
    whole = found.join(entered, [*CONV, "number"], "left").withColumn("state", F.coalesce("state", F.lit(0)))
    tail = F.get(F.array(*map(F.lit, TAIL)), F.get("exits", F.col("state")).cast("int"))
    return whole.select(
        *CONV,
        "slab",
        "state",
        F.concat(F.get("audits", F.col("state")), F.when(F.col("number") == F.col("n"), tail).otherwise("")).alias("audit"),
        F.when(F.col("number") == 1, F.get("costs", F.lit(0))).alias("cost"),
    )


class _Report:
    """Counts, audit and hash of one conversation, from its rows in order."""

    def __init__(self) -> None:
        self.faults, self.illegal, self.turns = [0] * 4, 0, 0
        self.low = self.high = self.kind = None
        self.cost, self.audit, self.lines = 0, [], 0
        self.hash = hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def block(self, state: int, audit: str, cost: int | None) -> None:
        self.close()
        self.edits, self.state = iter(audit), state
        self.audit.append(audit)
        self.cost += cost or 0

    def insert(self) -> None:
        self.state = REROLE[self.state]
        self.line(ROLES[self.state], "")

    def row(self, turn: int | None, role: str, text: str, code: int) -> None:
        kind, fault = divmod(code, 4)
        self.faults[fault] += 1
        self.illegal += self.kind is not None and (self.kind, kind) not in LEGAL
        self.kind = kind
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        while (edit := next(self.edits)) == "I":
            self.insert()
        if edit == "K":
            self.state = int(KEEP_TO[code, self.state])
            self.line(role, text)
        elif edit == "R":
            self.state = REROLE[self.state]
            self.line(ROLES[self.state], text)

    def close(self) -> None:
        """Insertions behind the last row."""
        for _ in getattr(self, "edits", ()):
            self.insert()

    def result(self) -> tuple:
        self.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = [self.faults[k] for k in (BLANK, DUPLICATE, TRUNCATED)]
        return (gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
REPORT = [*COUNTS, "audit", "repaired_sha256"]


def _reports(coded: DataFrame, chosen: DataFrame) -> DataFrame:
    """Stream each conversation's rows behind the edits of their block."""
    nothing = lambda kind: F.lit(None).cast(kind)
    rows = coded.select(
        *CONV,
        F.expr(f"place div {BLOCK}").alias("slab"),
        "place",
        "turn",
        "role",
        "text",
        F.conv("code", 16, 10).cast("int").alias("code"),
        nothing("bigint").alias("cost"),
    )
    edits = chosen.select(
        *CONV,
        "slab",
        nothing("bigint"),
        nothing("bigint"),
        nothing("string"),
        "audit",
        F.col("state"),
        "cost",
    )
    # a block's edits have no place, which sorts before its rows
    key = [*CONV, "slab", "place"]
    stream = rows.union(edits).repartition(*CONV).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, report, done = None, None, []
        for batch in batches:
            for none, c, _, place, turn, role, text, code, cost in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (none, c) != current:
                    if report:
                        done.append((*current, *report.result()))
                    current, report = (none, c), _Report()
                if place is None:
                    report.block(code, text, cost)
                else:
                    report.row(turn, role, text, code)
            yield _batch(done)
            done = []
        yield _batch([(*current, *report.result())] if report else [])

    kinds = ["none boolean", "c bigint", *[f"{c} bigint" for c in COUNTS], "audit string", "repaired_sha256 string"]
    return stream.mapInArrow(run, ", ".join(kinds))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[*CONV, *REPORT]
    )


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``.

    Reads ``conv_id, turn, role, text``. Rows with a NULL id are one conversation. A NULL role
    or text is one space: such a role can only be replaced, such a text is blank. A role that
    is empty or begins with another letter than s, u or a cannot be kept either. Rows go by
    turn, NULL first; rows of one turn by role and a hash of the text, so only equal rows are
    interchangeable. A repeated row is a duplicate. Texts may be of any length; no rows, no
    result.

    Until the last step a task sees blocks of rows, codes of one letter per row and no text.
    The last step reads a conversation's rows one by one in one task, because their hash is
    defined in order; it holds the letters of the audit and nothing else that grows.
    """
    coded = _ordered(rows)
    found = _reports(coded, _chosen(_blocks(coded)))
    return found.select(F.when(~F.col("none"), F.col("c")).alias("conv_id"), *REPORT)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Reports on the damaged rows for every ``conv_id`` of the table, also if no row is left:
    its counts are 0, its audit and the hashed text are empty."""
    every = conversations.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    found = repaired(damaged(conversations))
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


#: The same by plain recursion from the back, one state's cheapest and least edits at a time.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(split(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, k: xor(x >> 1, (x % 2) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 20 AS h
  FROM conversations
), e AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) WHERE h <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed, left(role, 1) AS kind
  FROM e
), p AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
    lag(kind) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM o
), q AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND earlier || kind NOT IN ('su', 'ua', 'au')) AS illegal
  FROM p GROUP BY conv_id
), f AS (
  SELECT conv_id, n AS i, [{'c': 0, 'a': '', 'r': []::VARCHAR[]}, {'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']},
    {'c': 2, 'a': 'I', 'r': ['assistant:']}, {'c': 0, 'a': '', 'r': []::VARCHAR[]}] AS f FROM q
  UNION ALL
  SELECT conv_id, i, [least(f[1], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)}),
    least(f[2], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)}),
    least(f[3], {'c': 2 + f[4].c, 'a': 'I' || f[4].a, 'r': list_prepend('assistant:', f[4].r)}),
    least(f[4], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)})] AS f
  FROM (
  SELECT conv_id, i, [least(f[1], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)}),
    least(f[2], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)}),
    least(f[3], {'c': 2 + f[4].c, 'a': 'I' || f[4].a, 'r': list_prepend('assistant:', f[4].r)}),
    least(f[4], {'c': 2 + f[3].c, 'a': 'I' || f[3].a, 'r': list_prepend('user:', f[3].r)})] AS f
  FROM (
  SELECT f.conv_id, f.i - 1 AS i, list_transform([1, 2, 3, 4], lambda s: list_sort(list_filter([
    {'c': f.f[s].c + 3, 'a': 'D' || f.f[s].a, 'r': f.f[s].r},
    CASE WHEN fault IN ('fine', 'truncated') AND [kind IN ('s', 'u'), kind = 'u', kind = 'a', kind = 'u'][s] THEN
      {'c': f.f[CASE kind WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + (fault = 'truncated')::INTEGER,
       'a': 'K' || f.f[CASE kind WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a,
       'r': list_prepend(role || ':' || text, f.f[CASE kind WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].r)} END,
    CASE WHEN fault IN ('fine', 'truncated') THEN
      {'c': f.f[[3, 3, 4, 3][s]].c + 2 + (fault = 'truncated')::INTEGER, 'a': 'R' || f.f[[3, 3, 4, 3][s]].a,
       'r': list_prepend(CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || text, f.f[[3, 3, 4, 3][s]].r)} END
    ], lambda x: x IS NOT NULL))[1]) AS f
  FROM f JOIN p ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i
  ))
)
SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f.f[1].c, 0)::BIGINT AS cost,
  coalesce(f.f[1].a, '') AS audit, sha256(coalesce(array_to_string(f.f[1].r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x
LEFT JOIN q ON x.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN f ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = 0
"""
