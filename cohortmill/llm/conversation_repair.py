"""Repair of conversation structure at least cost: deletions, changes of role and insertions that leave an optional
system turn and pairs of user and assistant, or nothing.

**Cells.** Turns are put in the order of ``turn`` (nulls first; ties by role, then by the SHA-256 of the text). Equal turns
are one cell with a count. Of a cell only the first copy can be new; the others repeat it and go. A text that stands
earlier in the conversation under the same role makes its cell a repetition, too, found by one aggregation per (role, text).

**Symbols.** A turn is one of nine symbols: role s, u, a or other, whole or truncated, or *gone* (blank or repeated). The
states are those of the grammar: start, after s, after u, after a. A symbol is a 4 x 4 matrix of least costs (min-plus),
any insertions in front included. Equal consecutive symbols are a run, and a run of n takes a vector of costs to the end
through the binary powers of its matrix, which are computed once per worker.

**Blocks.** A conversation is cut into blocks of ``SPAN`` cells. One block is the usual case. Of a longer conversation each
block becomes one matrix; a scan over these, one row per block, gives the costs behind every block, then the blocks' maps
of states, scanned forwards, give the state each one begins in. So no task holds more than one block, whatever the share
of a conversation, and the scan reads one row per ``SPAN`` cells.

**Audit.** From the state and the costs behind it, each row takes the edit with the least letter among those of least cost
(D, I, K, R: ASCII order); insertions are taken where they are due. States and letters determine each other, so this is the
least string. The repaired rows follow: kept texts are joined to their decisions and hashed in order. SHA-256 is
sequential by its definition, so the bytes of one conversation pass one task, as a stream of pieces of bounded size.

Defined cases: a null role or text is one space; a null ``conv_id`` is a conversation; a conversation without rows has cost
0, an empty audit and the hash of nothing; an empty table gives an empty result; a role's first letter decides, so an empty
role is an other role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortmill.llm.batches import row_batches, started_runs
from cohortmill.llm.ranks import in_blocks, placed
from cohortmill.llm.staging import prepare, staged

SPAN = 1 << 14
PIECE = 1 << 16

# White space of the rules, costs of the edits, states and the roles that lead to them.
SPACE = " \t\n\x0b\x0c\r"
CHANGE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
GONE = 8
_NEVER = 1 << 60


def symbol(initial: str, truncated: bool) -> int:
    return "sua".find(initial or "?") % 4 + 4 * truncated


def edits(sym: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of one row: (letter, cost, state behind it), in the order of the letters."""
    found = []
    for state in range(4):
        own = [("D", DELETE, state)]
        if sym != GONE:
            role, more = sym % 4, TRUNCATED * (sym >= 4)
            kept = {0: SYSTEM, 1: USER, 2: ASSISTANT}.get(role)
            if kept == NEXT[state] or (kept == SYSTEM and state == START):
                own.append(("K", more, kept))
            own.append(("R", CHANGE + more, NEXT[state]))
        found.append(own)
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of two matrices, or of a matrix and a vector."""
    return np.minimum((a[:, :, None] + b[None] if b.ndim == 2 else a + b).min(axis=1), _NEVER)


@cache
def insertions() -> np.ndarray:
    """Least costs between states by insertions alone."""
    costs = np.full((4, 4), _NEVER)
    np.fill_diagonal(costs, 0)
    for state, after in NEXT.items():
        costs[state, after] = INSERT
    for _ in range(2):
        costs = product(costs, costs)
    return costs


@cache
def power(sym: int, bit: int) -> np.ndarray:
    """The transition of 2 ** bit rows of one symbol."""
    if bit:
        return product(power(sym, bit - 1), power(sym, bit - 1))
    row = np.full((4, 4), _NEVER)
    for state, own in enumerate(edits(sym)):
        for _, cost, after in own:
            row[state, after] = min(row[state, after], cost)
    return product(insertions(), row)


def advanced(sym: int, n: int, behind: np.ndarray) -> np.ndarray:
    """The transition of a run of ``n`` rows in front of ``behind`` (a vector of costs, or a matrix)."""
    bit = 0
    while n >> bit:
        if n >> bit & 1:
            behind = product(power(sym, bit), behind)
        bit += 1
    return behind


@cache
def final() -> tuple[int, ...]:
    """Costs at the end of a conversation: the empty one and those that end on the assistant are whole."""
    accepted = np.array([0, _NEVER, _NEVER, 0])
    return tuple(product(insertions(), accepted).tolist())


@cache
def step(sym: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of one row, from the costs behind it."""
    return tuple(product(power(sym, 0), np.array(behind)).tolist())


@cache
def choice(sym: int, behind: tuple[int, ...], state: int) -> tuple[str, int, tuple[str, ...], str | None]:
    """(letters, next state, roles inserted in front, new role or None if kept or deleted) of one row."""
    ahead, letters, inserted = step(sym, behind), "", []
    while True:
        options = {letter: (cost + behind[after], after) for letter, cost, after in edits(sym)[state]}
        options["I"] = INSERT + ahead[NEXT[state]], NEXT[state]
        letter = min(x for x in options if options[x][0] == ahead[state])
        letters, state = letters + letter, options[letter][1]
        if letter != "I":
            return letters, state, tuple(inserted), NAMES[state] if letter == "R" else None
        inserted.append(NAMES[state])


def _lowered(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs without their common part, which no choice depends on: few different vectors are left."""
    least = min(costs)
    return tuple(c - least for c in costs)


def runs_of(cells: Iterator[tuple[int, int]]) -> list[list[int]]:
    """[symbol, length] of the runs of (first copy's symbol, copies)."""
    found: list[list[int]] = []
    for sym, n in cells:
        for own, times in ((sym, 1), (GONE, n - 1)) if sym != GONE else ((GONE, n),):
            if times and found and found[-1][0] == own:
                found[-1][1] += times
            elif times:
                found.append([own, times])
    return found


def cost_ahead(cells: list[tuple[int, int]], behind: np.ndarray) -> np.ndarray:
    for sym, n in reversed(runs_of(iter(cells))):
        behind = advanced(sym, n, behind)
    return behind


def behind_each(cells: list[tuple[int, int]], behind: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs behind the first copy of each cell, without their common part."""
    found, now = [], _lowered(behind)
    for sym, n in reversed(cells):
        gone = n - (sym != GONE)
        # All that is deleted adds the same to each state: the run's transition changes no choice in front of it.
        if gone:
            now = _lowered(tuple(advanced(GONE, gone, np.array(now)).tolist()))
        found.append(now)
        if sym != GONE:
            now = _lowered(step(sym, now))
    return found[::-1]


def unrolled(cells: list[tuple[int, int]], behind: tuple[int, ...], state: int) -> tuple[list[tuple], int]:
    """(letters, roles inserted in front, new role) of each cell, and the state behind the last one.

    What must go is deleted before anything is inserted: D is the least letter, and an insertion can wait at no cost.
    """
    found = []
    for (sym, n), after in zip(cells, behind_each(cells, behind), strict=True):
        if sym == GONE:
            found.append(("D" * n, (), None))
            continue
        letters, state, inserted, role = choice(sym, after, state)
        found.append((letters + "D" * (n - 1), inserted, role))
    return found, state


def closing(state: int) -> tuple[str, ...]:
    """Roles to insert at the end."""
    found = []
    while state not in (START, ASSISTANT):
        state = NEXT[state]
        found.append(NAMES[state])
    return tuple(found)


# Spark side

KEY = ["conv", "has_turn", "turn_no", "role", "mark"]


def _normal(turns: DataFrame, copies: Column | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    return turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("conv"), F.col(conv_col).alias("conv_id"),
        F.col(turn_col).isNotNull().alias("has_turn"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn_no"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("mark"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )


def cells_of(turns: DataFrame) -> DataFrame:
    """One row per distinct turn (``KEY``): copies, blank, truncated, and whether its first copy is new."""
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    cells = staged(
        turns.select(*KEY, "copies", (end == "").alias("blank"), (~end.isin("", ".", "!", "?")).alias("truncated"))
        .where("copies > 0").groupBy(*KEY)
        .agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated")), "cells")
    new = cells.where("not blank").groupBy("conv", "role", "mark").agg(F.min(F.struct("has_turn", "turn_no")).alias("at")).select(
        "conv", "at.*", "role", "mark", F.lit(0).cast("long").alias("copies"), F.lit(False).alias("blank"),
        F.lit(False).alias("truncated"), F.lit(True).alias("new"))
    return cells.withColumn("new", F.lit(False)).unionByName(new).groupBy(*KEY).agg(
        F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("blank", "truncated", "new")])


def _cells(run: pa.Table) -> list[tuple[int, int]]:
    columns = [run.column(c).to_pylist() for c in ("role", "truncated", "new", "copies")]
    return [(symbol(role[:1], truncated) if new else GONE, n) for role, truncated, new, n in zip(*columns, strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.Table]:
    return started_runs(batches, lambda b: b.column("place").to_numpy() % span == 0)


def _scanned(long: DataFrame, span: int) -> DataFrame:
    """(conv, block, costs, state) of the blocks of conversations of several blocks: the costs behind each block, and the
    state it begins in."""
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = np.full((4, 4), _NEVER)
        np.fill_diagonal(identity, 0)
        rows = ((run.column("conv")[0].as_py(), run.column("block")[0].as_py(), cost_ahead(_cells(run), identity).ravel().tolist())
                for run in _blocks(batches, span))
        yield from row_batches(rows, ["conv", "block", "costs"], [pa.string(), pa.int64(), pa.list_(pa.int64())])

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, costs = None, None
            for batch in batches:
                for own, block, matrix in zip(*[batch.column(c).to_pylist() for c in ("conv", "block", "costs")], strict=True):
                    if own != conv:
                        conv, costs = own, np.array(final())
                    yield conv, block, costs.tolist()
                    costs = product(np.array(matrix).reshape(4, 4), costs)

        yield from row_batches(rows(), ["conv", "block", "costs"], [pa.string(), pa.int64(), pa.list_(pa.int64())])

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _blocks(batches, span):
                costs, cells = run.column("costs")[0].as_py(), _cells(run)
                ends = [unrolled(cells, tuple(costs), state)[1] for state in range(4)]
                yield run.column("conv")[0].as_py(), run.column("block")[0].as_py(), costs, ends

        names = ["conv", "block", "costs", "ends"]
        yield from row_batches(rows(), names, [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())])

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, state = None, START
            for batch in batches:
                for own, block, costs, ends in zip(*[batch.column(c).to_pylist() for c in ("conv", "block", "costs", "ends")], strict=True):
                    if own != conv:
                        conv, state = own, START
                    yield conv, block, costs, state
                    state = ends[state]

        names = ["conv", "block", "costs", "state"]
        yield from row_batches(rows(), names, [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32()])

    shape = "conv string, block long, costs array<bigint>"
    found = in_blocks(long, "conv", span, "place").mapInArrow(matrices, shape)
    costs = staged(found.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInArrow(backwards, shape), "costs")
    blocks = long.withColumn("block", F.expr(f"place div {span}")).join(costs, ["conv", "block"])
    ends = in_blocks(blocks, "conv", span, "place").mapInArrow(maps, shape + ", ends array<int>")
    return staged(
        ends.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(forwards, shape + ", state int"), "states")


def decided(cells: DataFrame, span: int = SPAN) -> DataFrame:
    """What happens to the cells: rows of kind 0, one per block (audit, cost from its first row on, illegal neighbours, first
    and last initial), and of kind 1, one per cell that is kept or has insertions (role: null if deleted)."""
    cells = staged(placed(cells, "conv", KEY[1:], "cells-placed"), "cells-in-order")
    # Only conversations of several blocks need the scans.
    scanned = _scanned(cells.where(F.col("n") > span), span)
    known = cells.withColumn("block", F.expr(f"place div {span}")).join(scanned, ["conv", "block"], "left")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _blocks(batches, span):
                conv, block, n = (run.column(c)[0].as_py() for c in ("conv", "block", "n"))
                behind, state = run.column("costs")[0].as_py(), run.column("state")[0].as_py()
                behind, state = (final(), START) if behind is None else (tuple(behind), state)
                own = _cells(run)
                cost = int(cost_ahead(own, np.array(behind))[state])
                edited, end = unrolled(own, behind, state)
                keys = [run.column(c).to_pylist() for c in [*KEY[1:], "place"]]
                last = closing(end) if keys[-1][-1] == n - 1 else ()
                audit = "".join(letters for letters, _, _ in edited) + "I" * len(last)
                initials = [role[:1] for role in keys[2]]
                illegal = sum(copies - 1 for _, copies in own) + sum(
                    a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
                yield 0, conv, block, audit, cost, illegal, initials[0], initials[-1], *[None] * 8
                for k, ((letters, inserted, new_role), has, no, role, mark, place) in enumerate(zip(edited, *keys, strict=True)):
                    to = new_role or (role if "K" in letters else None)
                    after = last if k == len(own) - 1 else ()
                    if to is not None or inserted or after:
                        yield 1, conv, block, None, None, None, None, None, has, no, role, mark, place, to, list(inserted), list(after)

        yield from row_batches(rows(), names, types)

    shape = ("kind int, conv string, block long, audit string, cost long, illegal long, first string, last string, "
             "has_turn boolean, turn_no long, role string, mark binary, place long, to string, ahead array<string>, after array<string>")
    names = [part.split()[0] for part in shape.split(", ")]
    texts = pa.list_(pa.string())
    types = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(),
             pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), texts, texts]
    return staged(in_blocks(known, "conv", span, "place").mapInArrow(decide, shape), "decided")


def repaired_rows(turns: DataFrame, decisions: DataFrame) -> DataFrame:
    """The repaired conversations: (conv, place, nth, role, text), in the order of place and nth."""
    texts = turns.where("copies > 0").groupBy(*KEY).agg(F.first("text").alias("text"))
    kept = decisions.where("kind = 1").select(*KEY, "place", "to", "ahead", "after").join(texts, KEY)

    def added(roles: str) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.filter(F.array(F.struct(F.col("to").alias("role"), "text")), lambda r: r["role"].isNotNull())
    rows = kept.select("conv", "place", F.posexplode(F.concat(added("ahead"), own, added("after"))).alias("nth", "row"))
    return rows.select("conv", "place", "nth", "row.role", "row.text")


def digests(rows: DataFrame, span: int = 1024) -> DataFrame:
    """(conv, repaired_sha256) of all repaired conversations: SHA-256 of their ``role:text``, newline-joined.

    Conversations are put together in stretches of ``span`` places; one that fits a stretch is hashed there. Of longer ones
    the stretches go on as pieces of at most ``PIECE`` bytes, hashed as a stream in order.
    """
    ends = rows.groupBy("conv").agg(F.max("place").alias("last"), F.min("place").alias("first"))
    whole = F.expr(f"last div {span} = first div {span}").alias("whole")
    rows = rows.join(ends.select("conv", whole), "conv")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stretched() -> Iterator[tuple]:
            key, held, hashed, nth, whole = None, bytearray(), None, 0, True

            def ended() -> Iterator[tuple]:
                if key is not None:
                    yield (*key, nth, hashed.hexdigest() if whole else None, None if whole else bytes(held))

            for batch in batches:
                for conv, block, own_whole, role, text in zip(
                        *[batch.column(c).to_pylist() for c in ("conv", "block", "whole", "role", "text")], strict=True):
                    if (conv, block) != key:
                        yield from ended()
                        key, held, hashed, nth, whole = (conv, block), bytearray(), hashlib.sha256(), 0, own_whole
                        line = f"{role}:{text}"
                    else:
                        line = f"\n{role}:{text}"
                    if whole:
                        hashed.update(line.encode())
                        continue
                    held += line.encode()
                    while len(held) > PIECE:
                        yield *key, nth, None, bytes(held[:PIECE])
                        nth, held = nth + 1, held[PIECE:]
            yield from ended()

        yield from row_batches(stretched(), names, types, 256)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def streamed() -> Iterator[tuple]:
            conv, at, hashed = None, None, None
            for batch in batches:
                for own, block, piece in zip(*[batch.column(c).to_pylist() for c in ("conv", "block", "piece")], strict=True):
                    if own != conv:
                        if conv is not None:
                            yield conv, hashed.hexdigest()
                        conv, at, hashed = own, block, hashlib.sha256()
                    if block != at:
                        hashed.update(b"\n")
                        at = block
                    hashed.update(piece)
            if conv is not None:
                yield conv, hashed.hexdigest()

        yield from row_batches(streamed(), ["conv", "repaired_sha256"], [pa.string(), pa.string()])

    names, types = ["conv", "block", "nth", "repaired_sha256", "piece"], [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary()]
    pieces = staged(in_blocks(rows, "conv", span, "place", "nth").mapInArrow(
        stretches, "conv string, block long, nth int, repaired_sha256 string, piece binary"), "pieces")
    long = pieces.where("piece is not null").repartition("conv").sortWithinPartitions("conv", "block", "nth")
    return pieces.where("piece is null").select("conv", "repaired_sha256").union(
        long.mapInArrow(joined, "conv string, repaired_sha256 string"))


def repair(turns: DataFrame, copies: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(report, rows): per conversation the faults, the cost, the audit and the digest of its repair; and the repaired rows.

    ``copies`` says how often a row counts (0: it is not there, its conversation is); default 1. The report has conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; the rows conv_id, place, nth, role, text.
    """
    prepare(turns.sparkSession)
    turns = _normal(turns, copies, conv_col, turn_col, role_col, text_col)
    cells = staged(cells_of(turns), "cells-marked")
    decisions = decided(cells, span)
    rows = staged(repaired_rows(turns, decisions), "repaired")

    ids = turns.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    new = F.col("new").cast("long")
    faults = cells.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - new)).alias("duplicate"),
        F.sum(F.when(F.col("truncated"), new).otherwise(0)).alias("truncated"))
    numbered = cells.where("has_turn").groupBy("conv", "turn_no").agg(F.lit(1)).groupBy("conv")
    gaps = numbered.agg((F.max("turn_no") - F.min("turn_no") + 1 - F.count("*")).alias("gaps"))
    in_order = Window.partitionBy("conv").orderBy("block")
    between = F.lag("last").over(in_order)
    summaries = decisions.where("kind = 0").select("conv", "block", "audit", "cost", (
        F.col("illegal") + F.coalesce(~F.concat(between, "first").isin("su", "ua", "au"), F.lit(False)).cast("long")).alias("illegal"))
    audits = summaries.groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), "").alias("audit"),
        F.min_by("cost", "block").alias("cost"), F.sum("illegal").alias("illegal"))
    report = ids.join(faults, "conv", "left").join(gaps, "conv", "left").join(audits, "conv", "left").join(
        digests(rows), "conv", "left")
    numbers = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    report = report.select(
        "conv_id", *numbers.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return report, rows.join(ids, "conv").select("conv_id", "place", "nth", "role", "text")
