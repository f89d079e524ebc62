"""Repair of conversation structure by weighted interval parsing.

A repaired conversation reads `(s?(ua)+)?` in the initials of its roles.  The grammar is in Chomsky
normal form: for two states p, q of the automaton of that language, the nonterminal pq derives
what leads from p to q, with the rules pq -> pr rq, pq -> one edited row, and pq -> insertions.
The cell of a span holds, per nonterminal, the least (cost, audit) over all repairs of its rows,
and cells are combined bottom-up by span length.  A derivation passes exactly one state between
two rows, so every split of a span gives the same minimum, and one split per span is enough:
spans double in length, n rows take n combinations and a block of rows is a cell like any other.
Blocks of a long conversation are parsed in different tasks and combined afterwards.

Of repairs with equal cost the audit that is least in ASCII order wins.  One audit of a span is
never the start of another one of the same cost (it would differ in insertions only), so least
audits of the parts make the least audit of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.places import in_order
from rollbook.sources.scratch import stored

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = ("su", "ua", "au")
BLOCK_BITS = 9  # rows of a block that is parsed at once
FOLD_BITS = 6  # cells of a conversation that are combined at once
GROUPS_AT_ONCE = 64

START, SYSTEM, USER, PAIRED = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIRED, (PAIRED, "u"): USER}
ROLE_FROM = {START: "user", SYSTEM: "user", USER: "assistant", PAIRED: "user"}
ACCEPTED = (START, PAIRED)

Cell = list  # of (cost, audit) or None per nonterminal


def _inserted() -> dict[tuple[int, int], int]:
    """The least insertions from state to state: the closure of the insertion rules."""
    best = {(p, p): 0 for p in range(4)}
    for _ in range(4):
        for (p, q), n in list(best.items()):
            r = STEP[q, ROLE_FROM[q][0]]
            best[p, r] = min(best.get((p, r), n + 1), n + 1)
    return best


INSERTED = _inserted()
# the nonterminals: a kept system row is the only way to its state, insertions connect the others
PAIRS = sorted({*INSERTED, (START, SYSTEM)})
_AT = {pair: k for k, pair in enumerate(PAIRS)}
# pq -> pr rq, as places: (pq, pr, rq)
RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, r in PAIRS for r2, q in PAIRS if r == r2]
EMPTY: Cell = [
    (COST[INSERT] * INSERTED[p], INSERT * INSERTED[p]) if p in INSERTED else None for p in PAIRS
]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out: Cell = [None] * len(PAIRS)
    for pq, pr, rq in RULES:
        a, b = left[pr], right[rq]
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], out[pq]
        if best is None or cost < best[0]:
            out[pq] = (cost, a[1] + b[1])
        elif cost == best[0]:
            audit = a[1] + b[1]
            if audit < best[1]:
                out[pq] = (cost, audit)
    return out


def _row_cell(initial: str, fault: int) -> Cell:
    """The cell of one row: an edit, with insertions before and after."""
    out: Cell = [None] * len(PAIRS)

    def offer(p: int, q: int, cost: int, audit: str):
        k = _AT[p, q]
        if out[k] is None or (cost, audit) < out[k]:
            out[k] = (cost, audit)

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for p in range(4):
        offer(p, p, COST[DELETE], DELETE)
        if fault not in (BLANK, DUPLICATE):
            if (p, initial) in STEP or not initial:  # an empty role has no initial
                offer(p, STEP.get((p, initial), p), COST[KEEP] + extra, KEEP)
            offer(p, STEP[p, ROLE_FROM[p][0]], COST[REROLE] + extra, REROLE)
    return combine(combine(EMPTY, out), EMPTY)


def parse(cells: list[Cell]) -> Cell:
    """The cell of a sequence of adjacent spans, bottom-up by span length."""
    while len(cells) > 1:
        paired = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = paired + cells[len(paired) * 2 :]
    return cells[0] if cells else EMPTY


def parse_rows(rows: list[tuple[str, int]]) -> Cell:
    """The cell of rows (initial of the role, fault); equal rows share their cell."""
    known: dict[tuple[str, int], Cell] = {}
    for row in rows:
        if row not in known:
            known[row] = _row_cell(*row)
    return parse([known[row] for row in rows])


def best(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the least repair."""
    return min(x for q in ACCEPTED if (x := cell[_AT[START, q]]) is not None)


def damaged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with the faults that crc32(conv_id:turn) % 20 names.

    0 drops a row, 1 empties its text, 2 removes sentence ends, 3 repeats it, 4 makes it the
    user's.  A null is one space in the key, the role and the text; null ids and turns stay null.
    """
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    key = F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = space(F.col("text"))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(space(F.col("role"))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    again = F.explode(F.array_repeat(F.lit(0), F.col("times")))
    return rows.select("conv_id", "turn", "role", "text", again.alias("times")).drop("times")


def _order(text: Column) -> list:
    """Columns in which the rows of a conversation stand; rows that agree in all are equal."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64(text), F.sha2(text.cast("binary"), 256)]


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, at, initial, fault) per row, stored, `at` being its place in the order of all.

    The fault is the first of blank, duplicate (role and text seen earlier in the conversation)
    and truncated (the last character that is no white space does not end a sentence).
    """
    text = F.col("text")
    closing = F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))
    rows = turns.select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64(text).alias("hash"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        (closing == "").alias("blank"),
        (~F.lit(ENDS).contains(closing)).alias("cut"),
    )
    rows = in_order(rows, "conv_id", F.col("turn").asc_nulls_first(), "role", "hash", "digest", name="turns")
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    first = first.select("at", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("cut"), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    # joined by place, so a row that is repeated very often is no hot key
    rows = rows.join(first, "at", "left")
    initial = F.left("role", F.lit(1)).alias("initial")
    return stored(rows.select("conv_id", "turn", "at", initial, fault.alias("fault")), "faults")


_CELL = "first string, last string, illegal long, costs array<long>, audits array<string>"


def _cell(span: dict) -> Cell:
    return [None if c is None else (c, a) for c, a in zip(span["costs"], span["audits"])]


def _joined(parts: list[tuple[str, str, int, Cell]]) -> tuple[str, str, int, Cell]:
    """Adjacent spans as one: their ends, pairs of neighbours that are not legal, and cell."""
    illegal = sum(p[2] for p in parts)
    illegal += sum(a[1] + b[0] not in LEGAL for a, b in zip(parts, parts[1:]))
    return parts[0][0], parts[-1][1], illegal, parse([p[3] for p in parts])


def _columns(spans: list[tuple[str, str, int, Cell]]) -> list[pa.Array]:
    cells = [[x if x else (None, None) for x in s[3]] for s in spans]
    return [
        pa.array([s[0] for s in spans], pa.string()),
        pa.array([s[1] for s in spans], pa.string()),
        pa.array([s[2] for s in spans], pa.int64()),
        pa.array([[c for c, _ in cell] for cell in cells], pa.list_(pa.int64())),
        pa.array([[a for _, a in cell] for cell in cells], pa.list_(pa.string())),
    ]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few groups, so that few are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, GROUPS_AT_ONCE):
            yield batch.slice(at, GROUPS_AT_ONCE)


def _blocks(faulty: DataFrame) -> DataFrame:
    """(conv_id, block, first, last, illegal, costs, audits) of blocks of adjacent rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            spans = []
            for rows in batch.column(2).to_pylist():
                seen = [(r["initial"], r["fault"]) for r in rows]
                illegal = sum(a[0] + b[0] not in LEGAL for a, b in zip(seen, seen[1:]))
                spans.append((seen[0][0], seen[-1][0], illegal, parse_rows(seen)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *_columns(spans)],
                names=["conv_id", "block", "first", "last", "illegal", "costs", "audits"],
            )

    rows = F.sort_array(F.collect_list(F.struct("at", "initial", "fault")))
    grouped = faulty.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(rows.alias("rows"))
    kind = faulty.schema["conv_id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"conv_id {kind}, block long, {_CELL}")


def _folded(cells: DataFrame) -> DataFrame:
    """Cells of up to 2 ** FOLD_BITS adjacent blocks combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            spans = []
            for parts in batch.column(2).to_pylist():
                spans.append(_joined([(p["first"], p["last"], p["illegal"], _cell(p)) for p in parts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *_columns(spans)],
                names=["conv_id", "block", "first", "last", "illegal", "costs", "audits"],
            )

    parts = F.sort_array(F.collect_list(F.struct("block", "first", "last", "illegal", "costs", "audits")))
    lows = cells.groupBy(F.col("conv_id").alias("c")).agg(F.min("block").alias("low"))
    numbered = cells.join(lows, F.col("conv_id").eqNullSafe(F.col("c")))
    grouped = numbered.groupBy(
        "conv_id", F.shiftright(F.col("block") - F.col("low"), FOLD_BITS).alias("block")
    ).agg(parts.alias("parts"))
    return grouped.mapInArrow(run, cells.schema)


def audits(faulty: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) per conversation of `faults`."""
    cells = stored(_blocks(faulty), "cells")
    while not cells.groupBy("conv_id").count().where("count > 1").isEmpty():
        cells = stored(_folded(cells), "cells")
    accepted = [
        F.struct(F.col("costs")[k].alias("cost"), F.col("audits")[k].alias("audit"))
        for k in (_AT[START, q] for q in ACCEPTED)
    ]
    # a struct of nulls is no repair
    least = F.array_min(F.filter(F.array(*accepted), lambda x: x["cost"].isNotNull()))
    counts = faulty.groupBy(F.col("conv_id").alias("c")).agg(
        *[
            F.count_if(F.col("fault") == k).alias(n)
            for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))
        ]
    )
    found = cells.select("conv_id", "illegal", least.alias("least"))
    return found.join(counts, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "blank", "duplicate", "truncated", "illegal", "least.cost", "least.audit"
    )


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, edit, role, text) of the rows that stand after the repair, in order.

    One conversation is one run of adjacent rows of one partition, streamed after its audit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state = "", 0, START
        for batch in batches:
            out: list[tuple] = []

            def edited(conv, role, text):
                nonlocal at, state
                edit = audit[at]
                at += 1
                if edit == DELETE:
                    return
                if edit != KEEP:
                    role = ROLE_FROM[state]
                state = STEP.get((state, role[:1]), state)
                out.append((conv, edit, role, text))

            for conv, whole, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if whole is not None:
                    audit, at, state = whole, 0, START
                else:
                    edited(conv, role, text)
                while at < len(audit) and audit[at] == INSERT:
                    edited(conv, None, "")
            kinds = [batch.schema.field(0).type, pa.string(), pa.string(), pa.string()]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "edit", "role", "text"]
            )

    none = F.lit(None).cast("string")
    rows = turns.select("conv_id", "turn", "role", "text", none.alias("audit"))
    no_turn = F.lit(None).cast(turns.schema["turn"].dataType)
    heads = audited.select(
        "conv_id", no_turn.alias("turn"), none.alias("role"), none.alias("text"), "audit"
    )
    both = rows.unionByName(heads).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("audit").isNull(), *_order(F.col("text")))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return both.select("conv_id", "audit", "role", "text").mapInArrow(
        run, f"conv_id {kind}, edit string, role string, text string"
    )


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `repaired`: role:text of its rows, joined by line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = None, None, None
        done: list[tuple] = []

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in done], kind), pa.array([d for _, d in done], pa.string())],
                names=["conv_id", "repaired_sha256"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield made()
                done = []
        if digest is not None:
            done.append((current, digest.hexdigest()))
            yield made()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def report(original: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conv_id of `original` on the rows of `turns` (conv_id, turn, role, text; roles
    and texts not null): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    A null id is a conversation; null turns come first and count for no gap; rows of one turn go by
    role and the hashes of their text, so equal rows are adjacent.  A conversation without rows has
    zeros, an empty audit and the hash of nothing.  Other columns are left out; no rows give none.
    """
    faulty = faults(turns)
    audited = stored(audits(faulty), "audits")
    spread = faulty.groupBy(F.col("conv_id").alias("c")).agg(
        F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n")
    )
    gaps = spread.select("c", (F.col("hi") - F.col("lo") + 1 - F.col("n")).alias("gaps"))
    hashed = digests(repaired(turns, audited)).withColumnRenamed("conv_id", "d")
    out = original.select(F.col("conv_id").alias("o")).distinct()
    out = out.join(audited, F.col("o").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(gaps, F.col("o").eqNullSafe(F.col("c")), "left")
    out = out.join(hashed, F.col("o").eqNullSafe(F.col("d")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("o").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
