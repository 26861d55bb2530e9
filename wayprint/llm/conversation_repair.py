"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation shall be empty or, after at most one system turn, pairs of a user's and
an assistant's turn. Its rows, by turn, are the columns of a lattice whose nodes are
what the roles so far end in; arcs keep a row, give it the user's or assistant's role,
delete it, or insert an empty turn, at integer costs. An auction finds the cheapest
path: a path grows from its start to the neighbour that the node prices make cheapest,
or is cut back while its last node's price rises, until it reaches the end. Converged
prices are dual, so exactly the cheapest paths are made of tight arcs; the one whose
edits read least in ASCII is traced through them. From a node an edit leads to one
node only, so edits name a path.

Rows are sorted by ranges of conversation and turn, and blocks of at most 64 rows cut
from that order, so a long conversation lies in many tasks. Solving reads the blocks of
a conversation from its end, as a code letter per row: a block's prices are what its
predecessor's paths end in. Writing the repaired turns reads them from the start.
Neither holds more than a block. Blocks of the same letters are solved once a worker.

Edge cases: null roles and texts are one space; turns of one number are ordered by
role and text, those without a number come first; a repeated row is a duplicate of the
first; an empty role has no initial and is never kept; rows without a conversation id
form one conversation; texts of any length are read whole; ties between edits go to the
least audit string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayprint.llm.scratch import stored

# Costs of edits; an undeleted truncated row adds one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# What the roles so far end in: nothing, the system's turn, a user's, an assistant's (complete).
NONE, SYSTEM, USER, ASSISTANT = range(4)
END_COSTS = (0, 2 * INSERT, INSERT, 0)
FILLS = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
# A row's code: the place of its role's initial, and what is wrong with it.
INITIALS = "sua"
FINE, CUT_OFF, BLANK, REPEATED = range(4)
BLOCK_ROWS, BLOCK_BYTES = 64, 1 << 20

ARCS = list[tuple[str, int, int]]  # label, cost, head


def _code(initial: int, fault: int) -> str:
    return chr(ord("a") + 4 * initial + fault)


def _next(state: int, initial: int) -> int | None:
    """What the roles end in after a turn with this initial, where it may follow."""
    if initial == 0:
        return SYSTEM if state == NONE else None
    wanted = FILLS[state]
    return wanted if initial < 3 and wanted == (USER if initial == 1 else ASSISTANT) else None


def lattice(codes: str) -> list[ARCS]:
    """Arcs out of node ``4 * rows read + state``, the least label first; the last column has none."""
    arcs: list[ARCS] = []
    for column, code in enumerate(codes):
        initial, fault = divmod(ord(code) - ord("a"), 4)
        for state in range(4):
            here, below = 4 * column, 4 * column + 4
            found = [("D", DELETE, below + state), ("I", INSERT, here + FILLS[state])]
            if fault < BLANK:
                extra, kept = TRUNCATED * (fault == CUT_OFF), _next(state, initial)
                if kept is not None:
                    found.append(("K", extra, below + kept))
                found.append(("R", REROLE + extra, below + FILLS[state]))
            arcs.append(found)
    return arcs + [[] for _ in range(4)]


def auction(arcs: list[ARCS], ends: tuple[int, ...]) -> list[int]:
    """Prices of all nodes, dual feasible, that are the exact costs to the end for the first column.

    ``ends`` are the costs of ending in each state. Prices start at what the rows that
    remain cost at least. For each start a path is extended along the arc that attains
    the least of cost and price, where that equals its last node's price, and otherwise
    contracted, with the price raised to it. Deleting all rows ends every path, so each
    auction closes.
    """
    last = len(arcs) - 4
    goal = len(arcs)
    prices = [0] * goal + [0]
    floor = min(ends)
    for state in range(4):
        prices[last + state] = floor
    for node in range(last - 4, -1, -4):
        bound = prices[node + 4] + min(cost for here in arcs[node:node + 4] for label, cost, head in here if head >= node + 4)
        prices[node:node + 4] = [bound] * 4

    def cheapest(node: int) -> tuple[int, int]:
        if node >= last:
            return ends[node - last], goal
        return min((cost + prices[head], head) for _, cost, head in arcs[node])

    for start in range(4):
        path = [start]
        while path[-1] != goal:
            node = path[-1]
            value, head = cheapest(node)
            if value > prices[node]:
                prices[node] = value
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
    return prices


def trace(arcs: list[ARCS], ends: tuple[int, ...], prices: list[int], start: int) -> tuple[str, int]:
    """The least labels of a cheapest path from ``start`` and the state it ends in."""
    last = len(arcs) - 4
    reaches = [False] * len(arcs)
    for state in range(4):
        reaches[last + state] = prices[last + state] == ends[state]
    for column in range(last - 4, -1, -4):
        for _ in range(3):  # insertions lead within the column
            for node in range(column, column + 4):
                reaches[node] = reaches[node] or any(
                    reaches[head] and prices[node] == cost + prices[head] for _, cost, head in arcs[node])
    labels, node = [], start
    while node < last:
        label, node = next((label, head) for label, cost, head in arcs[node] if reaches[head] and prices[node] == cost + prices[head])
        labels.append(label)
    return "".join(labels), node - last


@lru_cache(maxsize=1 << 16)
def solve(codes: str, ends: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]:
    """Of a block: for each state before it the cost to the end, the edits and the state after it."""
    if not codes:
        return ends, ("",) * 4, (0, 1, 2, 3)
    arcs = lattice(codes)
    prices = auction(arcs, ends)
    traced = [trace(arcs, ends, prices, state) for state in range(4)]
    return tuple(prices[:4]), tuple(labels for labels, _ in traced), tuple(after for _, after in traced)


@lru_cache(maxsize=1 << 16)
def faults(codes: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles do not follow."""
    numbers = [ord(code) - ord("a") for code in codes]
    kinds = [n % 4 for n in numbers]
    wrong = sum(not follows(a // 4, b // 4) for a, b in zip(numbers, numbers[1:]))
    return kinds.count(BLANK), kinds.count(REPEATED), kinds.count(CUT_OFF), wrong


def follows(before: int, after: int) -> bool:
    return (before, after) in {(0, 1), (1, 2), (2, 1)}


def _filled(turns: DataFrame, *more: str) -> DataFrame:
    space = F.lit(" ")
    return turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), *more)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with the damage that the checksum of ``conv_id:turn`` deals them; dropped ones stay as marks.

    ``conv_id, turn, role, text, gone``; a repeated row stands twice.
    """
    space, rows = F.lit(" "), _filled(turns)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("deal", F.crc32(key) % 20)
    deal = F.col("deal")
    text = F.when(deal == 1, "").when(deal == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(deal == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(deal == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (deal == 0).alias("gone"), copies.alias("copy")).drop("copy")


def _coded(rows: DataFrame) -> DataFrame:
    """``code`` of each row: the first of its faults and its role's initial; empty for one that is gone."""
    earlier = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
             .when(F.row_number().over(earlier) > 1, REPEATED)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF).otherwise(FINE))
    place = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((place == 0) | (F.col("role") == ""), len(INITIALS)).otherwise(place - 1)
    return rows.withColumn("code", F.when(F.col("gone"), "").otherwise(F.char(F.lit(ord("a")) + 4 * initial + fault)))


BLOCK = "part int, at bigint, codes string, n_turns bigint, least bigint, most bigint, first bigint, last bigint, roles array<string>, texts array<string>"


def blocks(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """Rows in the order of their conversations, in blocks of one conversation each.

    ``part, at`` number the blocks in that order. A conversation has at least one block,
    even if nothing of it is left: rows marked by the column ``gone`` only name theirs.
    """
    mark = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    rows = _coded(_filled(turns, mark.alias("gone"))).withColumn("turn", F.col("turn").cast("bigint"))
    # Of equal rows the first comes before its duplicates, by code.
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("code")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ordered = ordered.select("conv_id", "part", "turn", "role", "text", "code")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[field.split()[0] for field in BLOCK.split(", ")]]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_, made, kind = 0, None, [], None

        def closed() -> tuple:
            conv, part, codes, turns, roles, texts = open_
            known = [t for t in turns if t is not None]
            return (conv, part, at, "".join(codes), len(set(known)), min(known, default=None), max(known, default=None),
                    *((turns[0], turns[-1]) if turns else (None, None)), roles, texts)

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*found)]
            types = [kind, pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.string()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        size = waiting = 0  # bytes of text in the open block and in those made
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, part, turn, role, text, code in zip(*[c.to_pylist() for c in batch.columns]):
                if open_ and (open_[0] != conv or len(open_[2]) >= BLOCK_ROWS or size > BLOCK_BYTES):
                    made.append(closed())
                    at, open_, size, waiting = at + 1, None, 0, waiting + size
                    if len(made) >= 1000 or waiting > 4 * BLOCK_BYTES:
                        yield batch_of(made)
                        made, waiting = [], 0
                if open_ is None:
                    open_ = (conv, part, [], [], [], [])
                if code:
                    for column, value in zip(open_[2:], (code, turn, role, text)):
                        column.append(value)
                    size += len(text)
        if open_:
            made.append(closed())
            yield batch_of(made)

    return ordered.mapInArrow(cut, f"conv_id {id_type}, {BLOCK}")


def _by_conversation(rows: DataFrame, forward: bool) -> DataFrame:
    order = [F.col("part"), F.col("at")] if forward else [F.col("part").desc(), F.col("at").desc()]
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), *order)


def solved(found: DataFrame) -> DataFrame:
    """``part, at, audits, afters, cost``: for each state before a block its edits and the state after it.

    ``cost`` is that of all edits from this block on, if nothing precedes it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ends = (), END_COSTS
        for batch in batches:
            out = []
            for conv, part, at, codes in zip(*[c.to_pylist() for c in batch.columns]):
                last = (conv,) != before
                ends = END_COSTS if last else ends
                ends, audits, afters = solve(codes, ends)
                if last:  # what is still to insert at the end
                    audits = tuple(a + "I" * (END_COSTS[s] // INSERT) for a, s in zip(audits, afters))
                out.append((part, at, audits, afters, ends[NONE]))
                before = (conv,)
            if out:
                columns = [list(c) for c in zip(*out)]
                types = [pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "at", "audits", "afters", "cost"])

    rows = _by_conversation(found.select("conv_id", "part", "at", "codes"), forward=False)
    return rows.mapInArrow(run, "part int, at bigint, audits array<string>, afters array<int>, cost bigint")


def edited(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The turns that the edits make of a block's rows."""
    row = 0
    for edit in audit:
        if edit == "I":
            state = FILLS[state]
            yield ROLES[state], ""
            continue
        if edit == "K":
            state = SYSTEM if roles[row].startswith("s") else FILLS[state]
            yield roles[row], texts[row]
        elif edit == "R":
            state = FILLS[state]
            yield ROLES[state], texts[row]
        row += 1


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Each block as a dictionary with the state before it, and whether its conversation begins."""
    before, state = (), NONE
    for batch in batches:
        for row in batch.to_pylist():
            first = (row["conv_id"],) != before
            before, state = (row["conv_id"],), NONE if first else state
            yield first, state, row
            state = row["afters"][state]


def _answers(found: DataFrame) -> DataFrame:
    found = stored(found, "blocks")
    return _by_conversation(found.join(solved(found), ["part", "at"]), forward=True)


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """``conv_id, position, edit_block, role, text``: all turns as repaired, with their blocks' edits.

    ``position`` numbers the turns of a conversation from 0.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = 0
        for batch, (first, state, row) in _with_batch(batches):
            position = 0 if first else position
            made = list(edited(row["audits"][state], state, row["roles"], row["texts"]))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["conv_id"]] * len(made), batch.schema.field("conv_id").type),
                     pa.array(range(position, position + len(made)), pa.int64()), pa.array([row["audits"][state]] * len(made)),
                     pa.array([r for r, _ in made]), pa.array([t for _, t in made])],
                    names=["conv_id", "position", "edit_block", "role", "text"])
            position += len(made)

    return _answers(blocks(turns, gone)).mapInArrow(run, f"conv_id {id_type}, position bigint, edit_block string, role string, text string")


def _with_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    now = None

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal now
        for now in batches:
            yield now

    for found in _in_order(seen()):
        yield now, found


class _Summary:
    """Counts, edits and digest of one conversation, from its blocks in order."""

    def __init__(self, conv, cost: int):
        self.conv, self.cost, self.counts, self.audit = conv, cost, [0, 0, 0, 0], []
        self.n_turns, self.least, self.most, self.turn, self.code = 0, None, None, None, None
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, state: int, row: dict) -> None:
        codes = row["codes"]
        self.counts = [a + b for a, b in zip(self.counts, faults(codes))]
        if codes:
            if self.code is not None:
                self.counts[3] += not follows(self.code, (ord(codes[0]) - ord("a")) // 4)
                self.n_turns -= row["first"] is not None and row["first"] == self.turn
            self.code, self.turn = (ord(codes[-1]) - ord("a")) // 4, row["last"]
        self.n_turns += row["n_turns"]
        if row["least"] is not None:
            self.least = row["least"] if self.least is None else self.least
            self.most = row["most"]
        self.audit.append(row["audits"][state])
        for role, text in edited(self.audit[-1], state, row["roles"], row["texts"]):
            self.digest.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
            self.empty = False

    def row(self) -> tuple:
        gaps = self.most - self.least + 1 - self.n_turns if self.least is not None else 0
        return self.conv, gaps, *self.counts, self.cost, "".join(self.audit), self.digest.hexdigest()


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digests(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits with their cost, and the repaired text's digest."""
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, now, out = None, None, []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*found)), types)], names=["conv_id", *RESULT])

        for batch, (first, state, row) in _with_batch(batches):
            kind = batch.schema.field("conv_id").type
            if first:
                if now:
                    out.append(now.row())
                now = _Summary(row["conv_id"], row["cost"])
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
            now.add(state, row)
        if now:
            yield batch_of([*out, now.row()])

    types = ", ".join(f"{c} {'bigint' if i < 6 else 'string'}" for i, c in enumerate(RESULT))
    return _answers(blocks(turns, gone)).mapInArrow(run, f"conv_id {id_type}, {types}")
