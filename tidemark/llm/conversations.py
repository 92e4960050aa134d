"""Conversation structure repair: an auction shortest path over the lattice of edits.

A conversation's rows, by turn, must become ``(system? (user assistant)+)?`` by their roles' initials. Every row is kept, given another role, or
deleted, and empty rows may be inserted anywhere. A node of the lattice is (rows used, state of that pattern); arcs are edits with small
whole costs. Bertsekas' auction keeps a price per node, at most the cost of an arc plus the price of its head: a path is extended along an arc
where both are equal, or gives up its last node and raises that node's price. Once the path ends at the goal, the start's price is the
least cost, and every arc of every cheapest path is tight, so the cheapest edits with the least letters are traced arc by arc.

Conversations are streamed: rows are dealt by conversation, sorted by Spark (which spills), and met twice, first without their texts, then with
them. A task holds one byte and one letter per row of a single conversation, no texts. Long conversations are cut into blocks of ``BLOCK`` rows,
solved from the last to the first: the prices at a block's start are the costs of leaving the block before it. One conversation stays in one task, as its
result is one string of edits and one digest of all its text.

NULL ``turn`` sorts first and takes no part in gaps; NULL ``role`` and ``text`` count as one space; a NULL ``conv_id`` is a conversation of its own; rows of
the same turn are taken by role, then text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a conversation that are solved together, and block solutions that a task remembers.
BLOCK, REMEMBERED = 64, 20_000
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: A row as one byte: the role's initial as its place in "sua", or 3; what must go; what counts as truncated.
INITIALS, OTHER, MUST_GO, CUT_SHORT = "sua", 3, 4, 8
#: States: nothing yet, after s, after u, after a. Where a kept role leads, and which role is missing next.
KEPT = [{0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {}]
MISSING = [2, 2, 3, 2]
NAMES = {2: "user", 3: "assistant"}
NEVER = float("inf")
AT_END = (0, NEVER, NEVER, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}
SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
MESSAGES = "conv_id long, place long, edit string, role string, text string"


def arcs_of(codes: bytes, after: tuple) -> list[list[tuple[int, int, str]]]:
    """Arcs (head, cost, letter) of every node ``4 * rows + state``, letters in ASCII order; the goal is the last node."""
    rows, goal = len(codes), 4 * len(codes) + 4
    out: list[list[tuple[int, int, str]]] = []
    for i in range(rows + 1):
        code = codes[i] if i < rows else 0
        more = TRUNCATED if code & CUT_SHORT else 0
        for q in range(4):
            here, then = [], MISSING[q]
            if i < rows:
                here.append((4 * i + 4 + q, DELETE, "D"))
            if i < rows or after is AT_END:  # at an inner cut the next block inserts
                here.append((4 * i + then, INSERT, "I"))
            if i < rows and not code & MUST_GO:
                if q in KEPT[code & 3]:
                    here.append((4 * i + 4 + KEPT[code & 3][q], more, "K"))
                here.append((4 * i + 4 + then, REROLE + more, "R"))
            if i == rows and after[q] != NEVER:
                here.append((goal, after[q], ""))
            out.append(here)
    return out


def auction(arcs: list[list[tuple[int, int, str]]], prices: list[int], origin: int) -> None:
    """Raise ``prices`` (kept from earlier origins) until a path of tight arcs leads from ``origin`` to the last node."""
    goal, path = len(arcs), [origin]
    while path[-1] != goal:
        node = path[-1]
        best, head = min((cost + prices[to], to) for to, cost, _ in arcs[node])
        if prices[node] < best:  # contract
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:  # extend along a tight arc
            path.append(head)


def solve_block(codes: bytes, after: tuple) -> list[tuple[int, str, int]]:
    """For each state at the block's start: (least cost, edits with the least letters, state at its end). ``after``: cost of each state at its end."""
    arcs = arcs_of(codes, after)
    goal, prices = len(arcs), [0] * (len(arcs) + 1)
    for q in range(4):
        auction(arcs, prices, q)
    tight = [[a for a in here if prices[n] == a[1] + prices[a[0]]] for n, here in enumerate(arcs)]
    leads = [False] * goal + [True]
    for i in range(len(codes), -1, -1):
        for _ in range(4):  # inserts stay among the four nodes of a row
            for n in range(4 * i, 4 * i + 4):
                leads[n] = leads[n] or any(leads[to] for to, _, _ in tight[n])
    found = []
    for q in range(4):
        node, letters = q, []
        while True:
            to, _, letter = next(a for a in sorted(tight[node], key=lambda a: a[2]) if leads[a[0]])
            if to == goal:
                break
            letters.append(letter)
            node = to
        found.append((prices[q], "".join(letters), node % 4))
    return found


def cheapest_edits(codes: bytes, remembered: dict) -> tuple[int, str]:
    """(least cost, letters of the edits) of a whole conversation."""
    after, base, solved = AT_END, 0, []
    for begin in range((len(codes) - 1) // BLOCK * BLOCK if codes else 0, -1, -BLOCK):
        key = codes[begin : begin + BLOCK], after
        if key not in remembered:
            if len(remembered) >= REMEMBERED:
                remembered.clear()
            remembered[key] = solve_block(*key)
        found = remembered[key]
        solved.append(found)
        least = min(cost for cost, _, _ in found)
        total, base, after = base + found[0][0], base + least, tuple(cost - least for cost, _, _ in found)
    state, letters = 0, []
    for found in reversed(solved):
        _, piece, state = found[state]
        letters.append(piece)
    return total, "".join(letters)


def coded_rows(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """``conv_id, part, turn, place, role, code, fault, text``, each conversation in one partition: first all its rows without text, then all with.

    ``gone`` marks rows that are not there any more but whose conversation still gives a result; they come without a ``place``.
    """
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.lit(False) if gone is None else gone).alias("gone"))
    rows = rows.repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    rows = rows.withColumn("again", again)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("gone", F.asc_nulls_first("turn"), "role", "text", "again"))
    rows = rows.withColumns({"place": F.when(~F.col("gone"), place), "end": F.rtrim("text", F.lit(BLANKS))})
    fault = F.when(F.col("end") == "", 1).when(F.col("again"), 2).when(~F.substring("end", -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(OTHER)
    rows = rows.withColumn("fault", fault).withColumn("code", initial + F.when(F.col("fault").isin(1, 2), MUST_GO).when(F.col("fault") == 3, CUT_SHORT).otherwise(0))
    parts = F.when(F.col("gone"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    rows = rows.withColumn("part", F.explode(parts))
    return rows.select("conv_id", "part", "turn", "place", F.when(F.col("part") == 1, F.col("role")).alias("role"), F.col("code").cast("int"), F.col("fault").cast("int"), F.when((F.col("part") == 1) & (F.col("fault") != 1) & (F.col("fault") != 2), F.col("text")).alias("text")).sortWithinPartitions("conv_id", "part", F.asc_nulls_last("place"))


class Conversation:
    """What a task knows of the conversation it is at."""

    def __init__(self, key, remembered: dict):
        self.key, self.remembered = key, remembered
        self.codes, self.faults = bytearray(), [0, 0, 0, 0]
        self.turns, self.low, self.high = 0, None, None
        self.letters: str | None = None
        self.next, self.state, self.made, self.digest = 0, 0, 0, hashlib.sha256()

    def count(self, turn, code: int, fault: int) -> None:
        self.codes.append(code)
        self.faults[fault] += 1
        if turn is not None and turn != self.high:  # turns come in order
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn

    def solve(self) -> None:
        if self.letters is None:
            self.cost, self.letters = cheapest_edits(bytes(self.codes), self.remembered)

    def _say(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update((("\n" if self.made else "") + f"{role}:{text}").encode())
        self.made += 1
        return self.key, self.made, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.letters[self.next : self.next + 1] == "I":
            self.next += 1
            self.state = MISSING[self.state]
            yield self._say("I", NAMES[self.state], "")

    def replay(self, role: str, text: str | None, code: int) -> Iterator[tuple]:
        """The messages that this row and the inserts before it give."""
        yield from self.inserted()
        letter = self.letters[self.next]
        self.next += 1
        if letter == "K":
            self.state = KEPT[code & 3][self.state]
            yield self._say("K", role, text)
        elif letter == "R":
            self.state = MISSING[self.state]
            yield self._say("R", NAMES[self.state], text)

    def summary(self) -> tuple:
        kinds = [c & 3 for c in self.codes]
        illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.key, min(gaps, (1 << 63) - 1), *self.faults[1:], illegal, self.cost, self.letters, self.digest.hexdigest()


def _streamed(schema: str, messages: bool):
    target = to_arrow_schema(StructType.fromDDL(schema))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(target)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, remembered, out = None, {}, []

        def finish() -> None:
            now.solve()
            last = list(now.inserted())
            out.extend(last if messages else [now.summary()])

        for batch in batches:
            for key, part, turn, place, role, code, fault, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or key != now.key:
                    if now is not None:
                        finish()
                    now = Conversation(key, remembered)
                if place is None:
                    continue
                if part == 0:
                    now.count(turn, code, fault)
                    continue
                now.solve()
                made = list(now.replay(role, text, code))
                if messages:
                    out.extend(made)
            yield batch_of(out)
            out = []
        if now is not None:
            finish()
        yield batch_of(out)

    return task


def summarize_repairs(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row per conversation: counts of faults, cost and letters of the cheapest edits, and the SHA-256 of what they leave."""
    return coded_rows(rows, gone).mapInArrow(_streamed(SUMMARY, messages=False), SUMMARY)


def repair_conversations(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired messages: ``conv_id, place`` (from 1), ``edit`` (K, R or I), ``role, text``."""
    return coded_rows(rows, gone).mapInArrow(_streamed(MESSAGES, messages=True), MESSAGES)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` with the faults that the CRC-32 of ``conv_id:turn`` names (a NULL there as one space)."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    rows = rows.withColumns({"text": text, "role": role, "gone": F.col("kind") == 0})
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text", "gone")
