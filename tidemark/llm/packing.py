"""Packing tokenised documents into sequences by linear grouping and best fit.

Only the number of pieces of every length reaches the driver: at most as many rows as a sequence has tokens, however many
documents there are. There, large lengths are cut into groups of equal cardinality and rounded up to the
largest of their group; the linear program over configurations of these few sizes is solved by column generation and rounded
down; the actual lengths are substituted; what is left and the small ones go, longest first, where they fit best. The result is a
plan of runs: so many pieces of one length, by rank, to consecutive sequences. Ranks are worked out by Spark.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import map_texts
from tidemark.session import cut_lineage

CAPACITY = 2048
END = 0
#: Lengths of more than this share of a sequence are large.
LARGE = 1 / 8
GROUPS = 48
#: Share of a sequence that substitution may leave empty.
SLACK = 1 / 256
VOCABULARY = "byte_bpe_50k.json"
#: Distinct words whose ids a task remembers.
REMEMBERED = 600_000
#: Pieces of one length that are ranked in one window, about.
RANKED_TOGETHER = 1 << 20


class Words(dict):
    """Ids of ' ' + word as little-endian bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return found


class ByteBpe:
    """A byte-level BPE vocabulary file, with a memory of words.

    A text is split at spaces. That changes no id unless a space stands between white space and white space or the end:
    such runs are one unit of the vocabulary's pattern, so those texts are encoded whole.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
            told = json.load(f)
        special = {x["content"] for x in told.get("added_tokens", [])}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
        self.encode = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.words = Words(self.encode)
        self.joined = regex.compile(r"\s (?!\S)").search

    def ids(self, text: str) -> bytes:
        if self.joined(text):
            return np.array(self.encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encode(first), "<u4").tobytes() + b"".join(map(self.words.__getitem__, rest))


def cut(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of the pieces: full ones, but for the first."""
    n = len(ids) // 4
    head = n % capacity or capacity
    bounds = [0, *range(head, n + 1, capacity)]
    return [(a, ids[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]


def tokenize(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit). A document's ids end with id 0.

    NULL and empty texts are the end id alone; repeated rows give pieces each; an empty table gives none.
    """
    state: dict[str, ByteBpe] = {}

    def run(doc_ids: list, texts: list[str]) -> dict[str, list]:
        bpe = state.get("bpe") or state.setdefault("bpe", ByteBpe(vocabulary))
        end = np.array([END], "<u4").tobytes()
        rows = [(d, i, a, len(p) // 4, p) for d, t in zip(doc_ids, texts) for i, (a, p) in enumerate(cut(bpe.ids(t) + end, capacity))]
        names = ("doc_id", "piece", "start", "length", "ids")
        return dict(zip(names, map(list, zip(*rows))))

    return map_texts(docs, run, "doc_id long, piece int, start long, length long, ids binary")


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 4000) -> list[tuple[int, list[int]]]:
    """(sequences, copies of every size) covering most of the demand: column generation, rounded down."""
    k = len(sizes)
    columns = [[capacity // s if i == j else 0 for i in range(k)] for j, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amount = inverse @ np.array(demand, float)
    for _ in range(rounds):
        worth = inverse.sum(axis=0)
        value, taken = _knapsack(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        way = inverse @ np.array(taken, float)
        open_rows = np.flatnonzero(way > 1e-9)
        row = open_rows[np.argmin(amount[open_rows] / way[open_rows])]
        pivot = inverse[row] / way[row]
        step = amount[row] / way[row]
        inverse = inverse - np.outer(way, pivot)
        inverse[row] = pivot
        amount = amount - way * step
        amount[row] = step
        columns[row] = taken
    return [(int(x + 1e-6), c) for x, c in zip(amount, columns) if x >= 1]


def _knapsack(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for g, s in enumerate(sizes):
        if worth[g] <= 1e-12:
            continue
        for _ in range(capacity // s):
            more = best[:-s] + worth[g]
            better = more > best[s:] + 1e-12
            if not better.any():
                break
            best[s:][better] = more[better]
            choice[s:][better] = g
    taken, left, value = [0] * len(sizes), int(np.argmax(best)), 0.0
    while left > 0 and choice[left] >= 0:
        g = choice[left]
        taken[g] += 1
        value += worth[g]
        left -= sizes[g]
    return value, taken


class Runs:
    """The plan: pieces of ``size`` with ranks from ``rank``, ``per`` to a sequence, from sequence ``base`` on, at ``offset``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.total, self.rows = capacity, 0, []
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.spare: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.residuals: list[int] = []

    def put(self, size: int, per: int, base: int, n: int, residual: int) -> int:
        """``per`` pieces to each of ``n`` sequences that have ``residual`` tokens left; what they have left then."""
        self.rows.append((size, self.used[size], per, base, self.capacity - residual, n))
        self.used[size] += per * n
        self.left[size] -= per * n
        return residual - per * size

    def leave(self, residual: int, base: int, n: int) -> None:
        if residual and n:
            if not self.spare[residual]:
                insort(self.residuals, residual)
            self.spare[residual].append((base, n))

    def fresh(self, n: int) -> int:
        base, self.total = self.total, self.total + n
        return base


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Runs:
    """Pack ``counts`` pieces per length. The work depends on the number of lengths, not of pieces."""
    runs = Runs(counts, capacity)
    large = sorted((s for s in counts if capacity * LARGE < s < capacity), reverse=True)
    n_large = sum(counts[s] for s in large)
    if n_large:
        grouped: list[list[list[int]]] = []
        share, filled = -(-n_large // groups), None
        for s in large:
            todo = counts[s]
            while todo:
                if filled is None or filled >= share:
                    grouped.append([])
                    filled = 0
                take = min(todo, share - filled)
                grouped[-1].append([s, take])
                filled += take
                todo -= take
        sizes = [g[0][0] for g in grouped]
        merged: dict[int, list[list[int]]] = {}
        for s, g in zip(sizes, grouped):
            merged.setdefault(s, []).extend(g)
        sizes = list(merged)
        for n, copies in configurations(sizes, [sum(c for _, c in merged[s]) for s in sizes], capacity):
            _substitute(runs, [merged[s] for s, c in zip(sizes, copies) for _ in range(c)], n)
    for size in sorted(counts, reverse=True):
        _best_fit(runs, size)
    return runs


def _substitute(runs: Runs, slots: list[list[list[int]]], n: int) -> None:
    """Give up to ``n`` sequences actual lengths: every slot draws the next of its group, runs of equal lengths at a time.

    A sequence whose lengths were rounded up by more than ``SLACK`` in all is not formed; its pieces go on to best fit.
    """
    while n and all(slots):
        times: dict[int, int] = defaultdict(int)
        for group in slots:
            times[id(group)] += 1
        step = min(n, *(group[0][1] // times[id(group)] for group in slots)) or 1
        sizes = []
        for group in slots:  # with a step of one, slots of one group may draw different lengths
            if not group:
                return
            sizes.append(group[0][0])
            group[0][1] -= step
            if not group[0][1]:
                group.pop(0)
        n -= step
        residual = runs.capacity - sum(sizes)
        if residual <= runs.capacity * SLACK:
            base, residual = runs.fresh(step), runs.capacity
            for size in sizes:
                residual = runs.put(size, 1, base, step, residual)
            runs.leave(residual, base, step)


def _best_fit(runs: Runs, size: int) -> None:
    """All pieces of one length still left: into the fullest sequences that can take one, as many as fit; then into new ones."""
    while left := runs.left[size]:
        at = bisect_left(runs.residuals, size)
        if at < len(runs.residuals):
            residual = runs.residuals[at]
            base, n = runs.spare[residual].pop()
            if not runs.spare[residual]:
                runs.residuals.pop(at)
        else:
            residual, n = runs.capacity, -(-left // (runs.capacity // size))
            base = runs.fresh(n)
        per = residual // size
        full = min(n, left // per)
        if full:
            runs.leave(runs.put(size, per, base, full, residual), base, full)
            base, n, left = base + full, n - full, left - per * full
        if n and 0 < left < per:
            runs.leave(runs.put(size, left, base, 1, residual), base, 1)
            base, n = base + 1, n - 1
        runs.leave(residual, base, n)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``rank``, from 0, among the pieces of the same length: in hashed buckets first, then by what the buckets before hold."""
    buckets = total // RANKED_TOGETHER + 16
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    held = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start"))
    return pieces.withColumn("place", inside).join(held, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("place") - 1).drop("bucket", "before", "place")


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, piece, start, length`` and any others).

    ``pieces`` should be stored (it is read twice). No rows give no rows.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = sorted(plan_sequences(counts, capacity, groups).rows)
    size, rank, per, base, offset, _ = (np.array(x, np.int64) for x in (zip(*rows) if rows else [[]] * 6))
    first = {s: i for i, s in reversed(list(enumerate(size.tolist())))}
    begin = np.zeros(capacity + 2, np.int64)
    for s in range(1, capacity + 2):
        begin[s] = first.get(s, 0)
    end = begin + np.bincount(size, minlength=capacity + 2)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        lengths, r = length.to_numpy(np.int64), ranks.to_numpy(np.int64)
        row = np.empty(len(r), np.int64)
        for s in np.unique(lengths):
            of = lengths == s
            row[of] = begin[s] + np.searchsorted(rank[begin[s] : end[s]], r[of], side="right") - 1
        inside = r - rank[row]
        return pd.DataFrame({"sequence_id": base[row] + inside // per[row], "offset": offset[row] + inside % per[row] * lengths})

    placed = ranked(pieces, sum(counts.values())).withColumn("at", place("length", "rank"))
    return placed.select(*pieces.columns, F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset"))


def pack(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, vocabulary: str | None = None) -> DataFrame:
    """Pieces with their ids and places: ``doc_id, piece, start, length, ids, sequence_id, offset``."""
    return assign_sequences(cut_lineage(tokenize(docs, capacity, vocabulary)), capacity, groups)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids``; a group has at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
