"""Benchmark decontamination by pigeonhole pieces and bit-parallel edit distance.

Texts and items are reduced to lower-case words with one space between them. An item of m characters may be found
with up to k = m // CHARS_PER_ERROR edits. It is cut into k + 1 pieces: k edits leave one of them whole, so every
occurrence holds an exact piece. An Aho-Corasick pass finds the pieces, and the text around a hit is verified with Myers'
bit-parallel algorithm. Items are taken in blocks of bounded size, each sent to all tasks; texts are never moved.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_texts, map_texts

#: One edit is allowed for so many characters of an item.
CHARS_PER_ERROR = 16
#: Characters of items that are sent to the tasks at once.
ITEM_CHARS = 4_000_000
WORDS = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, hits array<struct<item_id:long,distance:int,start:int,stop:int>>"


def normal(text: str) -> str:
    """Words in lower case, each between single spaces."""
    return f" {' '.join(WORDS.findall(text.lower()))} "


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the error budget plus one pieces of a normalised item."""
    n = len(item) // CHARS_PER_ERROR + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def closest(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the first best occurrence of the item in the text within the budget: Myers, free start and end."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        zero = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = up << 1, down << 1
        plus, minus = (down | ~(zero | up)) & full, up & zero & full
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


def endings(item: str, text: str, budget: int) -> list[tuple[int, int]]:
    """(distance, end) wherever an occurrence of the item within the budget ends: Myers, free start and end."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, found = full, 0, m, []
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        zero = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = up << 1, down << 1
        plus, minus = (down | ~(zero | up)) & full, up & zero & full
        if score <= budget:
            found.append((score, j + 1))
    return found


def occurrences(item: str, text: str, budget: int) -> list[tuple[int, int, int]]:
    """(distance, start, end) of occurrences that share no more than the space between them, the best first, then the first."""
    m, taken = len(item), []
    at = text.find(item)
    if at >= 0 and (not budget or max(at, len(text) - at - m) + 1 < m - budget):
        while at >= 0:
            taken.append((0, at, at + m))
            at = text.find(item, at + m - 1)
        return taken
    if not budget:
        return taken
    for _, end in sorted(endings(item, text, budget)):
        if any(a + 1 < end <= b for _, a, b in taken):
            continue
        low = max([end - m - budget, 0, *(b - (text[b - 1] == " ") for _, a, b in taken if a < end - 1)])
        if end - low < m - budget:
            continue
        begun = closest(item[::-1], text[low:end][::-1], budget)
        if begun:
            taken.append((begun[0], end - begun[1], end))
    return taken


class Index:
    """The pieces of some items, ready to search."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, n) for i, n in ((i, normal(t)) for i, t in items) if n.strip()]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text):
                where.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[dict[str, int]]:
        """Every occurrence in a normalised text, looked for in the runs of overlapping windows around an item's hits."""
        windows: dict[int, set[tuple[int, int]]] = {}
        if not self.items:
            return []
        for last, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                m = len(self.items[k][1])
                slack = m // CHARS_PER_ERROR
                begin = last + 1 - size - offset
                windows.setdefault(k, set()).add((max(0, begin - slack), min(len(text), begin + m + slack)))
        found = []
        for k, spans in windows.items():
            item_id, item = self.items[k]
            runs: list[list[int]] = []
            for a, b in sorted(spans):  # begins do not come in order: a window starts a piece's offset before its hit
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(b, runs[-1][1])
                else:
                    runs.append([a, b])
            for a, b in runs:
                for distance, start, stop in occurrences(item, text[a:b], len(item) // CHARS_PER_ERROR):
                    found.append({"item_id": item_id, "distance": distance, "start": a + start, "stop": a + stop})
        return sorted(found, key=lambda h: (h["item_id"], h["start"]))


def item_blocks(benchmark: DataFrame, limit: int = ITEM_CHARS) -> list[list[tuple[int, str]]]:
    """Distinct items with a text, dealt by hash into blocks of about ``limit`` characters; one block at a time is on the driver."""
    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // limit + 1
    for block in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text")
        yield [(r.item_id, r.text) for r in part.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per occurrence: ``doc_id, item_id, distance, start, stop``; offsets are those of the normalised text.

    NULL texts have no words and no occurrences; items without a word or with a NULL id or text match nothing; repeated documents
    and items that differ under one id are reported each; empty tables give no rows.
    """
    out = None
    for items in item_blocks(benchmark):
        state: dict[str, Index] = {}

        def run(ids: list, texts: list[str], items=items, state=state) -> dict[str, list]:
            index = state.get("index") or state.setdefault("index", Index(items))
            return {"doc_id": ids, "hits": [index.search(normal(t)) for t in texts]}

        hits = map_texts(docs, run, SCHEMA).filter(F.size("hits") > 0).select("doc_id", F.inline("hits"))
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an occurrence of any item, with all their columns."""
    for items in item_blocks(benchmark):
        state: dict[str, Index] = {}

        def keep(texts: list[str], items=items, state=state) -> list[bool]:
            index = state.get("index") or state.setdefault("index", Index(items))
            return [not index.search(normal(t)) for t in texts]

        docs = filter_texts(docs, keep)
    return docs
