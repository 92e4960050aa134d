"""Toxic spans and documents from a token-tagging conditional random field.

Tokens are labelled first: a word, or a beginning of words, is marked when toxic documents have it
clearly more often than others do, and in a toxic document every marked word is a toxic token. The field then learns from
these tokens, with the classes of the word itself and of the words beside it as features, so
a marked word is judged in its place. Marginals of whole texts give offending offsets and, through a small
logistic fit on the training documents, the document score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_texts, fold, map_texts
from tidemark.llm.crf import Chain, fit, logistic, marginals

#: Labelled documents used to fit at most, taken by the hash of their id.
FIT_DOCUMENTS = 6000
#: The field is fitted to the marked words of these documents with so many words on each side; scoring runs over all words.
CONTEXT = 8
#: Longer documents are not used to fit (their one label says little about so many tokens); all are scored.
FIT_CHARS = 100_000
FOLDS, HELD_OUT = 4, 2
#: Words kept in the lexicon at most, by strength.
LEXICON = 4000
TOKEN = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that can be marked, longest first.
BEGINNINGS = (8, 7, 6, 5)
#: Distinct words whose class a task remembers.
REMEMBERED = 500_000
#: Token classes: 0 unlisted, 1 free, then one for each marked word or beginning.
UNLISTED = 0
#: Marginals below this say nothing about a document.
FLOOR = 1e-3


class Kinds(dict):
    """Class of a word: its own entry, or that of its longest marked beginning, or unlisted."""

    def __init__(self, marked: dict[str, int]):
        super().__init__()
        self.marked = marked

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        keys = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]
        found = next((self.marked[k] for k in keys if k in self.marked), UNLISTED)
        self[word] = found
        return found


def keys_of(text: str) -> set[str]:
    """The words of a text and their beginnings, these with a star."""
    words = set(tokens(text))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass
class ToxicityModel:
    classes: dict[str, int]
    n_classes: int
    weights: np.ndarray
    chain: Chain
    final: np.ndarray

    def slots(self, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bias, own class, and whether the word before and after is unlisted, marked or missing."""
        near = np.minimum(kinds, 2)
        last = np.append(first[1:], True) if len(first) else first
        before, after = np.roll(near, 1), np.roll(near, -1)
        before[first], after[last] = 3, 3
        base = 1 + self.n_classes
        return np.stack([np.zeros(len(kinds), int), 1 + kinds, base + before, base + 4 + after], axis=1)

    def tagged(self, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(self.weights[self.slots(kinds, first)].sum(axis=1), first, self.chain) if len(kinds) else np.zeros(0)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def lexicon(counts: list[tuple[str, int, int]], n_toxic: int, n_other: int) -> dict[str, int]:
    """Marked words: clearly more frequent in toxic documents (a z score of 4 or more and 5 times the rate).

    ``counts``: word, documents that have it, toxic documents that have it.
    """
    n1, n0 = max(1, n_toxic), max(1, n_other)
    found = []
    for w, c, c1 in counts:
        c0 = c - c1
        share = c / (n0 + n1)
        z = (c1 / n1 - c0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
        if z >= 4 and c1 / n1 >= 5 * (c0 + 0.5) / n0:
            found.append((-z, w))
    return {w: 2 + i for i, (_, w) in enumerate(sorted(found)[:LEXICON])}


def _document_numbers(p: np.ndarray, begin: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: 1, the log odds of its largest marginal, the logs of its expected toxic tokens and of all its tokens."""
    top, total = np.full(len(sizes), FLOOR), np.zeros(len(sizes))
    has = sizes > 0
    if has.any():
        q = np.clip(p, FLOOR, 1 - 1e-6)
        top[has] = np.maximum.reduceat(q, begin[has])
        total[has] = np.add.reduceat(np.where(q >= 0.05, q, 0.0), begin[has])
    return np.stack([np.ones(len(sizes)), np.log(top / (1 - top)), np.log1p(total), np.log1p(lengths)], axis=1)


def _stream(each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(k) for k in each])
    begin = np.cumsum(sizes) - sizes
    kinds = np.concatenate(each) if each else np.zeros(0, int)
    first = np.zeros(len(kinds), bool)
    first[begin[sizes > 0]] = True
    return kinds, first, begin, sizes


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_documents: int = FIT_DOCUMENTS, rounds: int = 120) -> ToxicityModel:
    """Fit on at most ``max_documents`` labelled documents outside the held-out fold.

    Labels that are NULL are passed over. Without labels every score is 0.5.
    """
    rows = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", F.col("toxic").alias("label"))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    chosen = {r.doc_id: int(r.label) for r in rows.collect()}
    short = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= FIT_CHARS)
    picked = short.join(F.broadcast(rows.select("doc_id")), "doc_id", "left_semi")
    words = map_texts(picked, _vocabularies, "doc_id long, words array<string>").join(F.broadcast(rows), "doc_id")
    words = words.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("n_toxic"))
    counts = [(r.word, r.n, r.n_toxic) for r in words.filter("n_toxic >= 4").collect()]
    marked = lexicon(counts, sum(chosen.values()), len(chosen) - sum(chosen.values()))
    n_classes = 2 + len(marked)

    def classed(ids: list, texts: list[str]) -> dict[str, list]:
        kind = Kinds(marked)
        each = [[kind[w] for w in tokens(t)] for t in texts]
        return {"doc_id": ids, "n_tokens": list(map(len, each)), "parts": list(map(_surroundings, each))}

    found = map_texts(picked, classed, "doc_id long, n_tokens int, parts array<array<int>>").orderBy("doc_id").collect()
    if not found:
        return ToxicityModel({}, 2, np.zeros(11), Chain(np.zeros((2, 2)), np.zeros(2)), np.zeros(4))
    kinds, first, _, _ = _stream([np.array(part, int) for r in found for part in r.parts])
    sizes = np.array([sum(map(len, r.parts)) for r in found])
    begin = np.cumsum(sizes) - sizes
    y = np.array([chosen[r.doc_id] for r in found])
    token_label = (np.repeat(y, sizes) == 1) & (kinds >= 2)
    model = ToxicityModel(marked, n_classes, np.zeros(0), Chain(np.zeros((2, 2)), np.zeros(2)), np.zeros(4))
    model.weights, model.chain = fit(model.slots(kinds, first), 1 + n_classes + 8, first, token_label, rounds=rounds, l2=1e-6)
    model.final = logistic(_document_numbers(model.tagged(kinds, first), begin, sizes, np.array([r.n_tokens for r in found])), y)
    return model


def _surroundings(kinds: list[int]) -> list[list[int]]:
    """The parts of a document within ``CONTEXT`` words of a marked one."""
    out: list[list[int]] = []
    done = 0
    for i, k in enumerate(kinds):
        if k >= 2:
            a, b = max(done, i - CONTEXT), min(len(kinds), i + CONTEXT + 1)
            if out and a == done:
                out[-1].extend(kinds[a:b])
            else:
                out.append(kinds[a:b])
            done = b
    return out


def _vocabularies(ids: list, texts: list[str]) -> dict[str, list]:
    return {"doc_id": ids, "words": [sorted(keys_of(t)) for t in texts]}


def score_toxicity(docs: DataFrame, model: ToxicityModel, span_at: float = 0.5) -> DataFrame:
    """Per document: ``score`` (0 to 1, higher is more toxic), ``n_tokens`` and ``spans``, the offending
    offsets (code points, end exclusive) of tokens whose marginal is ``span_at`` or more, joined when adjacent.

    A NULL or empty text has no tokens and gets the score of a text without any marked word; repeated rows
    are scored each; an empty table gives no rows.
    """

    state: dict[str, Kinds] = {}

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        score, sizes, begin, p = _judge(model, state, texts)
        return {"doc_id": ids, "score": score, "n_tokens": sizes, "spans": [_spans(t, p[a : a + n] >= span_at) for t, a, n in zip(texts, begin, sizes)]}

    return map_texts(docs, run, "doc_id long, score double, n_tokens int, spans array<struct<start:int,stop:int>>")


def drop_toxic(docs: DataFrame, model: ToxicityModel, reject_at: float) -> DataFrame:
    """The rows of ``docs`` whose score is below ``reject_at``, with all their columns."""
    state: dict[str, Kinds] = {}
    return filter_texts(docs, lambda texts: (_judge(model, state, texts)[0] < reject_at).tolist())


def _judge(model: ToxicityModel, state: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Score and number of tokens per text, where its tokens begin, and the marginals of all tokens."""
    kind = state.setdefault("kinds", Kinds(model.classes))
    kinds, first, begin, sizes = _stream([np.array([kind[w] for w in tokens(t)], int) for t in texts])
    p = model.tagged(kinds, first)
    return 1 / (1 + np.exp(-np.clip(_document_numbers(p, begin, sizes, sizes) @ model.final, -30, 30))), sizes, begin, p


def _spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Offsets in the text as given; lower-casing may change lengths, so tokens are found in a like-for-like way."""
    if not hit.any():
        return []
    places = [m.span() for m in TOKEN.finditer(text.lower())] if len(text.lower()) == len(text) else _places(text)
    out: list[dict[str, int]] = []
    last = -2
    for i in np.flatnonzero(hit):
        a, b = places[i]
        if out and last == i - 1:
            out[-1]["stop"] = b
        else:
            out.append({"start": a, "stop": b})
        last = i
    return out


def _places(text: str) -> list[tuple[int, int]]:
    """Spans of the lower-cased tokens, carried back to the characters that they came from."""
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in TOKEN.finditer("".join(c.lower() for c in text))]
