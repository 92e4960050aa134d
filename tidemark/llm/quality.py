"""Document quality from a line-labelling conditional random field.

Every line with a word is labelled good or bad; its features are those of the line and of the two
lines beside it. A document's score is the mean of its lines' marginals, weighted by line length, put on the
scale of label probabilities by a logistic fit on the training documents. Lines learn the label of their document. Documents without a word count as one empty line.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, map_texts
from tidemark.llm.crf import Chain, fit, logistic, marginals

#: Labelled documents used to fit at most, taken by the hash of their id.
FIT_DOCUMENTS = 4000
#: Lines kept of one document while fitting; the score always uses all of them.
FIT_LINES = 200
FOLDS, HELD_OUT = 5, 0
BINS = 10
SYMBOLS = "#*$%&<>{}=~^"
DIGITS = "0123456789"
N_FEATURES = 14


def line_features(line: str, seen: int) -> tuple:
    """Numbers that describe one line; ``seen``: how often its document has it."""
    words = line.split()
    n = len(words) or 1
    size = len(line) or 1
    stops = line.count(".") + line.count("!") + line.count("?")
    last = line.rstrip()[-1:]
    return (
        n,
        size / n,
        sum(map(line.count, SYMBOLS)) / n,
        sum(map(str.isupper, words)) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        line.count("|") / n,
        line.count("!") / n,
        (0 if not last else 1 if last in ".!?" else 2 if last.isalnum() else 3),
        seen,
        sum(map(line.count, DIGITS)) / size,
        float(line[:1].isupper()),
        n / (stops + 1),
        (line.count(",") + line.count(";")) / n,
    )


def document_lines(text: str) -> tuple[list[tuple], list[int], list[int]]:
    """Features, lengths and line numbers of the lines with a word; one empty line if there is none."""
    kept = [(i, line) for i, line in enumerate(text.split("\n")) if line and not line.isspace()]
    if not kept:
        return [line_features("", 1)], [1], [0]
    seen: dict[str, int] = {}
    for _, line in kept:
        seen[line] = seen.get(line, 0) + 1
    return [line_features(line, seen[line]) for _, line in kept], [len(line) for _, line in kept], [i for i, _ in kept]


@dataclass
class QualityModel:
    edges: list[np.ndarray]
    weights: np.ndarray
    chain: Chain
    scale: np.ndarray

    def slots(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Indices of the indicators of every line: bias, own bins, bins of the line before and after."""
        own = np.stack([np.searchsorted(e, numbers[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)
        last = np.append(first[1:], True)
        before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
        before[first], after[last] = BINS + 1, BINS + 1
        width, k = BINS + 2, np.arange(N_FEATURES)
        parts = [1 + (place * N_FEATURES + k) * width + bins for place, bins in enumerate((own, before, after))]
        return np.concatenate([np.zeros((len(own), 1), int), *parts], axis=1)

    @property
    def size(self) -> int:
        return 1 + 3 * N_FEATURES * (BINS + 2)

    def good(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(self.weights[self.slots(numbers, first)].sum(axis=1), first, self.chain)

    def scores(self, good: np.ndarray, length: np.ndarray, begin: np.ndarray) -> np.ndarray:
        mean = np.add.reduceat(good * length, begin) / np.add.reduceat(length, begin)
        return 1 / (1 + np.exp(-np.clip(_log_odds(mean) @ self.scale, -30, 30)))


def _log_odds(mean: np.ndarray) -> np.ndarray:
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(mean)), np.log(mean / (1 - mean))], axis=1)


def fit_quality(docs: DataFrame, labels: DataFrame, max_documents: int = FIT_DOCUMENTS, rounds: int = 120) -> QualityModel:
    """Fit on at most ``max_documents`` labelled documents outside the held-out fold.

    Labels that are NULL are passed over. Features are computed in tasks; the driver gets at most
    ``max_documents`` x ``FIT_LINES`` rows of numbers. Without labels every score is 0.5.
    """
    rows = labels.filter(F.col("quality").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", F.col("quality").alias("label"))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    chosen = {r.doc_id: r.label for r in rows.collect()}
    picked = docs.select("doc_id", "text").join(F.broadcast(rows.select("doc_id")), "doc_id", "left_semi")
    found = map_texts(picked, _training_lines, "doc_id long, numbers array<array<double>>").orderBy("doc_id").collect()
    if not found:
        return QualityModel([np.zeros(0)] * N_FEATURES, np.zeros(1 + 3 * N_FEATURES * (BINS + 2)), Chain(np.zeros((2, 2)), np.zeros(2)), np.zeros(2))
    numbers = np.concatenate([np.array(r.numbers) for r in found])
    sizes = np.array([len(r.numbers) for r in found])
    first = np.zeros(len(numbers), bool)
    first[np.cumsum(sizes) - sizes] = True
    y = np.repeat([int(chosen[r.doc_id]) for r in found], sizes)
    cuts = np.linspace(0, 1, BINS + 1)[1:]
    edges = [np.unique(np.concatenate([np.quantile(numbers[:, k], cuts), [numbers[:, k].min() + 1e-9]]))[:BINS] for k in range(N_FEATURES)]
    model = QualityModel(edges, np.zeros(0), Chain(np.zeros((2, 2)), np.zeros(2)), np.array([0.0, 1.0]))
    model.weights, model.chain = fit(model.slots(numbers, first), model.size, first, y, rounds=rounds)
    begin = np.cumsum(sizes) - sizes
    good, length = model.good(numbers, first), numbers[:, 0] * numbers[:, 1]
    mean = np.add.reduceat(good * length, begin) / np.add.reduceat(length, begin)
    model.scale = logistic(_log_odds(mean), y[begin])
    return model


def _training_lines(ids: list, texts: list[str]) -> dict[str, list]:
    return {"doc_id": ids, "numbers": [[list(map(float, f)) for f in document_lines(t)[0][:FIT_LINES]] for t in texts]}


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per document: ``score`` (0 to 1, higher is better), ``n_lines``, and ``bad_lines``, the numbers of its bad lines.

    A NULL or empty text is scored as one empty line; repeated rows are scored each; an empty table gives no rows.
    """

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        each = [document_lines(t) for t in texts]
        sizes = np.array([len(f) for f, _, _ in each])
        first = np.zeros(sizes.sum(), bool)
        first[np.cumsum(sizes) - sizes] = True
        good = model.good(np.array([f for features, _, _ in each for f in features], float), first)
        length = np.array([n for _, lengths, _ in each for n in lengths], float)
        begin = np.flatnonzero(first)
        score = model.scores(good, length, begin)
        numbers = [no for _, _, lines in each for no in lines]
        bad = [[numbers[i] for i in np.flatnonzero(good[a : a + n] < 0.5) + a] for a, n in zip(begin, sizes)]
        return {"doc_id": ids, "score": score, "n_lines": sizes, "bad_lines": bad}

    return map_texts(docs, run, "doc_id long, score double, n_lines int, bad_lines array<int>")
