"""A log-bilinear language model, fitted by noise-contrastive estimation in numpy.

Tokens are lower-case words and one end per text. The ``FREQUENT`` most frequent words and the end have classes of their own; all other words share ``ENDINGS``
classes by a hash of their last characters. The model says how likely a class is after another one: a context vector times a class vector plus
a bias, normalised over all classes. Within a shared class a word has its share of the class' counts, one added for each known word and one for
all unknown ones together. So every token has a normalised probability.

What is learnt comes from all training texts: counts of every word, and counts of all pairs of neighbouring classes, which are at most
``classes ** 2`` numbers at any size. As these pair counts say all that the objective needs, its gradients are worked out over the whole
corpus at once, noise included, as matrix products. Tasks get the vectors and the ``HEAD`` most frequent words with their counts; counts of rarer
words are joined by Spark, so no vocabulary is broadcast.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, texts
from tidemark.session import cut_lineage

FOLDS, HELD_OUT = 7, 2
#: Classes of single words, classes of endings, characters (bytes) of an ending; the class of the end is 0 and also stands before a text.
FREQUENT, ENDINGS, ENDING = 383, 128, 3
CLASSES = 1 + FREQUENT + ENDINGS
#: Words whose counts tasks hold themselves.
HEAD = 50_000
DIMENSIONS, STEPS, RATE, NOISE = 48, 200, 0.05, 10
#: Strength of the pull of vectors towards zero and of biases towards frequency, as counts that the corpus outweighs.
PRIOR = 5
REMEMBERED = 300_000
END = b"\n"


def tokens_of(text: str) -> list[bytes]:
    """Words in lower case (A-Z only) and the end. ``bytes`` split at the six ASCII blanks and lower ASCII letters alone."""
    return [*text.encode().lower().split(), END]


def ending_class(word: bytes) -> int:
    return 1 + FREQUENT + zlib.crc32(word[-ENDING:]) % ENDINGS


@dataclass
class Model:
    """All that scoring needs but the counts of rare words, whose number follows the corpus."""

    n_tokens: int
    n_distinct: int
    #: Most frequent words first, with counts; the first ``FREQUENT`` have classes of their own.
    head: list[tuple[bytes, int]]
    n_texts: int
    #: Per class: counts of its words plus one for each and one for the unknown ones.
    class_sizes: np.ndarray
    contexts: np.ndarray
    targets: np.ndarray
    bias: np.ndarray

    def log_probabilities(self) -> np.ndarray:
        """log10 of the probability of each class (column) after each (row)."""
        scores = self.contexts @ self.targets.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)


def fit_vectors(pairs: np.ndarray, dimensions: int = DIMENSIONS, steps: int = STEPS, rate: float = RATE, noise: int = NOISE, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context vectors, class vectors and biases that tell the counted ``pairs`` (context, class) from ``noise`` times as many with classes drawn by frequency."""
    n, total = len(pairs), pairs.sum()
    pick = np.random.default_rng(12)
    if not total:
        return np.zeros((n, dimensions)), np.zeros((n, dimensions)), np.zeros(n)
    seen = pairs / total
    drawn = (pairs.sum(axis=0) + 0.5) / (total + 0.5 * n)
    unseen = noise * np.outer(seen.sum(axis=1), drawn)
    level = np.log(noise)  # biases are counted from the log of a class' frequency
    values = [pick.normal(0, 0.1, (n, dimensions)), pick.normal(0, 0.1, (n, dimensions)), np.zeros(n)]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        contexts, targets, bias = values
        real = 1 / (1 + np.exp(np.clip(level - contexts @ targets.T - bias, -50, 50)))
        pull = seen * (1 - real) - unseen * real
        slopes = [g - prior / total * v for g, v in zip((pull @ targets, pull.T @ contexts, pull.sum(axis=0)), values)]
        now = rate * (1 - (step - 1) / steps)
        for v, m, s, g in zip(values, means, squares, slopes):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-12)
    return values[0], values[1], values[2] + np.log(drawn)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts, counted block by block before the shuffle. The end is not among them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values in blocks(batch):
                counts = Counter()
                for text in values:
                    counts.update(text.encode().lower().split())
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return texts(docs).mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup(dict):
    """Word to number: the place in the head, or ``size + class`` for other words."""

    def __init__(self, words: list[bytes]):
        super().__init__({END: 0} | {w: i for i, w in enumerate(words, 1)})
        self.size, self.rare = len(words) + 1, {}

    def __missing__(self, word: bytes) -> int:
        found = self.rare.get(word)
        if found is None:
            if len(self.rare) >= REMEMBERED:
                self.rare.clear()
            found = self.rare[word] = self.size + ending_class(word)
        return found

    def classes(self) -> np.ndarray:
        """Class of every number."""
        own = [0, *(i if i <= FREQUENT else ending_class(w) for i, w in enumerate(list(self)[1:], 1))]
        return np.array([*own, *range(CLASSES)])


def _numbers(values: list[str], lookup: Lookup) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(numbers of all tokens of the texts one after another, the tokens, where each text begins)."""
    words, sizes = [], []
    for text in values:
        more = tokens_of(text)
        words += more
        sizes.append(len(more))
    begins = np.cumsum(sizes) - sizes
    return np.fromiter(map(lookup.__getitem__, words), np.int64, len(words)), words, begins


def _before(classes: np.ndarray) -> np.ndarray:
    """The class before each token; a text follows the end of another, or nothing, which is the same."""
    return np.concatenate([[0], classes[:-1]])


def pair_counts(docs: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """How often each class follows each other one, over all texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, total = Lookup(frequent), np.zeros(CLASSES * CLASSES, np.int64)
        of = lookup.classes()
        for batch in batches:
            for _, values in blocks(batch):
                classes = of[_numbers(values, lookup)[0]]
                total += np.bincount(_before(classes) * CLASSES + classes, minlength=CLASSES * CLASSES)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], names=["cell", "n"])

    found = np.zeros(CLASSES * CLASSES)
    for row in texts(docs).mapInArrow(task, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        found[row.cell] = row.n
    return found.reshape(CLASSES, CLASSES)


def class_totals(counts: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """Per class: the counts of its words, plus one for each of them, plus one."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, total = Lookup(frequent), np.zeros(CLASSES)
        of = lookup.classes()
        for batch in batches:
            numbers = np.fromiter((lookup[w.encode()] for w in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            total += np.bincount(of[numbers], batch.column(1).to_numpy() + 1.0, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES), pa.int32()), pa.array(total.astype(np.int64), pa.int64())], names=["class", "n"])

    found = np.ones(CLASSES)
    for row in counts.select("word", "n").mapInArrow(task, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        found[row["class"]] += row.n
    return found


def fit_model(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of all texts of ``docs`` (NULL: empty), and their word counts ``word, n``. Without texts all classes are alike."""
    counts = cut_lineage(word_counts(docs))
    told = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    n_texts = docs.count()
    head = [(r.word.encode(), r.n) for r in counts.orderBy(F.desc("n"), "word").limit(HEAD).collect()]
    frequent = [w for w, _ in head[:FREQUENT]]
    vectors = fit_vectors(pair_counts(docs, frequent))
    return Model(told.n + n_texts, told.v + (n_texts > 0), head, n_texts, class_totals(counts, frequent), *vectors), counts


PARTS = "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<string>, times array<int>"


def _partial_scores(docs: DataFrame, model: Model) -> DataFrame:
    """What tasks can say by themselves, and the words whose counts they don't have. ``row`` tells rows apart, those with one id too."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup([w for w, _ in model.head])
        of, table = lookup.classes(), model.log_probabilities().ravel()
        counts = np.array([model.n_texts, *(n for _, n in model.head), *[0] * CLASSES])
        logs = np.log10(counts + 1.0)
        shared = of > FREQUENT
        within = np.where(shared, logs - np.log10(model.class_sizes)[of], 0.0)  # of rare words without their count
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for ids, values in blocks(batch):
                numbers, words, begins = _numbers(values, lookup)
                classes = of[numbers]
                known = np.add.reduceat((counts[numbers] > 0).astype(np.int64), begins)
                base = np.add.reduceat(logs[numbers], begins)
                score = np.add.reduceat(table[_before(classes) * CLASSES + classes] + within[numbers], begins)
                rare = [Counter() for _ in values]
                places = np.flatnonzero(numbers >= lookup.size)
                for i, d in zip(places.tolist(), (np.searchsorted(begins, places, "right") - 1).tolist()):
                    rare[d][words[i]] += 1
                columns = {
                    "row": np.arange(row, row + len(ids)),
                    "doc_id": ids,
                    "n_tokens": np.diff([*begins, len(words)]),
                    "known": known,
                    "base": base,
                    "score": score,
                    "rare": [[w.decode() for w in c] for c in rare],
                    "times": [list(c.values()) for c in rare],
                }
                row += len(ids)
                kinds = {"base": pa.float64(), "score": pa.float64(), "rare": pa.list_(pa.string()), "times": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()], names=list(columns))

    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(task, PARTS)


def score_texts(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row: log10 probabilities by single-word counts and by the model.

    A NULL or empty text is its end alone; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    parts = cut_lineage(_partial_scores(docs, model))
    words = parts.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    found = words.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    joined = parts.drop("rare", "times").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    each = float(np.log10(model.n_tokens + model.n_distinct + 1))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
