"""Personal data: overlapping candidates, boosted trees on format and context, calibrated thresholds.

Fixed formats (the base) are found by their patterns and checks and always reported. Beside them, high-recall generators
propose looser spans. Every candidate has a few binned features of its format and of the text around it, and a weak label: whether it passes the
check of a fixed format. The whole table is reduced to counts per combination of bins, a grid whose size does not depend on the
data; gradient-boosted trees are fitted to that grid, and become one column expression. A generator's
threshold is the lowest score from which on its candidates pass their check often enough. Candidates above it that fail the check
themselves (a card number with a digit wrong, an address written with "[at]") are added where they overlap nothing else.

Spans are found without a function that gives positions: the text is split at the matches, and lengths are summed up in blocks.
Patterns repeat possessively, so long runs cost no recursion. Everything is built of column functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of kinds where spans start together; the first four are the base.
KINDS = ["email", "ip", "card", "phone", "address", "number", "iban"]
BASE = KINDS[:4]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
PATTERNS = {
    "email": EMAIL,
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)++",
    "number": r"\+?[0-9](?:[\x20().-]{0,2}[0-9])++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
CUES = r"(?i)(mail|phone|tel|call|card|contact|iban|account|address)"
OTHER_CUES = r"(?i)(token|key|hash|id|sum|version|isbn)"
BLOCK = 64
AROUND = 24
#: Bins of each feature.
FEATURES = {"generator": 3, "digits": 7, "marks": 4, "plus": 2, "dots": 3, "before": 4, "after": 4, "cue": 3}
#: Share of a generator's candidates above its threshold that pass a fixed check, at least.
PRECISION = 0.9


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.when(n.between(12, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _mod97(match: Column) -> Column:
    """The check of international account numbers: country and check digits last, letters as 10 to 35, rest 1."""
    bare = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def holds(kind: str, match: Column) -> Column:
    """Whether a match passes its kind's fixed check; for the loose kinds, that of any base kind it could be."""
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return _luhn(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "address":
        return match.rlike(f"^{EMAIL}$")
    if kind == "number":
        return _luhn(_digits(match)) | (match.startswith("+") & n.between(9, 15)) | holds("ip", match)
    if kind == "iban":
        return _mod97(match)
    return F.lit(True)


def with_matches(docs: DataFrame, kind: str) -> DataFrame:
    """Add ``<kind>``: all leftmost matches that do not overlap, as (match, start, stop, before, after)."""
    found, gaps, lens, sums = (f"_{x}" for x in ("found", "gaps", "lens", "sums"))
    pattern = F.lit(PATTERNS[kind])
    docs = docs.withColumn(found, F.regexp_extract_all("text", pattern, F.lit(0)))
    some = F.size(found) > 0
    docs = docs.withColumn(gaps, F.when(some, F.split("text", pattern, -1)))
    docs = docs.withColumn(lens, F.when(some, F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))))
    add = lambda a, b: a + b
    block_of = lambda values, b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), add)
    n_blocks = F.ceil(F.size(found) / BLOCK).cast("int")
    per_block = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: block_of(lens, b))
    docs = docs.withColumn(sums, F.when(some, per_block))
    bases = F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), add))
    docs = docs.withColumn("_bases", F.when(some & (F.size(sums) > 0), bases))

    def span(m: Column, i: Column) -> Column:
        b = F.floor(i / BLOCK).cast("int")
        start = F.get("_bases", b) + F.aggregate(F.slice(lens, b * BLOCK + 1, i - b * BLOCK), F.lit(0), add) + F.length(F.get(gaps, i))
        before, after = F.get(gaps, i), F.get(gaps, i + 1)
        return F.struct(m.alias("match"), start.alias("start"), (start + F.length(m)).alias("stop"), F.substring(before, -AROUND, AROUND).alias("before"), F.substring(after, 1, 1).alias("after"))

    docs = docs.withColumn(kind, F.when(some, F.transform(found, span)).otherwise(F.array().cast("array<struct<match:string,start:int,stop:int,before:string,after:string>>")))
    return docs.drop(found, gaps, lens, sums, "_bases")


def _binned(value: Column, cuts: list[int]) -> Column:
    out = F.lit(len(cuts))
    for i, c in reversed(list(enumerate(cuts))):
        out = F.when(value < c, i).otherwise(out)
    return out


def _kind_of(char: Column) -> Column:
    return F.when(char == "", 0).when(char.rlike(r"[\s\"'(\[<:]"), 1).when(char.rlike("[.,;!?)]"), 2).otherwise(3)


def features(kind: str, c: Column) -> dict[str, Column]:
    """Bins of a candidate's format and context; the check itself is none of them."""
    match = c["match"]
    n = F.length(_digits(match))
    return {
        "generator": F.lit(KINDS.index(kind) - len(BASE)),
        "digits": _binned(n, [1, 9, 12, 14, 16, 17]),
        "marks": _binned(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), [1, 2, 5]),
        "plus": match.startswith("+").cast("int"),
        "dots": _binned(F.length(match) - F.length(F.replace(match, F.lit("."), F.lit(""))), [1, 3]),
        "before": _kind_of(F.substring(c["before"], -1, 1)),
        "after": _kind_of(c["after"]),
        "cue": F.when(c["before"].rlike(CUES), 1).when(c["before"].rlike(OTHER_CUES), 2).otherwise(0),
    }


@dataclass
class Trees:
    """Boosted trees of depth two: (feature, cut, side) pairs lead to a leaf."""

    prior: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, f: dict[str, Column]) -> Column:
        total = F.lit(float(self.prior))
        for (a, ca), (b, cb, low1, high1), (c, cc, low2, high2) in self.trees:
            left = F.when(f[b] < cb, float(low1)).otherwise(float(high1))
            right = F.when(f[c] < cc, float(low2)).otherwise(float(high2))
            total = total + F.when(f[a] < ca, left).otherwise(right)
        return total


def _split(x: np.ndarray, names: list[str], rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, str, int]:
    """Best (gain, feature, cut) of some grid rows."""
    best = (-1.0, names[0], 0)
    gain = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1.0)
    for k, name in enumerate(names):
        for cut in range(1, FEATURES[name]):
            low = rows & (x[:, k] < cut)
            best = max(best, (float(gain(low) + gain(rows & ~low) - gain(rows)), name, cut))
    return best


def fit_trees(grid: list[tuple[list[int], int, int]], rounds: int = 12, rate: float = 0.5) -> Trees:
    """Fit to (bins, candidates, candidates that pass); Newton leaves, and a threshold for each generator.

    A generator none of whose best scores reach the precision gets no threshold, and nothing of it is added, account numbers that pass their check included.
    """
    names = list(FEATURES)
    x = np.array([bins for bins, _, _ in grid], int).reshape(-1, len(names))
    n, good = (np.array([row[i] for row in grid], float) for i in (1, 2))
    if not good.sum():
        return Trees()
    if good.sum() == n.sum():  # nothing to tell apart: every score is the lowest
        return Trees(thresholds=dict.fromkeys(sorted(set(x[:, 0].tolist())), 0.0))
    share = good.sum() / n.sum()
    model = Trees(float(np.log(share / (1 - share))))
    f = np.full(len(grid), model.prior)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = good - n * p, n * p * (1 - p)
        leaf = lambda rows: float(rate * g[rows].sum() / (h[rows].sum() + 1.0))  # noqa: E731,B023
        every = np.ones(len(grid), bool)
        _, a, ca = _split(x, names, every, g, h)
        halves, parts = [], (x[:, names.index(a)] < ca, x[:, names.index(a)] >= ca)
        step = np.zeros(len(grid))
        for part in parts:
            _, b, cb = _split(x, names, part, g, h)
            low = part & (x[:, names.index(b)] < cb)
            halves.append((b, cb, leaf(low), leaf(part & ~low)))
            step += np.where(low, halves[-1][2], 0) + np.where(part & ~low, halves[-1][3], 0)
        model.trees.append(((a, ca), *halves))
        f = f + step
    for kind in range(FEATURES["generator"]):
        of = np.flatnonzero(x[:, 0] == kind)
        order = of[np.argsort(-f[of], kind="stable")]
        if len(order):
            passed = np.cumsum(good[order]) / np.cumsum(n[order])
            last = np.append(np.diff(f[order]) != 0, True)
            enough = np.flatnonzero((passed >= PRECISION) & last)
            if len(enough):
                model.thresholds[kind] = float(f[order][enough[-1]])
    return model


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _proposed(docs: DataFrame) -> DataFrame:
    for kind in KINDS[len(BASE) :]:
        docs = with_matches(docs, kind)
    return docs


def _wide_enough(kind: str, c: Column) -> Column:
    return F.length(_digits(c["match"])).between(9, 22) if kind == "number" else F.lit(True)


def _of(kind: str, run) -> Callable[[Column], Column]:
    """``run(kind, span)`` as a function of the span alone."""
    return lambda c: run(kind, c)


def _kept(kind: str, test) -> Column:
    return F.filter(kind, _of(kind, test))


def _cell(kind: str, c: Column) -> Column:
    return F.struct(*(v.alias(n) for n, v in features(kind, c).items()), holds(kind, c["match"]).cast("int").alias("good"))


def _valid(kind: str, c: Column) -> Column:
    return holds(kind, c["match"])


def _addable(kind: str, c: Column) -> Column:
    """What no base kind covers: account numbers that pass their check, and other candidates that do not pass theirs."""
    return _wide_enough(kind, c) & (_valid(kind, c) if kind == "iban" else ~_valid(kind, c))


def fit_pii(docs: DataFrame) -> Trees:
    """Count all candidates of all documents by their bins, and fit. The driver gets at most the grid's cells."""
    proposed = _proposed(_prepared(docs))
    rows = [F.transform(_kept(kind, _wide_enough), _of(kind, _cell)) for kind in KINDS[len(BASE) :]]
    # the outer form adds no filter on the array's size, which would work everything out twice
    grid = proposed.select(F.explode_outer(F.concat(*rows)).alias("c")).filter("c IS NOT NULL").groupBy(*(f"c.{n}" for n in FEATURES)).agg(F.count("*").alias("n"), F.sum("c.good").alias("good"))
    return fit_trees(sorted(([r[n] for n in FEATURES], r.n, r.good) for r in grid.collect()))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")


def _plain(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))


def scan_pii(docs: DataFrame, model: Trees) -> DataFrame:
    """Per document: counts of the base kinds, ``base_sha256`` and ``spans``, offsets in code points.

    A NULL text counts as empty and has no spans; repeated rows are scanned each; an empty table gives no rows.
    """
    docs = _prepared(docs)
    for kind in BASE:
        docs = with_matches(docs, kind).withColumn(kind, _kept(kind, _valid))
    docs = docs.withColumn("base", F.array_sort(F.concat(*(_plain(kind, F.col(kind)) for kind in BASE))))
    added = []
    for i, kind in enumerate(KINDS[len(BASE) :]):
        if i in model.thresholds:
            docs = with_matches(docs, kind)
            docs = docs.withColumn(kind, _kept(kind, _addable))
            chosen = _kept(kind, lambda k, c, t=model.thresholds[i]: model.score(features(k, c)) >= t)
            docs = docs.withColumn(kind, F.when(F.size(kind) > 0, chosen).otherwise(F.col(kind)))
            free = F.filter(kind, lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (b["stop"] > c["start"])))
            docs = docs.withColumn(kind, F.when((F.size(kind) > 0) & (F.size("base") > 0), free).otherwise(F.col(kind)))
            added.append(_plain(kind, F.col(kind)))
    if added:
        docs = docs.withColumn("added", F.array_sort(F.concat(*added)))
        apart = F.aggregate(
            "added",
            F.struct(F.lit(0).alias("free"), F.filter("added", lambda _: F.lit(False)).alias("kept")),
            lambda done, s: F.when(s["start"] >= done["free"], F.struct(s["stop"].alias("free"), F.array_append(done["kept"], s).alias("kept"))).otherwise(done),
            lambda done: done["kept"],
        )
        docs = docs.withColumn("every", F.when(F.size("added") > 0, F.array_sort(F.concat("base", apart))).otherwise(F.col("base")))
    else:
        docs = docs.withColumn("every", F.col("base"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE]
    return docs.select("doc_id", *counts, F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(F.col("every")).alias("spans"))
