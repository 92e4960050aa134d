"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words at most one edit apart, the shorter one (of equals, the lesser) gives two disjoint chunks, its halves; the other gives its positional grams. One
edit leaves a chunk as it is, and moves it by one place at most, so a pair meets in (length, chunk number, characters) at a place the edit allows,
and is verified. The shift is settled in the key: against a partner of equal length grams stand at the chunk's own place, against one
a character shorter the second chunk is looked for one place on. Should both chunks be there, only the first counts, so no pair is met twice.

A word's form is its near word of largest count if that is twice its own or more; forms of forms are followed by doubling steps. Counts rise at least twofold along
a chain of forms, so few steps suffice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT, FORM_FACTOR = 5, 3, 2
#: One run in so many loses a character.
DAMAGE = 97


def runs_of(text: Column) -> Column:
    """All maximal runs of letters, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(RUN), F.lit(0))


def word_counts(docs: DataFrame, damage: int | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of ``min_chars`` characters and ``min_count`` occurrences.

    With ``damage``, a run whose CRC-32 with its document's id that number divides loses the character at CRC-32 modulo length. NULL texts have no
    words; a NULL doc_id is an empty name; repeated rows count each.
    """
    runs = F.filter(runs_of(F.coalesce("text", F.lit(""))), lambda r: F.length(r) >= min_chars)
    # the outer form: the plain one adds a filter on the array's size, which would be worked out a second time
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.explode_outer(runs).alias("run")).filter("run IS NOT NULL")
    if damage:
        found = found.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        found = found.withColumn("run", F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")))
    counts = found.filter(F.length("run") >= min_chars).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _key(length: Column, chunk: int, characters: Column) -> Column:
    return F.struct(length.alias("length"), F.lit(chunk).alias("chunk"), characters.alias("characters"))


def chunks_of(word: Column) -> Column:
    """The two halves of a word, with its length."""
    n, half = F.length(word), F.floor(F.length(word) / 2).cast("int")
    return F.array(_key(n, 1, F.substring(word, F.lit(1), half)), _key(n, 2, F.substring(word, half + 1, n)))


def grams_of(word: Column) -> Column:
    """The grams of a word where the chunks of a partner of the same length, or one character less, may stand."""
    n = F.length(word)
    keys = []
    for less in (0, 1):
        half = F.floor((n - less) / 2).cast("int")
        keys.append(_key(n - less, 1, F.substring(word, F.lit(1), half)))
        keys.append(_key(n - less, 2, F.substring(word, half + 1 + less, n)))
    return F.array(*keys)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: every two words exactly one edit apart, once; ``words``: distinct ``word``, and ``n``."""
    left = words.select(F.explode(chunks_of(F.col("word"))).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = words.select(F.explode(grams_of(F.col("word"))).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    left, right = (side.select("key.*", *side.columns[1:]) for side in (left, right))
    half = F.floor(F.length("a") / 2).cast("int")
    both = F.substring("b", F.lit(1), half) == F.substring("a", F.lit(1), half)
    once = ((F.col("chunk") == 1) | ~both) & ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
    met = left.join(right, ["length", "chunk", "characters"]).filter(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "n_a", "n_b")


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root`` to ``word, form, ...``: where the forms lead, or the word itself without one."""
    steps, before = cut_lineage(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))), None
    while True:
        told = steps.agg(F.count("*"), F.sum(F.xxhash64("word", "root").cast("decimal(38,0)"))).first()
        if told == before or not told[0]:
            return forms.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
        before, on = told, steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = cut_lineage(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))


def group_variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct ``word, n``. Of near words with equal counts the least in code-point order is taken."""
    words = cut_lineage(words.select("word", "n"))
    pairs = cut_lineage(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    large = -F.col("best.less") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"))
    return with_roots(cut_lineage(known)).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """Variant groups of the words of all whole texts. An empty table gives no rows; other columns are ignored."""
    return group_variants(word_counts(docs, damage))
