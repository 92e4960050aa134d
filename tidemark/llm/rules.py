"""Quality rules: plain text counts, and a hashed n-gram log-likelihood ratio against a trusted target.

The ratio compares two multinomials over hashed n-grams: that of trusted documents and that of the whole raw corpus. The n-grams are
single words and pairs of neighbouring words, each word reduced to its last ``ENDING`` characters so that rare words count too.
A document's sum is divided by its number of n-grams; one fixed threshold decides, for every document alike.
Everything is built of column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD

#: Hash buckets of the multinomials.
BUCKETS = 1 << 14
ENDING = 3
#: Documents whose mean log ratio is lower are rejected.
THRESHOLD = -0.5
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def with_counts(docs: DataFrame) -> DataFrame:
    """Add ``words``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` to documents.

    The steps are separate projections that name a helper column more than once, so none is worked out again inside a lambda.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    less = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    docs = docs.withColumns({
        "words": words_of(text),
        "word_chars": (F.length(text) - less(BLANKS)).cast("long"),
        "n_symbols": less(SYMBOLS).cast("long"),
        "lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)),
    })
    docs = docs.withColumns({"n_words": F.size("words").cast("long"), "hashes": F.transform("words", lambda w: F.xxhash64(w)), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
    at = lambda i, k: F.get("hashes", i + k)
    whole = F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), lambda i: F.xxhash64(*(at(i, k) for k in range(WINDOW))))
    docs = docs.withColumn("windows", F.when(F.size("hashes") >= WINDOW, whole))
    docs = docs.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    docs = docs.withColumn("sorted", F.when(F.col("repeats"), F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    neighbour = lambda k: F.coalesce(F.get("sorted", k)["h"], F.lit(None).cast("long"))
    twice = F.filter("sorted", lambda s, k: s["h"].eqNullSafe(neighbour(k - 1)) | s["h"].eqNullSafe(neighbour(k + 1)))
    docs = docs.withColumn("places", F.array_sort(F.transform(twice, lambda s: s["i"])))
    gaps = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda done, gap: done + gap)
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("lines", "hashes", "windows", "repeats", "sorted", "places")


def with_grams(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Add ``grams``, the buckets of all n-grams of ``words``."""
    docs = docs.withColumn("ends", F.transform("words", lambda w: F.xxhash64(F.substring(w, -ENDING, ENDING))))
    one = F.transform("ends", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform("ends", lambda h, i: F.pmod(F.xxhash64(F.get("ends", i - 1), h), F.lit(buckets)).cast("int"))
    pairs = F.when(F.size("ends") > 1, F.slice(two, F.lit(2), F.size("ends") - 1)).otherwise(F.array().cast("array<int>"))
    return docs.withColumn("grams", F.concat(one, pairs)).drop("ends")


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, weight``: log of the target's share over the raw corpus' share, each with half a count added per bucket.

    ``trusted_ids``: distinct ``doc_id``; the target counts every one of these documents, the raw corpus all. Documents and ids meet by a shuffle at any
    size, as ids grow with the documents and nothing that is sent to every task may; a partition's ids are the hashed side, so no text is sorted.
    Every bucket has a row. The number of buckets is fixed: the weights reach the tasks as one array, whose size then does not follow the input.
    """
    fitted = trusted_ids.select("doc_id", F.lit(1).alias("trusted"))
    known = docs.select("doc_id", "text").join(fitted.hint("shuffle_hash"), "doc_id", "left")
    read = known.select("trusted", words_of(F.coalesce(F.col("text"), F.lit(""))).alias("words"))
    # the outer form: the plain one adds a filter on the array's size, which would be worked out a second time, inside out
    grams = with_grams(read, buckets).select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode_outer("grams").alias("bucket")).filter("bucket IS NOT NULL")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("trusted"), F.lit(0).alias("one"))
    counts = grams.withColumn("one", F.lit(1)).select("bucket", "trusted", "one").unionByName(every)
    counts = counts.groupBy("bucket").agg((F.sum("one") + 0.5).alias("raw"), (F.sum("trusted") + 0.5).alias("target"))
    totals = F.sum("target").over(_all()), F.sum("raw").over(_all())
    return counts.select("bucket", (F.log(F.col("target") / totals[0]) - F.log(F.col("raw") / totals[1])).alias("weight"))


def _all():
    """All rows in one window: only ever over one row per bucket."""
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(0))


def apply_rules(docs: DataFrame, ratios: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``score`` (mean log ratio) and ``kept``.

    A NULL or empty text has no words and fails; repeated rows are judged each; an empty table gives no rows.
    ``ratios`` holds one row per bucket and reaches the tasks as one array.
    """
    weights = ratios.agg(F.array_sort(F.collect_list(F.struct("bucket", "weight"))).alias("all")).select(F.col("all.weight").alias("weights"))
    docs = with_grams(with_counts(docs.select("doc_id", "text")).drop("text"), buckets).withColumn("weights", weights.scalar())
    total = F.aggregate("grams", F.lit(0.0), lambda done, g: done + F.get("weights", g))
    docs = docs.withColumn("score", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    docs = docs.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
