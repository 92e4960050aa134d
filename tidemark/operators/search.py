"""Data preparation for retrieval: facets, boosts, vectors and batch keyword search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.session import cut_lineage


def _array_facet(name: str) -> Column:
    return F.transform(
        F.array_distinct(name), lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))
    )


def facet_counts(documents: DataFrame, facets: list[str], arrays: list[str] = ()) -> DataFrame:
    """Documents per facet value. Distinct facet combinations are counted first, in
    one pass, and only their counts are unpivoted."""
    combos = documents.groupBy(*facets, *arrays).agg(F.count("*").alias("n"))
    pairs = [F.array(F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value"))) for f in facets]
    pairs += [_array_facet(a) for a in arrays]
    long = combos.select(F.explode(F.concat(*pairs)).alias("p"), "n").select("p.*", "n")
    return long.groupBy("facet", "value").agg(F.sum("n").cast("bigint").alias("docs"))


def boosted_rank(scored: DataFrame, group: str, score: Column, tie: str, k: int) -> DataFrame:
    """The ``k`` best rows per group. Spark keeps at most ``k`` rows per group and task
    before the shuffle, so a group of any size costs ``k`` rows."""
    order = W.partitionBy(group).orderBy(F.desc("score"), tie)
    ranked = scored.withColumn("score", score).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def attach_embeddings(documents: DataFrame, vectors: DataFrame, dimension: int) -> DataFrame:
    """Documents with their vector, if any, and a check of its length."""
    joined = documents.join(vectors.withColumnRenamed("vec_id", "doc_id"), "doc_id", "left")
    length = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    return joined.withColumn("dimension", length).withColumn(
        "dimension_ok", F.coalesce(length == dimension, F.lit(False))
    )


def keyword_matches(documents: DataFrame, queries: DataFrame, since: Column | None = None) -> DataFrame:
    """(query_id, doc_id, score) for documents that hold every word of a query (an action).

    ``since`` is a condition on documents, such as newer than a mark; it is applied before their texts are read. Texts are read and cut into words
    once: words that some query has are counted per document and written, and all that follows comes from these counts. Candidates come from each query's rarest
    word alone, so common words never pair documents with queries; a candidate is then checked for all words. ``score`` is the number of query word
    occurrences in the document.

    Vocabulary, counts and candidates are written as tables. Their real size then decides the joins: a broadcast, or a shuffle where they are large.
    """
    wanted = queries.select("query_id", F.array_distinct(tokens(F.col("text"))).alias("words")).where("size(words) > 0")
    query_words = cut_lineage(wanted.select("query_id", F.size("words").alias("n_words"), F.explode("words").alias("word")))
    read = documents if since is None else documents.where(since)
    found = read.select("doc_id", F.explode(tokens(F.col("text"))).alias("word")).join(query_words.select("word").distinct(), "word", "left_semi")
    counts = cut_lineage(found.groupBy("doc_id", "word").agg(F.count("*").alias("times")))
    frequency = counts.groupBy("word").agg(F.count("*").alias("df"))
    # A word no document holds has no frequency; NULL sorts first, and the query finds nothing.
    counted = query_words.join(frequency, "word", "left")
    rarest = counted.groupBy("query_id").agg(F.min_by("word", F.struct("df", "word")).alias("word"))
    candidates = cut_lineage(counts.join(rarest, "word").select("query_id", "doc_id"))
    held = candidates.join(query_words, "query_id").join(counts, ["doc_id", "word"])
    scored = held.groupBy("query_id", "doc_id").agg(F.count("*").alias("n"), F.first("n_words").alias("n_words"), F.sum("times").alias("score"))
    return scored.where("n = n_words").select("query_id", "doc_id", "score")


def top_hits(matches: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def secure_search(matches: DataFrame, visible: DataFrame, k: int) -> DataFrame:
    """Best hits among the documents the asker may read; the filter comes before the cut."""
    return top_hits(matches.join(visible, "doc_id", "left_semi"), k)


def citations(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Title, link and date of each hit. Hits are few; the document side is read narrow."""
    return hits.join(documents.select("doc_id", "title", "source_url", "updated_at"), "doc_id")
