"""Retrieval-side preparation over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import access as O
from tidemark.operators import search as R
from tidemark.plans import inputs as X
from tidemark.plans.access import VISIBLE, held_by_asker
from tidemark.plans.registry import query

TOP = 3


@query(
    "facet_counts",
    """SELECT 'lang' AS facet, lang AS value, count(*) AS docs FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'kinds', k, count(*) FROM (SELECT doc_id, unnest(list_distinct([lang, source])) AS k FROM documents) GROUP BY k""",
)
def facet_counts(spark, sf):
    documents = X.table(spark, sf, "documents").select("lang", "source", F.array("lang", "source").alias("kinds"))
    return R.facet_counts(documents, ["lang", "source"], ["kinds"])


@query(
    "boosted_rank",
    """SELECT * FROM (SELECT lang, doc_id, score, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS INT) AS rank FROM (
SELECT lang, d.doc_id, d.doc_id + 500 * coalesce(quality, 0) + CASE WHEN source = 'src0' THEN 250 ELSE 0 END AS score
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)) WHERE rank <= 20""",
)
def boosted_rank(spark, sf):
    """Newest first, with boosts for good quality and for the source of truth."""
    documents = X.table(spark, sf, "documents").select("doc_id", "lang", "source")
    labelled = documents.join(X.table(spark, sf, "labels"), "doc_id", "left")
    score = F.col("doc_id") + 500 * F.coalesce("quality", F.lit(0)) + F.when(F.col("source") == "src0", 250).otherwise(0)
    return R.boosted_rank(labelled, "lang", score, "doc_id", 20).select("lang", "doc_id", "score", "rank")


@query(
    "embedding_attach",
    """SELECT doc_id, label, CAST(len(embedding) AS INT) AS dimension, coalesce(len(embedding) = 64, false) AS dimension_ok
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
)
def embedding_attach(spark, sf):
    documents = X.table(spark, sf, "documents").select("doc_id")
    attached = R.attach_embeddings(documents, X.table(spark, sf, "embeddings"), 64)
    return attached.select("doc_id", "label", "dimension", "dimension_ok")


_MATCHES = r"""WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS found FROM documents),
item AS (SELECT item_id AS query_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS words FROM benchmark),
matches AS (SELECT query_id, doc_id, CAST(len(list_filter(found, lambda w: list_contains(words, w))) AS BIGINT) AS score
FROM item JOIN doc ON list_has_all(found, words) WHERE len(words) > 0)"""


def _top(source: str) -> str:
    return f"""SELECT * FROM (SELECT query_id, doc_id, score,
CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM {source}) WHERE rank <= {TOP}"""


def _matches(spark, sf, since=None):
    queries = X.table(spark, sf, "benchmark").withColumnRenamed("item_id", "query_id")
    documents = X.table(spark, sf, "documents").select("doc_id", "text", X._hours_after("2024-01-01", "doc_id").alias("updated_at"))
    return R.keyword_matches(documents, queries, since)


@query("keyword_search_topk", _MATCHES + "\n" + _top("matches"))
def keyword_search_topk(spark, sf):
    return R.top_hits(_matches(spark, sf), TOP).select("query_id", "doc_id", "score", "rank")


MARK = "2024-01-20 00:00:00"


@query(
    "keyword_search_newer",
    _MATCHES.replace("FROM documents)", f"FROM documents WHERE TIMESTAMP '2024-01-01' + to_hours(doc_id % 8760) > TIMESTAMP '{MARK}')") + "\n" + _top("matches"),
)
def keyword_search_newer(spark, sf):
    """Best hits among the documents changed after a mark."""
    since = F.col("updated_at") > F.to_timestamp_ntz(F.lit(MARK))
    return R.top_hits(_matches(spark, sf, since), TOP).select("query_id", "doc_id", "score", "rank")


@query(
    "secure_search",
    _MATCHES
    + ", "
    + X.sql_with("doc_principals held", "").removeprefix("WITH ").rstrip()
    + VISIBLE
    + _top("(SELECT * FROM matches WHERE doc_id IN (SELECT doc_id FROM visible))"),
)
def secure_search(spark, sf):
    documents = X.doc_principals(spark, sf)
    visible = O.visible_documents(documents, O.open_classes(documents, held_by_asker(spark, sf)))
    return R.secure_search(_matches(spark, sf), visible, TOP).select("query_id", "doc_id", "score", "rank")


@query(
    "citation_rows",
    _MATCHES
    + ", "
    + X.sql_with("files", "").removeprefix("WITH ").rstrip()
    + f"""SELECT h.query_id, h.rank, f.name AS title, 'https://docs.example.com' || f.path AS source_url, f.updated_at
FROM ({_top("matches")}) h JOIN files f ON f.doc_id = h.doc_id""",
)
def citation_rows(spark, sf):
    documents = X.files(spark, sf).select(
        "doc_id", F.col("name").alias("title"), F.concat(F.lit("https://docs.example.com"), "path").alias("source_url"), "updated_at"
    )
    cited = R.citations(R.top_hits(_matches(spark, sf), TOP), documents)
    return cited.select("query_id", "rank", "title", "source_url", "updated_at")
