"""Shards, manifests and request batches over the given tables.

A row's place in a batch is (first four hex digits of md5(id), id) in Spark and in the SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.documents import route_by_status
from tidemark.plans import inputs as X
from tidemark.plans.documents import CUSTOMER_DOCUMENTS, ROUTED, customer_documents, flat
from tidemark.plans.registry import query
from tidemark.session import run_folder
from tidemark.sinks import batching as B
from tidemark.sinks import shards as S


def _place(key: str) -> str:
    return f"(row_number() OVER (ORDER BY substr(md5(CAST({key} AS VARCHAR)), 1, 4), {key}) - 1)"


@query(
    "jsonl_shards",
    f"SELECT id, body, mime_type, metadata, readers FROM ({CUSTOMER_DOCUMENTS})",
)
def jsonl_shards(spark, sf):
    """Documents written as import lines of at most 200 per file, then read back."""
    folder = run_folder(spark, "shards")
    S.write_jsonl(customer_documents(spark, sf), folder, 200)
    read = S.read_jsonl(spark, folder).withColumn("body", F.decode("body", "UTF-8"))
    return flat(read, "id", "body", "mime_type", "metadata")


@query(
    "import_manifest",
    f"""WITH shards AS (SELECT '/landing/' || source || '/' || lang || '/shard-' || lpad(CAST(doc_id // 5 AS VARCHAR), 5, '0') AS uri, count(*) AS docs
FROM documents GROUP BY ALL),
placed AS (SELECT *, {_place("uri")} // 100 AS part FROM shards)
SELECT 'run-1' AS run_id, 'FULL' AS mode, CAST(part AS BIGINT) AS part, (SELECT CAST(ceil(count(*) / 100) AS BIGINT) FROM shards) AS parts,
count(*) AS files, CAST(sum(docs) AS BIGINT) AS docs, string_agg(uri, '|' ORDER BY uri) AS uris FROM placed GROUP BY part""",
)
def import_manifest(spark, sf):
    folder = F.concat(F.lit("/landing/"), "source", F.lit("/"), "lang", F.lit("/shard-"))
    number = F.lpad(F.floor(F.col("doc_id") / 5).cast("string"), 5, "0")
    shards = X.table(spark, sf, "documents").groupBy(F.concat(folder, number).alias("uri")).agg(F.count("*").alias("docs"))
    manifest = S.import_manifest(shards, "run-1", "FULL")
    return manifest.withColumn("uris", F.array_join("uris", "|")).withColumn("docs", F.col("docs").cast("bigint"))


@query(
    "inline_batches",
    X.sql_with(
        "articles",
        f"""SELECT id, CAST({_place("id")} // 100 AS BIGINT) AS batch FROM ({ROUTED}) WHERE action = 'upsert'""",
    ),
)
def inline_batches(spark, sf):
    upserts = route_by_status(X.articles(spark, sf)).where("action = 'upsert'").select("id")
    return B.numbered_batches(upserts, "id", K.DOCS_PER_INLINE_REQUEST)


LIMIT_BYTES = 60_000
LIMIT_ROWS = 50


@query(
    "size_bounded_shards",
    f"""WITH sized AS (SELECT doc_id, octet_length(encode(text)) AS bytes FROM documents),
placed AS (SELECT *, bytes > {LIMIT_BYTES // 2} AS solo, {_place("doc_id")} AS idx,
  coalesce(sum(CASE WHEN bytes > {LIMIT_BYTES // 2} THEN 0 ELSE bytes END) OVER (ORDER BY substr(md5(CAST(doc_id AS VARCHAR)), 1, 4), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)
SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, solo,
CASE WHEN NOT solo THEN CAST(start // {LIMIT_BYTES // 2} + idx // {LIMIT_ROWS} AS BIGINT) END AS batch FROM placed""",
)
def size_bounded_shards(spark, sf):
    """Batches of at most 60 kB of text and 50 documents."""
    documents = X.table(spark, sf, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    return B.size_bounded_batches(documents, "doc_id", F.col("bytes"), LIMIT_ROWS, LIMIT_BYTES).select(
        "doc_id", "bytes", "solo", "batch"
    )


@query(
    "purge_batches",
    f"""WITH gone AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
placed AS (SELECT doc_id, {_place("doc_id")} // 250 AS batch FROM gone)
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS ids,
'id: ANY(' || string_agg('"' || doc_id || '"', ',' ORDER BY CAST(doc_id AS VARCHAR)) || ')' AS filter FROM placed GROUP BY batch""",
)
def purge_batches(spark, sf):
    from tidemark.operators.changes import missing_ids

    gone = missing_ids(X.table(spark, sf, "documents"), X.table(spark, sf, "labels"), "doc_id")
    return B.purge_requests(gone, "doc_id", 250)


@query(
    "purge_lines",
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, CAST({_place("CAST(doc_id AS VARCHAR)")} // 250 AS BIGINT) AS request FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def purge_lines(spark, sf):
    from tidemark.operators.changes import missing_ids

    return B.purge_lines(missing_ids(X.table(spark, sf, "documents"), X.table(spark, sf, "labels"), "doc_id"), "doc_id", 250)


@query(
    "mapping_batches",
    X.sql_with(
        "mappings",
        f""", keyed AS (SELECT concat_ws('|', external_identity, coalesce(target_user, ''), coalesce(target_group, '')) AS entry FROM mappings),
placed AS (SELECT entry, {_place("entry")} // 100 AS batch FROM keyed)
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS entries, string_agg(entry, ',' ORDER BY entry) AS listed FROM placed GROUP BY batch""",
    ),
)
def mapping_batches(spark, sf):
    """Identity rows in requests of 100."""
    blank = F.lit("")
    entry = F.concat_ws("|", "external_identity", F.coalesce("target_user", blank), F.coalesce("target_group", blank))
    entries = X.mappings(spark, sf).select(entry.alias("entry"))
    batches = B.numbered_batches(entries, "entry", K.MAPPINGS_PER_REQUEST)
    return batches.groupBy("batch").agg(
        F.count("*").alias("entries"), F.array_join(F.sort_array(F.collect_list("entry")), ",").alias("listed")
    )
