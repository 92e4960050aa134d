"""The sync and identity jobs, run over the given tables; their counts and staged rows must equal SQL.

Building these queries runs the jobs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.payload import IMPORT_SCHEMA
from tidemark.plans import inputs as X
from tidemark.plans.identity_job import run_identity_sync
from tidemark.plans.ingest import table_source
from tidemark.plans.registry import query
from tidemark.plans.sync_job import run_sync
from tidemark.session import run_folder
from tidemark.sinks.shard_writer import read_manifest

AT = dt.datetime(2024, 6, 1)
COUNTS = "source string, run int, inserts long, updates long, acl_updates long, deletes long, unchanged long"


def _sync(spark, root, name, sources, modes):
    """One run after the other, each on the state of the one before."""
    current, rows = None, []
    for i, (source, mode) in enumerate(zip(sources, modes), 1):
        known = {} if current is None else {"mirror": current.mirror(spark), "mark": current.watermark}
        current = run_sync(spark, source, root, name, mode, f"r{i}", AT, **known)
        rows.append((name, i, *(current.counts[c] for c in ("insert", "update", "acl", "delete", "same"))))
    return rows


@query(
    "sync_job_rerun",
    """WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders)
SELECT 'customer' AS source, CAST(run AS INTEGER) AS run, CASE WHEN run = 1 THEN n ELSE 0 END AS inserts, CAST(0 AS BIGINT) AS updates,
  CAST(0 AS BIGINT) AS acl_updates, CAST(0 AS BIGINT) AS deletes, CASE WHEN run > 1 THEN n ELSE 0 END AS unchanged FROM c, range(1, 3) AS r(run)
UNION ALL SELECT 'orders', CAST(run AS INTEGER), CASE WHEN run = 1 THEN n ELSE 0 END, 0, 0, 0, CASE WHEN run = 3 THEN n ELSE 0 END FROM o, range(1, 4) AS r(run)""",
)
def sync_job_rerun(spark, sf):
    """Unchanged sources again: a table without a time column, and one where every seventh time is NULL."""
    root = run_folder(spark, "rerun")
    customer = table_source(X.table(spark, sf, "customer"), "main", "sales", "customer", "c_custkey", ["c_name", "c_mktsegment"], ["c_nationkey"])
    timed = X.table(spark, sf, "orders").withColumn("changed", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("timestamp_ntz")))
    orders = table_source(timed, "main", "sales", "orders", "o_orderkey", ["o_orderstatus"], ["o_custkey"], "changed")
    rows = _sync(spark, root, "customer", [customer] * 2, ["incremental"] * 2)
    rows += _sync(spark, root, "orders", [orders] * 3, ["incremental", "incremental", "reconcile"])
    return spark.createDataFrame(rows, COUNTS)


@query(
    "sync_job_late_rows",
    """WITH o AS (SELECT o_orderkey % 50 = 0 AS late, CAST(o_orderdate AS TIMESTAMP) AS stamp FROM orders),
m AS (SELECT max(stamp) AS mark FROM o WHERE NOT late)
SELECT 'orders' AS source, CAST(1 AS INTEGER) AS run, count(*) AS inserts, CAST(0 AS BIGINT) AS updates, CAST(0 AS BIGINT) AS acl_updates,
  CAST(0 AS BIGINT) AS deletes, CAST(0 AS BIGINT) AS unchanged FROM o WHERE NOT late
UNION ALL SELECT 'orders', 2, count(*) FILTER (late), 0, 0, 0, count(*) FILTER (NOT late) FROM o, m WHERE stamp >= mark - INTERVAL 30 DAY""",
)
def sync_job_late_rows(spark, sf):
    """Every fiftieth order is committed after the first run; the second reads thirty days before the mark again."""
    timed = X.table(spark, sf, "orders").withColumn("changed", F.col("o_orderdate").cast("timestamp_ntz"))
    parts = (timed.where("o_orderkey % 50 <> 0"), timed)
    sources = [table_source(t, "main", "sales", "orders", "o_orderkey", ["o_orderstatus"], ["o_custkey"], "changed", overlap_seconds=30 * 86400) for t in parts]
    return spark.createDataFrame(_sync(spark, run_folder(spark, "late"), "orders", sources, ["initial", "incremental"]), COUNTS)


@query(
    "identity_job_removals",
    """SELECT c_mktsegment AS external_identity, c_name AS target_user, 'removes' AS staged FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'VIP', c_name, 'adds' FROM customer WHERE c_custkey % 5 = 0""",
)
def identity_job_removals(spark, sf):
    """Every fifth customer leaves the group of the segment for another: what the second run stages."""
    root = run_folder(spark, "identity")
    customer = X.table(spark, sf, "customer")
    none = F.lit(None).cast("string").alias("target_group")
    before = customer.select(F.col("c_mktsegment").alias("external_identity"), F.col("c_name").alias("target_user"), none)
    moved = F.when(F.col("c_custkey") % 5 == 0, "VIP").otherwise(F.col("c_mktsegment"))
    first = run_identity_sync(spark, before, root, "r1")
    second = run_identity_sync(spark, customer.select(moved.alias("external_identity"), F.col("c_name").alias("target_user"), none), root, "r2", first.mapping(spark))
    staged = [spark.read.parquet(f"{second.folder}/{name}").select("external_identity", "target_user", F.lit(name).alias("staged")) for name in ("removes", "adds")]
    return staged[0].unionByName(staged[1])


@query(
    "sync_shards",
    """WITH built AS (SELECT 'databricks_row:main.corpus.documents:' || doc_id AS id, 'text: ' || text || '.' AS body, CAST(json_object('title', 'documents row ' || doc_id,
  'source', 'databricks_uc_table', 'catalog', 'main', 'schema', 'corpus', 'table', 'documents', 'primary_key', CAST(doc_id AS VARCHAR), 'updated_at', NULL,
  'lang', lang, 'n_chars', n_chars) AS VARCHAR) AS metadata FROM documents),
lines AS (SELECT id, body, '{"id":"' || id || '","structData":' || metadata || ',"content":{"mimeType":"text/plain","rawBytes":"' || to_base64(encode(body))
  || '"},"aclInfo":{"readers":[{"principals":[]}]}}' AS line FROM built)
SELECT id, md5(body) AS body_md5, CAST(octet_length(encode(line)) + 1 AS BIGINT) AS line_bytes, CAST(1 AS BIGINT) AS times_listed, count(*) OVER () AS listed_docs,
  CAST(sum(octet_length(encode(line)) + 1) OVER () AS BIGINT) AS listed_bytes FROM lines""",
)
def sync_shards(spark, sf):
    """What a first sync of the documents staged, read back from the files that its manifest names, and the totals of the manifest."""
    source = table_source(X.table(spark, sf, "documents"), "main", "corpus", "documents", "doc_id", ["text"], ["lang", "n_chars"])
    done = run_sync(spark, source, run_folder(spark, "shards"), "documents", "initial", "r1", AT)
    name = lambda c: F.regexp_extract(c, "[^/]+$", 0).alias("name")
    listed = spark.read.parquet(f"{done.folder}/manifest").select(F.explode("uris").alias("uri")).select(name("uri"))
    shards = read_manifest(spark, f"{done.folder}/shards")
    read = spark.read.text(f"{done.folder}/shards/files").select("value", name("_metadata.file_path")).join(listed, "name")
    line = F.from_json("value", IMPORT_SCHEMA)
    read = read.select(line["id"].alias("id"), F.md5(F.unbase64(line["content"]["rawBytes"])).alias("body_md5"), (F.octet_length("value") + 1).cast("bigint").alias("line_bytes"))
    read = read.groupBy("id", "body_md5", "line_bytes").agg(F.count("*").alias("times_listed"))
    total = lambda c: shards.agg(F.sum(c)).scalar()
    return read.withColumns({"listed_docs": total("docs"), "listed_bytes": total("bytes")})
