"""Sources and scans over the given tables."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from tidemark.operators.documents import file_to_document
from tidemark.plans import inputs as X
from tidemark.plans.documents import CUSTOMER_DOCUMENTS, FILE_DOCUMENTS, customer_documents, flat
from tidemark.plans.registry import query
from tidemark.session import cut_lineage, run_folder
from tidemark.sources import feeds, files, tables

SINCE = dt.datetime(2000, 1, 1)


def _land(spark, sf, folder: str, parity: int) -> None:
    """Benchmark items with even or odd ids as one text file each."""
    items = X.table(spark, sf, "benchmark").where(f"item_id % 2 = {parity}").withColumn("item", F.concat("item_id", F.lit(".txt")))
    items.select("item", "text").write.mode("append").partitionBy("item").option("lineSep", "\x00").text(folder)


def _listed(found):
    """What does not depend on where and when the files were landed."""
    item = F.regexp_extract("path", "/item=(\\d+)", 1).cast("bigint")
    return found.select(item.alias("item_id"), "length", "mime_type")


_LANDED = "SELECT item_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length, 'text/plain' AS mime_type FROM benchmark"


@query("file_inventory", _LANDED)
def file_inventory(spark, sf):
    """Files landed in two goes, listed without opening any."""
    folder = run_folder(spark, "inventory")
    for parity in (0, 1):
        _land(spark, sf, folder, parity)
    return _listed(files.read_files(spark, folder))


@query("files_modified_since", f"{_LANDED} WHERE item_id % 2 = 1")
def files_modified_since(spark, sf):
    """Items with even ids are landed first; the newest of their times is the mark, and only what was landed after it is listed."""
    folder = run_folder(spark, "modified")
    _land(spark, sf, folder, 0)
    mark = files.read_files(spark, folder).select(F.date_format(F.max("updated_at"), "yyyy-MM-dd'T'HH:mm:ss.SSS")).first()[0]
    time.sleep(1.1)  # file systems that keep whole seconds
    _land(spark, sf, folder, 1)
    return _listed(files.read_files(spark, folder, since=mark))


@query(
    "mime_by_extension",
    X.sql_with(
        "files",
        """SELECT doc_id, name, CASE WHEN n LIKE '%.pdf' THEN 'application/pdf' WHEN n LIKE '%.txt' THEN 'text/plain'
WHEN n LIKE '%.md' THEN 'text/markdown' WHEN n LIKE '%.html' OR n LIKE '%.htm' THEN 'text/html'
WHEN n LIKE '%.docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
WHEN n LIKE '%.pptx' THEN 'application/vnd.openxmlformats-officedocument.presentationml.presentation'
WHEN n LIKE '%.xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
WHEN n LIKE '%.json' THEN 'application/json' WHEN n LIKE '%.csv' THEN 'text/csv'
ELSE 'application/octet-stream' END AS mime_type
FROM (SELECT *, lower(name) AS n FROM files)""",
    ),
)
def mime_by_extension(spark, sf):
    return X.files(spark, sf).select("doc_id", "name", files.mime_by_extension(F.col("name")).alias("mime_type"))


@query(
    "table_projected_scan",
    "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer",
)
def table_projected_scan(spark, sf):
    return tables.projected_scan(
        X.table(spark, sf, "customer"), "c_custkey", ["c_name", "c_mktsegment"], ["c_acctbal", "c_nationkey", "c_name"]
    )


@query(
    "table_incremental_scan",
    "SELECT o_orderdate, o_orderkey, o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'",
)
def table_incremental_scan(spark, sf):
    scan = tables.projected_scan(X.table(spark, sf, "orders"), "o_orderkey", ["o_orderpriority"], [], "o_orderdate")
    return tables.incremental_scan(scan, "o_orderdate", SINCE)


@query(
    "json_feed_explode",
    X.sql_with(
        "articles",
        """SELECT id, title, body_html, url, author, CASE WHEN id % 50 = 7 THEN NULL ELSE coalesce(status, 'none') END AS status,
array_to_string(tags, ',') AS tags, array_to_string(reader_users, ',') AS reader_users, array_to_string(reader_groups, ',') AS reader_groups,
strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, is_public, CASE WHEN id % 50 = 7 THEN 'status:BIGINT' ELSE '' END AS mistyped,
CASE WHEN id % 3 = 0 THEN '{"review":{"stars":' || id % 5 || '}}' ELSE '{}' END AS rest FROM articles""",
    ),
)
def json_feed_explode(spark, sf):
    """Pages of twenty articles are landed in both shapes, then read back whole as one feed; some hold a field nobody told of, some a number for a status."""
    articles = X.articles(spark, sf).withColumn("page", F.floor(F.col("id") / 20))
    fields = F.struct(
        "id", "title", "body_html", "url", "author", "tags", "reader_users", "reader_groups", "is_public",
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.when(F.col("id") % 3 == 0, F.struct((F.col("id") % 5).alias("stars"))).alias("review"),
    )
    status = F.when(F.col("id") % 50 == 7, F.col("id").cast("string")).otherwise(F.coalesce(F.concat(F.lit('"'), "status", F.lit('"')), F.lit("null")))
    text = F.concat(F.regexp_replace(F.to_json(fields), r"\}$", ""), F.lit(',"status":'), status, F.lit("}"))
    pages = articles.groupBy("page").agg(F.array_join(F.collect_list(text), ",").alias("rows"), F.count("*").alias("n"))
    first, second = (F.concat(F.lit(f'{{"{name}":['), "rows", F.lit('],"next":'), "page", F.lit(',"total":'), "n", F.lit("}")) for name in ("articles", "items"))
    folder = run_folder(spark, "feed")
    pages.select(F.when(F.col("page") % 2 == 0, first).otherwise(second).alias("value")).write.text(folder)
    feed = feeds.read_records(spark, folder, feeds.ARTICLE_FIELDS)
    lists = {c: F.array_join(c, ",") for c in ("tags", "reader_users", "reader_groups")}
    absent = F.col("status").isNull() & (F.col("mistyped") == "")
    return feed.withColumns({**lists, "status": F.when(absent, "none").otherwise(F.col("status"))})


@query(
    "active_category_filter",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O', 'P') AND o_orderdate > TIMESTAMP '2000-01-01'""",
)
def active_category_filter(spark, sf):
    orders = X.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    return tables.active_in_categories(
        orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_orderstatus", ["O", "P"], "o_orderdate", SINCE
    )


@query(
    "multi_source_union",
    X.sql_with("files", f"""SELECT *, NULL AS primary_key FROM ({FILE_DOCUMENTS}) UNION ALL SELECT *, split_part(id, ':', 3) FROM ({CUSTOMER_DOCUMENTS})"""),
)
def multi_source_union(spark, sf):
    """Whole documents of files and of table rows."""
    found = file_to_document(X.files(spark, sf, with_body=True), ["docs_readers"]).withColumn("body", F.decode("body", "UTF-8"))
    return flat(tables.union_sources(found, customer_documents(spark, sf)), "id", "title", "body", "mime_type", "metadata", "updated_at", "primary_key")


@query(
    "object_delta",
    X.sql_with(
        "files mir",
        """SELECT path AS uri, updated_at AS updated, octet_length(encode(text)) AS size
FROM files JOIN documents USING (doc_id)
WHERE updated_at > (SELECT coalesce(max(ts), TIMESTAMP '1970-01-01') FROM mir) """,
    ),
)
def object_delta(spark, sf):
    """Object rows newer than the newest sync in the mirror."""
    sizes = X.table(spark, sf, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("size"))
    objects = X.files(spark, sf).join(sizes, "doc_id").select(
        F.col("path").alias("uri"), F.col("updated_at").alias("updated"), "size"
    )
    mirror = X.mir(spark, sf).select(F.col("ts").alias("last_synced"))
    return files.changed_objects(objects, mirror)


@query("object_bodies", "SELECT item_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS size, md5(text || chr(0)) AS body_md5 FROM benchmark WHERE item_id % 2 = 1")
def object_bodies(spark, sf):
    """A table names all landed objects; only the bodies of those changed since the newest sync are opened."""
    folder = run_folder(spark, "objects")
    for parity in (0, 1):
        _land(spark, sf, folder, parity)
    item = F.regexp_extract("path", "/item=(\\d+)", 1).cast("bigint")
    changed = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(days=(F.col("item_id") % 2).cast("int"))
    objects = cut_lineage(files.read_files(spark, folder).select(F.col("path").alias("uri"), item.alias("item_id"), F.col("length").alias("size")).withColumn("updated", changed))
    mirror = spark.range(1).select(F.to_timestamp_ntz(F.lit("2024-01-01 12:00:00")).alias("last_synced"))
    found = files.changed_objects(objects, mirror)
    bodies = files.read_objects(found, 8).select("uri", F.octet_length("body").cast("bigint").alias("size"), F.md5("body").alias("body_md5"))
    return found.select("uri", "item_id").join(bodies, "uri").select("item_id", "size", "body_md5")


@query(
    "attachment_join",
    """SELECT d.doc_id AS attachment_id, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def attachment_join(spark, sf):
    rows = X.table(spark, sf, "documents").select(F.col("doc_id").alias("attachment_id"), "source", "n_chars")
    return tables.attach(rows, X.table(spark, sf, "labels").withColumnRenamed("doc_id", "attachment_id"), "attachment_id")
