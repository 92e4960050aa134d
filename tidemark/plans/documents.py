"""Document building over the given tables."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark import constants as K
from tidemark.functions import access as A
from tidemark.functions import text as T
from tidemark.functions.payload import decode_attachment
from tidemark.operators import documents as D
from tidemark.plans import inputs as X
from tidemark.plans.registry import query
from tidemark.sources.tables import attach

INSTANCE = "https://kb.example.com"
HOST = "hr.example.com"


def flat(documents, *columns):
    """Principals as one readable string, so results compare across engines."""
    readers = F.array_join(A.principal_text(F.col("principals")), ",").alias("readers")
    return documents.select(*columns, readers)


def customer_documents(spark, sf):
    rows = X.table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    rows = rows.withColumn("changed", X._hours_after("2024-01-01", "c_custkey"))
    return D.row_to_document(
        rows,
        "main",
        "sales",
        "customer",
        "c_custkey",
        ["c_name", "c_mktsegment", "c_acctbal"],
        ["c_acctbal", "c_nationkey"],
        "changed",
        ["sales_readers", "team@example.com"],
    )


CUSTOMER_DOCUMENTS = """SELECT 'databricks_row:main.sales.customer:' || c_custkey AS id, 'customer row ' || c_custkey AS title,
'c_name: ' || c_name || '. c_mktsegment: ' || c_mktsegment || '. c_acctbal: ' || CAST(c_acctbal AS DECIMAL(18,2)) || '.' AS body,
'text/plain' AS mime_type,
CAST(json_object('title', 'customer row ' || c_custkey, 'source', 'databricks_uc_table', 'catalog', 'main', 'schema', 'sales',
  'table', 'customer', 'primary_key', CAST(c_custkey AS VARCHAR),
  'updated_at', strftime(TIMESTAMP '2024-01-01' + to_hours(c_custkey % 8760), '%Y-%m-%dT%H:%M:%S+00:00'),
  'c_acctbal', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 'c_nationkey', c_nationkey) AS VARCHAR) AS metadata,
TIMESTAMP '2024-01-01' + to_hours(c_custkey % 8760) AS updated_at,
'group:external_group:sales_readers,group:team@example.com' AS readers FROM customer"""


@query("row_to_document", CUSTOMER_DOCUMENTS)
def row_to_document(spark, sf):
    return flat(customer_documents(spark, sf), "id", "title", "body", "mime_type", "metadata", "updated_at")


FILE_MIME = """CASE WHEN lower(name) LIKE '%.pdf' THEN 'application/pdf' WHEN lower(name) LIKE '%.txt' THEN 'text/plain'
WHEN lower(name) LIKE '%.md' THEN 'text/markdown' WHEN lower(name) LIKE '%.html' OR lower(name) LIKE '%.htm' THEN 'text/html'
WHEN lower(name) LIKE '%.docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
WHEN lower(name) LIKE '%.pptx' THEN 'application/vnd.openxmlformats-officedocument.presentationml.presentation'
WHEN lower(name) LIKE '%.xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
WHEN lower(name) LIKE '%.json' THEN 'application/json' WHEN lower(name) LIKE '%.csv' THEN 'text/csv' ELSE 'application/octet-stream' END"""

FILE_DOCUMENTS = f"""SELECT CASE WHEN length('databricks_volume:' || path) > 1024 OR contains(path, '_') THEN left(replace('databricks_volume:' || path, '/', '_'), 991) || '_' || md5(path)
ELSE replace('databricks_volume:' || path, '/', '_') END AS id, name AS title, text AS body, {FILE_MIME} AS mime_type,
CAST(json_object('title', name, 'source', 'databricks_uc_volume', 'volume_path', path,
  'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS VARCHAR) AS metadata, updated_at,
'group:external_group:docs_readers' AS readers FROM files JOIN documents USING (doc_id)"""


@query("file_to_document", X.sql_with("files", FILE_DOCUMENTS))
def file_to_document(spark, sf):
    documents = D.file_to_document(X.files(spark, sf, with_body=True), ["docs_readers"])
    return flat(documents.withColumn("body", F.decode("body", "UTF-8")), "id", "title", "body", "mime_type", "metadata", "updated_at")


def _decoded(text: str) -> str:
    """The entities of the given pages; a page may cut one off before its semicolon."""
    for entity, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return text


_CLEAN = f"""trim(regexp_replace({_decoded("regexp_replace(body_html, '<[^>]+>', ' ', 'g')")}, '[\\s\\x{{85}}\\x{{a0}}]+', ' ', 'g'))"""


@query(
    "article_to_document",
    X.sql_with(
        "articles",
        f"""SELECT 'cms_article:' || id AS id, title, {_CLEAN} AS body,
CAST(json_object('title', title, 'source_url', url, 'author', author, 'tags', tags,
  'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS VARCHAR) AS metadata,
CASE WHEN is_public THEN 'idp_wide' WHEN len(reader_users) + len(reader_groups) = 0 THEN 'user:external_user:__no_readers_sentinel__'
ELSE array_to_string(list_concat(list_transform(reader_users, lambda u: 'user:external_user:' || u),
  list_transform(reader_groups, lambda g: 'group:external_group:' || g)), ',') END AS readers
FROM articles""",
    ),
)
def article_to_document(spark, sf):
    return flat(D.article_to_document(X.articles(spark, sf)), "id", "title", "body", "metadata")


@query(
    "published_html_document",
    X.sql_with(
        "articles",
        """SELECT CAST(id AS VARCHAR) AS id, 'text/html' AS mime_type, base64(encode(body_html)) AS raw_bytes,
CAST(json_object('title', title, 'author', author, 'tags', tags, 'url', url,
  'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS VARCHAR) AS metadata
FROM articles WHERE coalesce(status, 'published') = 'published'
AND trim(regexp_replace(body_html, '<[^>]+>', ' ', 'g')) <> ''""",
    ),
)
def published_html_document(spark, sf):
    return D.published_html_document(X.articles(spark, sf))


@query(
    "kb_to_document",
    X.sql_with(
        "kb",
        r"""SELECT 'snow_kb:' || sys_id AS id, regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') AS body,
coalesce(TRY_CAST(view_count AS BIGINT), 0) AS view_count,
'https://kb.example.com/kb_view.do?sysparm_article=' || number AS source_url,
CAST(json_object('title', short_description, 'kb_number', number, 'category', kb_category, 'workflow_state', workflow_state,
  'view_count', coalesce(TRY_CAST(view_count AS BIGINT), 0), 'updated_at', sys_updated_on,
  'source_url', 'https://kb.example.com/kb_view.do?sysparm_article=' || number) AS VARCHAR) AS metadata,
CASE WHEN can_read_user_criteria = '' THEN ''
ELSE 'group:external_group:' || split_part(can_read_user_criteria, ', ,', 1) || ',group:external_group:' || split_part(can_read_user_criteria, ', ,', 2) END AS readers
FROM kb""",
    ),
)
def kb_to_document(spark, sf):
    documents = D.kb_to_document(X.kb(spark, sf), INSTANCE)
    return flat(documents, "id", "body", "view_count", "source_url", "metadata")


@query(
    "kb_html_to_document",
    X.sql_with(
        "kb",
        """SELECT 'kb_' || sys_id AS id, short_description AS title, text AS body, 'text/html' AS mime_type,
CAST(json_object('title', short_description, 'kb_number', number, 'category', kb_category, 'knowledge_base', '', 'updated_at', sys_updated_on,
  'url', 'https://kb.example.com/kb_view.do?sys_kb_id=' || sys_id) AS VARCHAR) AS metadata,
CASE WHEN can_read_user_criteria = '' THEN ''
ELSE 'group:external_group:' || split_part(can_read_user_criteria, ', ,', 1) || ',group:external_group:' || split_part(can_read_user_criteria, ', ,', 2) END AS readers
FROM kb""",
    ),
)
def kb_html_to_document(spark, sf):
    missing = F.lit(None).cast("string")
    articles = X.kb(spark, sf).withColumnsRenamed({"can_read_user_criteria": "roles"})
    articles = articles.withColumn("title", missing).withColumn("kb_knowledge_base", missing)
    return flat(D.kb_html_to_document(articles, INSTANCE), "id", "title", "body", "mime_type", "metadata")


@query(
    "policy_file_document",
    X.sql_with(
        "policies",
        """SELECT p.document_id AS id, 'https://files.example.com/pdfs/' || p.document_id || '.pdf' AS uri, 'application/pdf' AS mime_type,
CAST(json_object('title', coalesce(nullif(p.title, ''), 'file-' || p.doc_id), 'summary', p.description, 'effective_date', strftime(p.effective_date, '%Y-%m-%dT%H:%M:%S'),
  'locale', p.language, 'owner_sap_user_id', 'owner-' || l.quality, 'source_system', 'sap_successfactors',
  'source_url', 'https://hr.example.com/policy/' || p.document_id, 'last_modified', strftime(p.updated_at, '%Y-%m-%dT%H:%M:%S')) AS VARCHAR) AS metadata,
array_to_string(list_transform(p.groups, lambda g: 'entity:external_group:' || g), ',') AS readers
FROM policies p JOIN labels l ON l.doc_id = p.doc_id""",
    ),
)
def policy_file_document(spark, sf):
    """Policies joined to their attachment; those without one are left out."""
    attachments = X.table(spark, sf, "labels").select(
        "doc_id",
        F.concat(F.lit("file-"), "doc_id").alias("file_name"),
        F.concat(F.lit("owner-"), "quality").alias("owner"),
    )
    policies = X.policies(spark, sf).drop("body").withColumn("visible_to", F.array_join("groups", ","))
    documents = D.policy_file_document(
        attach(policies, attachments, "doc_id"), "https://files.example.com/pdfs", "https://hr.example.com/policy/"
    )
    return flat(documents, "id", "uri", "mime_type", "metadata")


_POLICY_TITLE = "coalesce(nullif(title, ''), nullif(name, ''), document_id)"


@query(
    "policy_to_document",
    X.sql_with(
        "policies",
        f"""SELECT 'sf:dms:' || document_id AS id, {_POLICY_TITLE} AS title, coalesce(mime_type, 'application/pdf') AS mime_type,
CAST(json_object('title', {_POLICY_TITLE}, 'description', coalesce(description, ''), 'source_system', 'sap_successfactors',
  'doc_type', 'hr_policy', 'source_url', 'https://hr.example.com/sf/dms/document/' || document_id,
  'business_unit', coalesce(business_unit, ''), 'language', coalesce(language, ''),
  'effective_date', coalesce(strftime(effective_date, '%Y-%m-%dT%H:%M:%S'), ''),
  'expiration_date', coalesce(strftime(expiration_date, '%Y-%m-%dT%H:%M:%S'), ''),
  'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S')) AS VARCHAR) AS metadata, body,
CASE WHEN coalesce(is_public, false) OR list_contains(groups, 'ALL_EMPLOYEES') THEN 'idp_wide'
ELSE array_to_string(list_transform(groups, lambda g: 'group:external_group:' || g), ',') END AS readers
FROM policies""",
    ),
)
def policy_to_document(spark, sf):
    return flat(D.policy_to_document(X.policies(spark, sf), HOST), "id", "title", "mime_type", "metadata", "body")


@query(
    "render_row_text",
    """SELECT o_orderkey, 'o_orderkey: ' || o_orderkey || CASE WHEN o_orderstatus <> 'P' THEN '. o_orderstatus: ' || o_orderstatus ELSE '' END
|| '. o_orderdate: ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.' AS rendered_text FROM orders""",
)
def render_row_text(spark, sf):
    orders = X.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderdate"
    )
    rendered = T.render_row_text(["o_orderkey", "o_orderstatus", "o_orderdate"], orders.schema)
    return orders.select("o_orderkey", rendered.alias("rendered_text"))


@query(
    "stable_id_schemes",
    """SELECT o_orderkey, 'orders:' || o_orderkey AS by_source, 'snowflake:SALES.PUBLIC.ORDERS:' || o_orderkey AS by_table,
'sap_hr:' || o_custkey || ':' || o_orderpriority AS by_kind FROM orders""",
)
def stable_id_schemes(spark, sf):
    key = F.col("o_orderkey").cast("string")
    return X.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat_ws(":", F.lit("orders"), key).alias("by_source"),
        F.concat(F.lit("snowflake:SALES.PUBLIC.ORDERS:"), key).alias("by_table"),
        F.concat_ws(":", F.lit("sap_hr"), F.col("o_custkey").cast("string"), "o_orderpriority").alias("by_kind"),
    )


@query(
    "duplicate_ids",
    "SELECT 'file:' || lang || '_' || source AS id, count(*) AS times FROM documents GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_ids(spark, sf):
    """Ids built from language and source only: unstable, so most repeat."""
    path = F.concat("lang", F.lit("/"), "source")
    return D.duplicate_ids(X.table(spark, sf, "documents").select(T.file_document_id("file", path).alias("id")))


@query("html_to_text", X.sql_with("articles", f"SELECT id, {_CLEAN} AS text FROM articles"))
def html_to_text(spark, sf):
    return T.with_html_text(X.articles(spark, sf), "body_html", "text").select("id", "text")


_ENDS = r"^[\s\x{a0}]+|[\s\x{a0}]+$"


@query(
    "html_to_text_raw",
    X.sql_with(
        "articles",
        rf"""SELECT id, regexp_replace(t, '{_ENDS}', '', 'g') AS no_unescape, regexp_replace({_decoded("t")}, '{_ENDS}', '', 'g') AS no_collapse
FROM (SELECT id, regexp_replace(body_html, '<[^>]+>', ' ', 'g') AS t FROM articles)""",
    ),
)
def html_to_text_raw(spark, sf):
    articles = X.articles(spark, sf).select("id", "body_html")
    escaped = T.with_html_text(articles, "body_html", "no_unescape", unescape=False, space="strip")
    return T.with_html_text(escaped, "body_html", "no_collapse", space="strip").drop("body_html")


ROUTED = """SELECT id, CASE WHEN coalesce(status, 'published') = 'deleted' THEN 'delete'
WHEN coalesce(status, 'published') <> 'published' OR trim(regexp_replace(body_html, '<[^>]+>', ' ', 'g')) = '' THEN 'skip'
ELSE 'upsert' END AS action FROM articles"""


@query("status_route", X.sql_with("articles", ROUTED))
def status_route(spark, sf):
    return D.route_by_status(X.articles(spark, sf)).select("id", "action")


@query(
    "title_fallback",
    X.sql_with("policies", f"SELECT document_id, {_POLICY_TITLE} AS title FROM policies"),
)
def title_fallback(spark, sf):
    title = T.first_filled(F.col("title"), F.col("name"), F.col("document_id"))
    return X.policies(spark, sf).select("document_id", title.alias("title"))


@query(
    "parse_mixed_dates",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN make_timestamp(epoch_us(ts) - epoch_us(ts) % 1000) WHEN 1 THEN ts END AS parsed FROM events""",
)
def parse_mixed_dates(spark, sf):
    kind = F.col("event_id") % 3
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    given = F.when(kind == 0, F.concat(F.lit("/Date("), millis, F.lit(")/"))).when(kind == 1, iso).otherwise("bad")
    return X.table(spark, sf, "events").select("event_id", T.parse_mixed_date(given).alias("parsed"))


@F.pandas_udf(BinaryType())
def _zip(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: gzip.compress(b, mtime=0))


@query("decode_attachment", "SELECT doc_id, text FROM documents")
def decode_attachment_query(spark, sf):
    """Half the bodies arrive gzipped; decoding gives every text back."""
    raw = F.encode("text", "UTF-8")
    sent = F.base64(F.when(F.col("doc_id") % 2 == 0, _zip(raw)).otherwise(raw))
    attachments = X.table(spark, sf, "documents").select("doc_id", sent.alias("content"))
    return attachments.select("doc_id", F.decode(decode_attachment(F.col("content")), "UTF-8").alias("text"))


@query(
    "hr_document_metadata",
    X.sql_with(
        "policies",
        f"""SELECT document_id, '{K.POLICY_DOC_TYPE}' AS doc_type, coalesce(business_unit, '') AS business_unit,
coalesce(language, '') AS language, effective_date, expiration_date,
expiration_date IS NULL OR expiration_date >= TIMESTAMP '2023-07-15' AS active FROM policies""",
    ),
)
def hr_document_metadata(spark, sf):
    return D.policy_facets(X.policies(spark, sf), F.to_timestamp_ntz(F.lit("2023-07-15 00:00:00")))
