"""Rows, files, articles and policies to documents.

All pure projections: no shuffle, one pass, pruned to the columns used.
A document is id, title, body, mime_type, metadata (JSON text), updated_at and
principals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.functions import access as A
from tidemark.functions import text as X
from tidemark.sources.files import mime_by_extension

_SCALARS = (T.BooleanType, T.NumericType, T.StringType)


def json_safe(column: str, dtype: T.DataType) -> Column:
    """Booleans, integers, floats and strings keep their type; all else becomes text."""
    if isinstance(dtype, _SCALARS) and not isinstance(dtype, T.DecimalType):
        return F.col(column)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return X.as_text(column, dtype)


def _metadata(fields: Column) -> Column:
    """Metadata as a JSON object; an entry without a value is kept as null."""
    return F.to_json(fields, {"ignoreNullFields": "false"}).alias("metadata")


def row_to_document(
    rows: DataFrame,
    catalog: str,
    schema: str,
    table: str,
    key: str,
    text_columns: list[str],
    metadata_columns: list[str] = (),
    watermark_column: str | None = None,
    reader_groups: list[str] = (),
    scheme: str = K.ROW_ID_SCHEME,
) -> DataFrame:
    """Table rows as plain-text documents. A metadata column named like a built-in
    entry replaces it. Without a time in the watermark column ``updated_at`` is NULL, in the metadata too: a document never depends on when it is built."""
    pk = F.col(key).cast("string")
    if watermark_column and isinstance(rows.schema[watermark_column].dataType, (T.TimestampType, T.TimestampNTZType)):
        updated = F.col(watermark_column).cast("timestamp_ntz")
    else:
        updated = F.lit(None).cast("timestamp_ntz")
    entries = {
        "title": F.concat(F.lit(f"{table} row "), pk),
        "source": F.lit(K.ROW_SOURCE_TAG),
        "catalog": F.lit(catalog),
        "schema": F.lit(schema),
        "table": F.lit(table),
        "primary_key": pk,
        "updated_at": X.iso_utc(updated),
    }
    entries |= {c: json_safe(c, rows.schema[c].dataType) for c in metadata_columns}
    groups = F.array(*[F.lit(g) for g in reader_groups]).cast("array<string>")
    return rows.select(
        F.concat(F.lit(f"{scheme}:{catalog}.{schema}.{table}:"), pk).alias("id"),
        pk.alias("primary_key"),
        entries["title"].cast("string").alias("title"),
        X.render_row_text(list(text_columns), rows.schema).alias("body"),
        F.lit("text/plain").alias("mime_type"),
        _metadata(F.struct(*[v.alias(k) for k, v in entries.items()])),
        updated.alias("updated_at"),
        A.reader_principals(F.array().cast("array<string>"), groups, F.lit(False)).alias("principals"),
    )


def file_to_document(files: DataFrame, reader_groups: list[str] = (), scheme: str = K.FILE_ID_SCHEME) -> DataFrame:
    """Files (path, name, updated_at and optionally body) as documents."""
    groups = F.array(*[F.lit(g) for g in reader_groups]).cast("array<string>")
    metadata = F.struct(
        F.col("name").alias("title"),
        F.lit(K.FILE_SOURCE_TAG).alias("source"),
        F.col("path").alias("volume_path"),
        X.iso_utc(F.col("updated_at")).alias("updated_at"),
    )
    columns = [
        X.file_document_id(scheme, F.col("path")).alias("id"),
        F.col("name").alias("title"),
        mime_by_extension(F.col("name")).alias("mime_type"),
        _metadata(metadata),
        F.col("updated_at"),
        A.reader_principals(F.array().cast("array<string>"), groups, F.lit(False)).alias("principals"),
    ]
    if "body" in files.columns:
        columns.append(F.col("body"))
    return files.select(*columns)


def article_to_document(articles: DataFrame, scheme: str = K.ARTICLE_ID_SCHEME) -> DataFrame:
    """CMS articles with cleaned text and per-article readers."""
    blank = F.lit("")
    metadata = F.struct(
        F.coalesce("title", blank).alias("title"),
        F.coalesce("url", blank).alias("source_url"),
        F.coalesce("author", blank).alias("author"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        X.iso_utc(F.col("updated_at")).alias("updated_at"),
    )
    return X.with_html_text(articles, "body_html", "body").select(
        F.concat(F.lit(scheme + ":"), F.col("id").cast("string")).alias("id"),
        F.coalesce("title", blank).alias("title"),
        "body",
        F.lit("text/plain").alias("mime_type"),
        _metadata(metadata),
        F.col("updated_at"),
        A.external_principals(F.col("reader_users"), F.col("reader_groups"), F.col("is_public")).alias("principals"),
    )


def route_by_status(articles: DataFrame) -> DataFrame:
    """Adds ``action``: delete, skip or upsert. No status means published; a body
    that is blank after cleaning is skipped."""
    status = F.coalesce("status", F.lit("published"))
    cleaned = X.with_html_text(articles, "body_html", "cleaned", space="keep")
    skip = (status != "published") | ~F.col("cleaned").rlike(X.NOT_SPACE)
    action = F.when(status == "deleted", "delete").when(skip, "skip").otherwise("upsert")
    return cleaned.withColumn("action", action).drop("cleaned")


def published_html_document(articles: DataFrame) -> DataFrame:
    """The variant that ships the HTML itself as base64 under the bare key."""
    blank = F.lit("")
    metadata = F.struct(
        F.coalesce("title", blank).alias("title"),
        F.coalesce("author", blank).alias("author"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("url", blank).alias("url"),
        X.iso_utc(F.col("updated_at")).alias("updated_at"),
    )
    return route_by_status(articles).where("action = 'upsert'").select(
        F.col("id").cast("string").alias("id"),
        F.lit("text/html").alias("mime_type"),
        F.replace(F.base64(F.encode("body_html", "UTF-8")), F.lit("\r\n"), F.lit("")).alias("raw_bytes"),
        _metadata(metadata),
    )


def kb_to_document(
    articles: DataFrame, instance: str, empty_policy: str = "deny", scheme: str = K.KB_ID_SCHEME
) -> DataFrame:
    """Knowledge articles: tags stripped, entities left, view count 0 when missing or bad."""
    blank = F.lit("")
    link = F.concat(F.lit(instance + "/kb_view.do?sysparm_article="), F.coalesce("number", blank))
    views = F.coalesce(F.col("view_count").try_cast("bigint"), F.lit(0).cast("bigint"))
    metadata = F.struct(
        F.coalesce("short_description", blank).alias("title"),
        F.coalesce("number", blank).alias("kb_number"),
        F.coalesce("kb_category", blank).alias("category"),
        F.coalesce("workflow_state", blank).alias("workflow_state"),
        views.alias("view_count"),
        F.coalesce("sys_updated_on", blank).alias("updated_at"),
        link.alias("source_url"),
    )
    cleaned = X.with_html_text(articles, "text", "body", unescape=False, space="strip")
    return cleaned.select(
        F.concat(F.lit(scheme + ":"), F.col("sys_id").cast("string")).alias("id"),
        "body",
        views.alias("view_count"),
        link.alias("source_url"),
        _metadata(metadata),
        A.csv_principals(F.col("can_read_user_criteria"), empty_policy).alias("principals"),
    )


def kb_html_to_document(articles: DataFrame, instance: str, empty_policy: str = "deny") -> DataFrame:
    """The knowledge variant that ships HTML under ``kb_<id>`` and reads a comma list of roles."""
    blank = F.lit("")
    title = X.first_filled(F.col("short_description"), F.col("title"), F.lit("Untitled"))
    link = F.concat(F.lit(instance + "/kb_view.do?sys_kb_id="), F.col("sys_id").cast("string"))
    metadata = F.struct(
        title.alias("title"),
        F.coalesce("number", blank).alias("kb_number"),
        F.coalesce("kb_category", blank).alias("category"),
        F.coalesce("kb_knowledge_base", blank).alias("knowledge_base"),
        F.coalesce("sys_updated_on", blank).alias("updated_at"),
        link.alias("url"),
    )
    return articles.select(
        F.concat(F.lit(K.KB_ID_SCHEME_PLAIN), F.col("sys_id").cast("string")).alias("id"),
        title.alias("title"),
        F.coalesce("text", blank).alias("body"),
        F.lit("text/html").alias("mime_type"),
        _metadata(metadata),
        A.csv_principals(F.col("roles"), empty_policy).alias("principals"),
    )


def policy_file_document(policies: DataFrame, files_at: str, portal: str) -> DataFrame:
    """The policy variant whose body is a staged file. Input is policies already joined
    to their attachment; the document names the file instead of carrying it."""
    identity = F.col("document_id")
    title = X.first_filled(F.col("title"), F.col("file_name"))
    metadata = F.struct(
        title.alias("title"),
        F.col("description").alias("summary"),
        F.date_format("effective_date", "yyyy-MM-dd'T'HH:mm:ss").alias("effective_date"),
        F.col("language").alias("locale"),
        F.col("owner").alias("owner_sap_user_id"),
        F.lit(K.POLICY_SOURCE_TAG).alias("source_system"),
        F.concat(F.lit(portal), identity).alias("source_url"),
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("last_modified"),
    )
    return policies.select(
        identity.alias("id"),
        F.concat(F.lit(files_at + "/"), identity, F.lit(".pdf")).alias("uri"),
        F.lit("application/pdf").alias("mime_type"),
        _metadata(metadata),
        A.csv_principals(F.col("visible_to"), kind="entity").alias("principals"),
    )


def policy_to_document(policies: DataFrame, host: str) -> DataFrame:
    """HR policies; missing text facets and dates become empty strings."""

    def day(c: str) -> Column:
        return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))

    link = F.concat(F.lit(f"https://{host}/sf/dms/document/"), F.col("document_id"))
    title = X.first_filled(F.col("title"), F.col("name"), F.col("document_id"))
    metadata = F.struct(
        title.alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.lit(K.POLICY_SOURCE_TAG).alias("source_system"),
        F.lit(K.POLICY_DOC_TYPE).alias("doc_type"),
        link.alias("source_url"),
        F.coalesce("business_unit", F.lit("")).alias("business_unit"),
        F.coalesce("language", F.lit("")).alias("language"),
        day("effective_date").alias("effective_date"),
        day("expiration_date").alias("expiration_date"),
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
    )
    public = F.coalesce("is_public", F.lit(False)) | F.array_contains(F.coalesce("groups", F.array().cast("array<string>")), K.ALL_EMPLOYEES)
    named = A.external_principals(F.lit(None).cast("array<string>"), F.col("groups"), F.lit(False), "deny")
    return policies.select(
        F.concat(F.lit(K.POLICY_ID_SCHEME + ":"), F.col("document_id")).alias("id"),
        title.alias("title"),
        F.coalesce("mime_type", F.lit("application/pdf")).alias("mime_type"),
        _metadata(metadata),
        F.when(public, A.everyone()).otherwise(named).alias("principals"),
        F.col("body"),
    )


def policy_facets(policies: DataFrame, as_of: Column) -> DataFrame:
    """Filterable columns of a policy corpus and whether the policy is in force."""
    return policies.select(
        "document_id",
        F.lit(K.POLICY_DOC_TYPE).alias("doc_type"),
        F.coalesce("business_unit", F.lit("")).alias("business_unit"),
        F.coalesce("language", F.lit("")).alias("language"),
        "effective_date",
        "expiration_date",
        (F.col("expiration_date").isNull() | (F.col("expiration_date") >= as_of)).alias("active"),
    )


def duplicate_ids(documents: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids produced more than once. Counts are combined before the shuffle, so an
    id on a third of all rows is one row per task."""
    return documents.groupBy(id_column).agg(F.count("*").alias("times")).where("times > 1")
