"""Ready-made sources for the sync job: a folder of files and a table.

Each source has its own source key and therefore its own watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.documents import file_to_document, row_to_document
from tidemark.sources.files import read_files
from tidemark.sources.tables import incremental_scan, projected_scan

Source = Callable[[dt.datetime | None], DataFrame]


def file_source(spark: SparkSession, root: str, reader_groups: list[str] = ()) -> Source:
    """Files below ``root``; an incremental read opens only files changed after the mark."""

    def read(since: dt.datetime | None) -> DataFrame:
        after = None if since is None else since.strftime("%Y-%m-%dT%H:%M:%S.%f")
        return file_to_document(read_files(spark, root, after, with_body=True), reader_groups)

    return read


def table_source(
    table: DataFrame,
    catalog: str,
    schema: str,
    name: str,
    key: str,
    text_columns: list[str],
    metadata_columns: list[str] = (),
    watermark_column: str | None = None,
    reader_groups: list[str] = (),
    overlap_seconds: int = 0,
) -> Source:
    """Rows of a table; bodies are bytes, as for files, so both can share a target.

    ``overlap_seconds`` reads that much before the mark again, so that rows which were stamped earlier and committed late are not
    missed; what did not change costs no request. With an overlap the mark itself is read too.
    """

    def read(since: dt.datetime | None) -> DataFrame:
        scan = projected_scan(table, key, list(text_columns), list(metadata_columns), watermark_column)
        rows = incremental_scan(scan, watermark_column, since, overlap_seconds > 0, overlap_seconds)
        documents = row_to_document(
            rows, catalog, schema, name, key, list(text_columns), list(metadata_columns), watermark_column, reader_groups
        )
        return documents.drop("primary_key").withColumn("body", F.encode("body", "UTF-8"))

    return read
