"""Table sources."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def projected_scan(
    table: DataFrame,
    key: str,
    text_columns: list[str],
    metadata_columns: list[str] = (),
    watermark_column: str | None = None,
) -> DataFrame:
    """Only the columns a document needs, sorted and without repeats."""
    wanted = {key, *text_columns, *metadata_columns}
    if watermark_column:
        wanted.add(watermark_column)
    return table.select(*sorted(wanted))


def incremental_scan(
    table: DataFrame,
    watermark_column: str | None,
    since: dt.datetime | None,
    inclusive: bool = False,
    overlap_seconds: int = 0,
) -> DataFrame:
    """Rows changed after ``since``; both arguments are needed for a filter, and a
    NULL watermark is only seen by a full read. The literal reaches the Parquet scan."""
    if watermark_column is None or since is None:
        return table
    mark = F.lit(since - dt.timedelta(seconds=overlap_seconds)).cast(table.schema[watermark_column].dataType)
    column = F.col(watermark_column)
    return table.where(column >= mark if inclusive else column > mark)


def active_in_categories(
    table: DataFrame,
    category: str,
    categories: list[str],
    active: str,
    active_values: list,
    watermark_column: str,
    since: dt.datetime | None,
) -> DataFrame:
    kept = table.where(F.col(category).isin(categories) & F.col(active).isin(active_values))
    return incremental_scan(kept, watermark_column, since)


def union_sources(*documents: DataFrame) -> DataFrame:
    """One stream of documents from several sources; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), documents)


def attach(rows: DataFrame, attachments: DataFrame, key: str) -> DataFrame:
    """Rows with their attachment; a row without one is left out.

    Only the key and the attachment's own columns are shuffled, and a key
    repeated on one side alone is handled by adaptive skew splitting.
    """
    return rows.where(F.col(key).isNotNull()).join(attachments, key, "inner")
