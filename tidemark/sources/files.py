"""File sources: metadata first, bodies only for what a run will send."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import MIME_BY_EXTENSION, MIME_DEFAULT
from tidemark.sinks.storage import storage

#: Bytes of bodies that a task holds before it hands them on.
BODIES_AT_ONCE = 32_000_000


def mime_by_extension(name: Column) -> Column:
    """MIME type from the case-insensitive suffix."""
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    extension = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1)))
    return F.coalesce(F.try_element_at(table, extension), F.lit(MIME_DEFAULT))


def read_files(
    spark: SparkSession, root: str, since: str | None = None, with_body: bool = False
) -> DataFrame:
    """Every file below ``root``, or only those changed strictly after ``since``.

    Without bodies nothing is opened: path, length and time come from the listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if since is not None:
        reader = reader.option("modifiedAfter", since).option("timeZone", "UTC")
    files = reader.load(root)
    name = F.element_at(F.split("path", "/"), -1)
    columns = [
        F.col("path"),
        name.alias("name"),
        F.col("length"),
        F.col("modificationTime").alias("updated_at"),
        mime_by_extension(name).alias("mime_type"),
    ]
    if with_body:
        columns.append(F.col("content").alias("body"))
    return files.select(*columns)


def changed_objects(objects: DataFrame, mirror: DataFrame) -> DataFrame:
    """Object rows updated after the newest sync; an empty mirror makes all of them new.

    The mark is a scalar subquery: one value, known before the object scan starts.
    """
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    mark = mirror.select(F.coalesce(F.max("last_synced"), start)).scalar()
    return objects.where(F.col("updated") > mark)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open each named object in the task. One that is not there has no body and an error."""
    names = ["uri", "body", "error"]
    for batch in batches:
        rows, held = [], 0
        for uri in batch.column(0).to_pylist():
            body, error = None, None
            try:
                fs, path = storage(uri)
                with fs.open_input_stream(path) as stream:
                    body = stream.read()
            except (OSError, pa.ArrowException) as problem:
                error = str(problem)[:300]
            rows.append((uri, body, error))
            held += len(body or b"")
            if held >= BODIES_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.string()))], names=names)
                rows, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.string()))], names=names)


def read_objects(objects: DataFrame, partitions: int | None = None) -> DataFrame:
    """(uri, body, error) of the objects that a table names in ``uri``, opened in tasks; nothing is listed and the driver sees no name.

    With ``partitions`` the names, not the bodies, are dealt out evenly first. NULL names are left out; an object that cannot be read has an ``error``.
    """
    named = objects.where("uri is not null").select("uri")
    return (named.repartition(partitions) if partitions else named).mapInArrow(_bodies, "uri string, body binary, error string")
