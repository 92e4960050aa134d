"""JSON-lines shards and the requests that name them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import DOCS_PER_SHARD, FILES_PER_REQUEST
from tidemark.functions.payload import IMPORT_SCHEMA, import_line, read_principals
from tidemark.sinks.batching import dense_index


def write_jsonl(documents: DataFrame, folder: str, per_file: int = DOCS_PER_SHARD, body: str = "body") -> None:
    """One import document per line, at most ``per_file`` lines in a file (an action).

    Tasks write in parallel; Spark's commit protocol replaces files of failed attempts.
    """
    lines = documents.select(import_line(F.col(body)).alias("value"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", per_file).text(folder)


def read_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """Written shards as documents again."""
    lines = spark.read.schema(IMPORT_SCHEMA).json(folder)
    return lines.select(
        "id",
        F.unbase64("content.rawBytes").alias("body"),
        F.col("content.mimeType").alias("mime_type"),
        F.col("structData").alias("metadata"),
        read_principals(F.col("aclInfo")).alias("principals"),
    )


def import_manifest(shards: DataFrame, run_id: str, mode: str, per_request: int = FILES_PER_REQUEST) -> DataFrame:
    """Shard URIs grouped into requests. No shards, no requests.

    A FULL run is one reconcile over the whole snapshot: ``part`` of ``parts`` tells
    the importer which requests belong together.
    """
    placed = dense_index(shards, "uri").withColumn("part", F.expr(f"idx div {per_request}"))
    requests = placed.groupBy("part").agg(
        F.count("*").alias("files"), F.sum("docs").alias("docs"), F.sort_array(F.collect_list("uri")).alias("uris")
    )
    parts = shards.select(F.ceil(F.count("*") / per_request).cast("bigint")).scalar()
    return requests.select(
        F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), "part", parts.alias("parts"), "files", "docs", "uris"
    )
