"""Continuous forms of the change-capture operators.

Each job runs with ``availableNow``: it takes what has landed since the last run,
commits its checkpoint and stops, so a scheduler or a long-running trigger can
drive the same code. Checkpoints and sinks live in the shared folder, and every
write is keyed by its batch id, so a retried batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import latest


def read_landed(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files in ``folder``, each exactly once per checkpoint, all of them in one batch.

    ``files_per_batch`` splits a backlog into several batches. Not for jobs with a watermark: each batch moves it, and files of the same arrival
    that come in a later batch would count as late.
    """
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


class LateRows(RuntimeError):
    """Rows behind the watermark were dropped."""


def _run(writer) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _refuse_late(query: StreamingQuery) -> None:
    """An error if the run dropped rows that were later than the delay; what it wrote stays, and a longer delay is needed."""
    dropped = sum(op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators)
    if dropped:
        raise LateRows(f"{dropped} rows were later than the delay and were dropped")


def copy_new(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to ``sink``; running again without new files adds nothing."""
    return _run(stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint))


def fold_state(stream: DataFrame, key: str, order: list[str], carry: list[str], sink: str, checkpoint: str) -> None:
    """Fold events into the newest version per key.

    The version is compared inside the state store, so an older event that arrives
    later changes nothing. Each batch writes only the keys it touched.
    """
    newest = F.max_by(F.struct(*order, *carry), F.struct(*order)).alias("newest")
    folded = stream.groupBy(key).agg(newest).select(key, "newest.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    _run(folded.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))


def read_folded(spark: SparkSession, sink: str, key: str, order: list[str], carry: list[str]) -> DataFrame:
    """The current row per key out of the per-batch changes; deletes dropped."""
    return latest(spark.read.parquet(sink), key, order, carry).where("op <> 'delete'")


def drop_redelivered(stream: DataFrame, key: str, when: str, delay: str, sink: str, checkpoint: str) -> None:
    """At-least-once delivery to exactly once: repeats of a key within ``delay`` are dropped. Later rows are an error."""
    once = stream.withWatermark(when, delay).dropDuplicatesWithinWatermark([key])
    _refuse_late(copy_new(once, sink, checkpoint))


def windowed_counts(stream: DataFrame, when: str, by: str, width: str, delay: str, sink: str, checkpoint: str) -> None:
    """Changes per closed window and action; events later than ``delay`` are an error."""
    counts = (
        stream.withWatermark(when, delay)
        .groupBy(F.window(when, width), by)
        .agg(F.count("*").alias("changes"))
        .select(F.col("window.start").alias("window_start"), by, "changes")
    )
    _refuse_late(copy_new(counts, sink, checkpoint))
