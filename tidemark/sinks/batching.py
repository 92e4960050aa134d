"""Dense numbering and request batches without a global window.

A row's place is (first four hex digits of md5(id), id). The hash cuts the ids
into 65,536 buckets of even size whatever the ids look like, each bucket is
numbered by its own window, and the bucket totals (at most 65,536 short rows,
so their broadcast and their running sum have a fixed bound) turn the local
numbers into global ones. Batches are therefore all full except the last.

Pass narrow rows (a key and what must travel with it): then numbering and totals
need the same columns and Spark runs one shuffle, and the input, for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.constants import BYTES_PER_FILE, DOCS_PER_SHARD, IDS_PER_PURGE

BUCKET_DIGITS = 4


def _bucket(key: str) -> Column:
    # Never NULL: Spark then adds no NULL filter to one side of the join below, and
    # both sides share a single shuffle of the numbered rows.
    return F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, BUCKET_DIGITS), F.lit(""))


def dense_index(rows: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """Adds ``idx`` (0, 1, 2 ...) and, with a weight, ``start``: the weight of all rows before."""
    local = W.partitionBy("bucket").orderBy(key)
    numbered = rows.withColumn("bucket", _bucket(key)).withColumn("rn", F.row_number().over(local))
    totals = [F.max("rn").cast("bigint").alias("rows_in")]
    if weight is not None:
        numbered = numbered.withColumn("w", weight.cast("bigint")).withColumn(
            "upto", F.sum("w").over(local.rowsBetween(W.unboundedPreceding, W.currentRow))
        )
        totals.append(F.sum("w").alias("weight_in"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = numbered.groupBy("bucket").agg(*totals)
    shift = [F.coalesce(F.sum("rows_in").over(before), F.lit(0)).alias("rows_before")]
    if weight is not None:
        shift.append(F.coalesce(F.sum("weight_in").over(before), F.lit(0)).alias("weight_before"))
    offsets = offsets.select("bucket", *shift)
    out = numbered.join(F.broadcast(offsets), "bucket")
    out = out.withColumn("idx", (F.col("rows_before") + F.col("rn") - 1).cast("bigint"))
    dropped = ["bucket", "rn", "rows_before"]
    if weight is not None:
        out = out.withColumn("start", (F.col("weight_before") + F.col("upto") - F.col("w")).cast("bigint"))
        dropped += ["w", "upto", "weight_before"]
    return out.drop(*dropped)


def numbered_batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Adds ``batch``: consecutive groups of ``size`` rows."""
    return dense_index(rows, key).withColumn("batch", F.expr(f"idx div {size}")).drop("idx")


def size_bounded_batches(
    rows: DataFrame, key: str, size: Column, max_rows: int = DOCS_PER_SHARD, max_bytes: int = BYTES_PER_FILE
) -> DataFrame:
    """Adds ``batch`` such that no batch passes ``max_rows`` rows or ``max_bytes`` bytes.

    A row over half the byte limit gets a batch of its own (``solo``); ``oversize`` marks a row that is over the limit by itself. The others
    are cut where the running start crosses a multiple of half the limit: what
    starts in one slot plus the last row's length stays within the limit. Row and
    byte slots both only grow, so their sum names each pair once.
    """
    half = max_bytes // 2
    sized = rows.withColumn("bytes", size.cast("bigint")).withColumn("solo", F.col("bytes") > half)
    sized = sized.withColumn("oversize", F.col("bytes") > max_bytes)
    small = F.when(F.col("solo"), 0).otherwise(F.col("bytes"))
    placed = dense_index(sized, key, small)
    slot = F.expr(f"start div {half} + idx div {max_rows}")
    return placed.withColumn("batch", F.when(~F.col("solo"), slot)).drop("start", "idx")


def any_filter(ids: Column) -> Column:
    """``id: ANY("a","b")`` over the ids of one purge request."""
    quoted = F.transform(F.sort_array(F.collect_list(ids.cast("string"))), lambda i: F.concat(F.lit('"'), i, F.lit('"')))
    return F.concat(F.lit("id: ANY("), F.concat_ws(",", quoted), F.lit(")"))


def purge_requests(ids: DataFrame, key: str, size: int = IDS_PER_PURGE) -> DataFrame:
    """One filter string per request; a request holds at most ``size`` ids."""
    batches = numbered_batches(ids.select(key), key, size)
    return batches.groupBy("batch").agg(F.count("*").alias("ids"), any_filter(F.col(key)).alias("filter"))


def purge_lines(ids: DataFrame, key: str, size: int = IDS_PER_PURGE) -> DataFrame:
    """(id, request): one line per id with the number of its request, for deletes that are handed over as files."""
    return numbered_batches(ids.select(F.col(key).cast("string").alias("id")), "id", size).withColumnRenamed("batch", "request")
