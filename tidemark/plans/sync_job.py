"""One sync run: read, diff against the mirror, stage the requests.

The mirror and the watermark are inputs; a run writes the new ones whole below its own run folder and returns them. Which run is
current is the caller's to keep, so a run that dies changes nothing, and the same run can be made again with the same inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.access import access_key, principal_text
from tidemark.functions.payload import import_line
from tidemark.operators import changes as C
from tidemark.operators.documents import duplicate_ids
from tidemark.sinks.batching import purge_lines, purge_requests
from tidemark.sinks.shard_writer import LINE, read_manifest, read_state, write_shards
from tidemark.sinks.shards import import_manifest

HASHES = ["content_hash", "acl_hash"]


@dataclass(frozen=True)
class SyncResult:
    """``watermark`` and ``mirror()`` are what the next run takes."""

    run_id: str
    mode: str
    counts: dict[str, int]
    requests: int
    watermark: dt.datetime | None
    folder: str

    def mirror(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/mirror")


def with_hashes(documents: DataFrame) -> DataFrame:
    """Documents with ``content_hash`` and ``acl_hash``, what the diff compares without any body."""
    body = F.sha2(F.col("body").cast("binary"), 256)
    content = F.sha2(F.to_json(F.struct("title", body.alias("body"), "mime_type", "metadata")), 256)
    return documents.withColumns({"content_hash": content, "acl_hash": access_key(F.col("principals"))})


def run_sync(
    spark: SparkSession,
    read_source: Callable[[dt.datetime | None], DataFrame],
    root: str,
    source_key: str,
    mode: str,
    run_id: str,
    synced_at: dt.datetime,
    mirror: DataFrame | None = None,
    mark: dt.datetime | None = None,
    deleted_ids: DataFrame | None = None,
    allow_empty: bool = False,
    docs_per_shard: int = K.DOCS_PER_SHARD,
    bytes_per_shard: int = K.BYTES_PER_FILE,
) -> SyncResult:
    """Sync one source (an action). ``read_source(since)`` gives documents with id, title, body,
    mime_type, metadata, updated_at and principals; ``mirror`` and ``mark`` are those of the current run, None on the first;
    ``deleted_ids`` (column ``id``) are tombstones. ``root`` must be a folder all executors share.

    The new mark is the newest ``updated_at`` read (NULL times count for nothing), never the clock. ``bytes_per_shard`` bounds the lines of a shard.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError("set spark.sql.session.timeZone to UTC: marks are UTC without zone")
    home = f"{root.rstrip('/')}/{source_key}"
    folder = f"{home}/runs/{run_id}"
    reconcile, since = C.reconcile_mode(mode, mark if mirror is not None else None)

    # The source is read and hashed once; every later step sees the same rows. On the first run every document goes out, so the pass that
    # hashes them writes them as shards, once; later only those that changed are joined back and written.
    hashed, limits = with_hashes(read_source(since)), (docs_per_shard, bytes_per_shard)
    totals = {"docs": F.count(F.lit(1)), "no_id": F.count_if(F.col("id").isNull()), "newest": F.max(F.col("updated_at").cast("timestamp_ntz"))}
    if mirror is None:
        kept = hashed.select(*(c for c in hashed.columns if c != "body"), import_line(F.col("body")).alias(LINE))
        seen = C.counted_while_written(kept, lambda df: write_shards(df, f"{folder}/shards", *limits), **totals)
        shards = read_manifest(spark, f"{folder}/shards")
        documents = read_state(spark, f"{folder}/shards", kept.drop(LINE).schema)
    else:
        seen = C.counted_while_written(hashed, lambda df: df.write.mode("overwrite").parquet(f"{folder}/documents"), **totals)
        documents = spark.read.parquet(f"{folder}/documents")
    state = documents.select("id", *HASHES)
    _check(documents, seen, mirror, reconcile, allow_empty)
    stamp = F.lit(synced_at).cast("timestamp_ntz")
    compared, counts = _difference(spark, state, mirror, reconcile, deleted_ids, stamp, folder)
    difference = compared.select("id", "change")
    if mirror is not None:
        lines = C.import_batch(difference, documents).select(import_line(F.col("body")).alias(LINE))
        shards = write_shards(lines, f"{folder}/shards", *limits)
    requests = _stage(documents, difference, shards, folder, run_id, reconcile)
    _next_mirror(state, compared, mirror, reconcile, stamp).write.mode("overwrite").parquet(f"{folder}/mirror")
    row = {"run_id": run_id, "source_key": source_key, "mode": mode, **{n: counts[c] for c, n in C.HISTORY.items()}, "errors": 0}
    columns = ", ".join(f"{c} {'string' if isinstance(v, str) else 'long'}" for c, v in row.items())
    spark.createDataFrame([tuple(row.values())], columns).write.mode("overwrite").parquet(f"{home}/history/run={run_id}")
    advanced = max((t for t in (seen["newest"], mark) if t is not None), default=None)
    return SyncResult(run_id, reconcile, counts, requests, advanced, folder)


def _check(documents, seen, mirror, reconcile, allow_empty) -> None:
    if seen["no_id"]:
        raise ValueError("some documents have no id")
    if not duplicate_ids(documents).isEmpty():
        raise ValueError("some ids are produced more than once; see duplicate_ids")
    empty_snapshot = reconcile == "FULL" and not seen["docs"]
    if empty_snapshot and not allow_empty and mirror is not None and not mirror.isEmpty():
        raise ValueError("the snapshot is empty and would delete everything; pass allow_empty to mean it")


def _difference(spark, state, mirror, reconcile, deleted_ids, stamp, folder) -> tuple[DataFrame, dict[str, int]]:
    """(id, change), written once, and how many there are of each; the write counts them. An incremental run looks only at the ids it was given.
    A whole run that has a mirror writes the rows of the next one beside them, so states meet the mirror once."""
    if mirror is None:
        difference = state.select("id", F.lit("insert").alias("change"))
    elif reconcile == "FULL":
        difference = C.diff_with_mirror(state, mirror, stamp)
    else:
        known = mirror.join(state.select("id"), "id", "left_semi")
        difference = C.state_mirror_diff(state, known)
        if deleted_ids is not None:
            gone = deleted_ids.select("id").distinct().join(state.select("id"), "id", "left_anti")
            gone = gone.join(mirror.select("id"), "id", "left_semi")
            difference = difference.unionByName(gone.withColumn("change", F.lit("delete")))
    classes = {c: F.count_if(F.col("change") == c) for c in C.CLASSES}
    counts = C.counted_while_written(difference, lambda df: df.write.mode("overwrite").parquet(f"{folder}/diff"), **classes)
    return spark.read.parquet(f"{folder}/diff"), counts


def _next_mirror(state, difference, mirror, reconcile, stamp) -> DataFrame:
    """The whole mirror after the run."""
    if mirror is None:
        return state.withColumn("last_synced", stamp)
    if reconcile == "FULL":
        return difference.where("change <> 'delete'").select("id", *HASHES, "last_synced")
    touched = difference.where("change <> 'same'").select("id", "change")
    fresh = state.join(touched.where("change <> 'delete'").select("id"), "id", "left_semi").withColumn("last_synced", stamp)
    return mirror.select("id", *HASHES, "last_synced").join(touched.select("id"), "id", "left_anti").unionByName(fresh)


def _stage(documents, difference, shards, folder, run_id, reconcile) -> int:
    """Write the manifest of the shards, access patches and purge requests; the number of import requests."""
    readers = principal_text(F.col("principals")).alias("readers")
    patches = C.acl_only(difference).join(documents.select("id", readers), "id").select("id", "readers")
    patches.write.mode("overwrite").json(f"{folder}/patches")
    gone = difference.where("change = 'delete'").select("id")
    purge_lines(gone, "id").write.mode("overwrite").json(f"{folder}/deletes")
    purge_requests(gone, "id").write.mode("overwrite").json(f"{folder}/purges")
    manifest = import_manifest(shards, run_id, reconcile)
    return C.counted_while_written(manifest, lambda df: df.write.mode("overwrite").parquet(f"{folder}/manifest"), n=F.count(F.lit(1)))["n"]
