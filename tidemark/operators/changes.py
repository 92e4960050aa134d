"""Change capture: events to current state, state against mirror, and what follows.

Bodies stay out of the shuffles: states carry an id, two hashes and a version,
and a body is joined back only for ids whose content really changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

CLASSES = ("insert", "update", "acl", "delete", "same")


def latest(events: DataFrame, key: str, order: list[str], carry: list[str]) -> DataFrame:
    """The last event per key by ``order``, with its ``carry`` columns.

    ``max_by`` combines inside each task before the shuffle, so a key with a third
    of all events arrives as one row per task; a window would ship every event.
    """
    newest = F.max_by(F.struct(*order, *carry), F.struct(*order)).alias("newest")
    return events.groupBy(key).agg(newest).select(key, "newest.*")


def active_state(events: DataFrame, key: str, order: list[str], carry: list[str]) -> DataFrame:
    """Current truth: the latest event per key, deletes dropped. ``order`` ends with
    the event id, so equal times resolve to the larger id. Needs an ``op`` column."""
    return latest(events, key, order, ["op", *carry]).where("op <> 'delete'").drop("op")


def state_mirror_diff(active: DataFrame, mirror: DataFrame, key: str = "id") -> DataFrame:
    """insert, update, acl, delete or same for every id in either side (unique ids).

    Both sides hold (key, content_hash, acl_hash); states that come out of
    ``active_state`` are already partitioned by the key and are not shuffled again.
    """
    return _compared(active, mirror, key).select(F.coalesce(f"a.{key}", f"m.{key}").alias(key), _change(key).alias("change"))


def diff_with_mirror(active: DataFrame, mirror: DataFrame, synced_at: Column, key: str = "id") -> DataFrame:
    """``state_mirror_diff`` with what the next mirror holds of each id, from the same join: the rows that are no delete, without ``change``, are
    those of ``advance_mirror``."""
    stamp = F.when(F.col("change") == "same", F.col("m.last_synced")).otherwise(synced_at)
    compared = _compared(active, mirror, key).withColumn("change", _change(key))
    return compared.select(F.coalesce(f"a.{key}", f"m.{key}").alias(key), "change", "a.content_hash", "a.acl_hash", stamp.alias("last_synced"))


def _compared(active: DataFrame, mirror: DataFrame, key: str) -> DataFrame:
    return active.alias("a").join(mirror.alias("m"), F.col(f"a.{key}") == F.col(f"m.{key}"), "full_outer")


def _change(key: str) -> Column:
    return (
        F.when(F.col(f"m.{key}").isNull(), "insert")
        .when(F.col(f"a.{key}").isNull(), "delete")
        .when(~F.col("a.content_hash").eqNullSafe(F.col("m.content_hash")), "update")
        .when(~F.col("a.acl_hash").eqNullSafe(F.col("m.acl_hash")), "acl")
        .otherwise("same")
    )


def acl_only(diff: DataFrame) -> DataFrame:
    """Ids that need a metadata patch but no new body."""
    return diff.where("change = 'acl'")


def import_batch(diff: DataFrame, payloads: DataFrame, key: str = "id") -> DataFrame:
    """Payloads for inserts and updates. The filter runs before the body join."""
    return diff.where("change in ('insert', 'update')").join(payloads, key)


def missing_ids(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Ids the target still holds and the source no longer has."""
    return target.select(key).join(source.select(key), key, "left_anti")


def upsert(target: DataFrame, changed: DataFrame, key: str = "id") -> DataFrame:
    """Replace by id and add new ids; never deletes. When ``changed`` is small the
    target is filtered in place and not shuffled."""
    return target.join(changed.select(key), key, "left_anti").unionByName(changed)


def advance_mirror(active: DataFrame, mirror: DataFrame, synced_at: Column, key: str = "id") -> DataFrame:
    """The mirror after a successful sync: changed rows are stamped, deleted ids
    leave, unchanged rows keep their stamp."""
    a, m = active.alias("a"), mirror.alias("m")
    same = F.col("a.content_hash").eqNullSafe(F.col("m.content_hash")) & F.col("a.acl_hash").eqNullSafe(F.col("m.acl_hash"))
    return a.join(m, F.col(f"a.{key}") == F.col(f"m.{key}"), "left").select(
        F.col(f"a.{key}").alias(key),
        F.col("a.content_hash").alias("content_hash"),
        F.col("a.acl_hash").alias("acl_hash"),
        F.when(same & F.col(f"m.{key}").isNotNull(), F.col("m.last_synced")).otherwise(synced_at).alias("last_synced"),
    )


def full_reconcile(target: DataFrame, snapshot: DataFrame, key: str = "id") -> DataFrame:
    """keep, add or delete for every id when the target is to equal the whole snapshot.

    One plan over the whole snapshot; an empty snapshot deletes everything, which
    the sync job only allows when told so.
    """
    t = target.select(F.col(key), F.lit(True).alias("held"))
    s = snapshot.select(F.col(key), F.lit(True).alias("sent"))
    action = F.when(F.col("held").isNull(), "add").when(F.col("sent").isNull(), "delete").otherwise("keep")
    return t.join(s, key, "full_outer").select(key, action.alias("action"))


def reconcile_mode(mode: str, mark: dt.datetime | None) -> tuple[str, dt.datetime | None]:
    """(FULL or INCREMENTAL, filter mark). An incremental run without a mark reads
    everything, so it also reconciles as FULL."""
    if mode in ("initial", "reconcile") or mark is None:
        return "FULL", None
    if mode != "incremental":
        raise ValueError(f"unknown mode {mode!r}")
    return "INCREMENTAL", mark


def change_counts(diff: DataFrame) -> DataFrame:
    """One row with a count per change class."""
    return diff.agg(*[F.count_if(F.col("change") == c).alias(c) for c in CLASSES])


HISTORY = {"insert": "inserts", "update": "updates", "acl": "acl_updates", "delete": "deletes", "same": "unchanged"}


def sync_history(diff: DataFrame, run_id: str, source_key: str, mode: str, outcomes: DataFrame | None = None) -> DataFrame:
    """One audit row per run. ``errors``: requests that failed or were not answered, by their ``outcome``; none without outcomes."""
    missed = F.lit(0).cast("bigint") if outcomes is None else outcomes.agg(F.count_if(F.col("outcome") != "acknowledged")).scalar()
    counted = change_counts(diff)
    return counted.select(
        F.lit(run_id).alias("run_id"),
        F.lit(source_key).alias("source_key"),
        F.lit(mode).alias("mode"),
        *[F.col(c).alias(n) for c, n in HISTORY.items()],
        missed.alias("errors"),
    )


def counted_while_written(df: DataFrame, write: Callable[[DataFrame], None], **totals: Column) -> dict:
    """Write ``df`` and return ``totals`` over its rows, gathered by the write itself and not by another read (an action)."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in totals.items()]))
    return seen.get


def advance_watermarks(stored: DataFrame, rows: DataFrame, source: str, updated: str) -> DataFrame:
    """The next mark per source: the newest change among the rows read, or the old
    mark when nothing was read. A source without a mark is read in full.

    The marks, one short row per source, reach the rows as one map, so no row is moved before the rows of each task are one per source.
    """
    marks = stored.select(F.col("source_key").alias(source), "watermark")
    known = stored.where("source_key is not null").agg(F.map_from_entries(F.collect_list(F.struct("source_key", "watermark"))).alias("m")).select("m").scalar()
    read = rows.select(source, updated).withColumn("watermark", F.try_element_at(known, F.col(source)))
    fresh = read.where(F.col("watermark").isNull() | (F.col(updated) > F.col("watermark")))
    seen = fresh.groupBy(source).agg(F.max(updated).alias("newest"), F.count("*").alias("rows_read"))
    return marks.join(seen, source, "full_outer").select(
        F.col(source).alias("source_key"),
        F.col("watermark").alias("watermark_from"),
        F.coalesce("newest", "watermark").alias("watermark_to"),
        F.coalesce("rows_read", F.lit(0)).cast("bigint").alias("rows_read"),
    )


def watermark_age(rows: DataFrame, source: str, updated: str, now: dt.datetime, max_hours: int = 3) -> DataFrame:
    """Age of each source's newest change in seconds and whether it is over the limit."""
    newest = rows.groupBy(source).agg(F.max(updated).alias("watermark"))
    age = F.timestamp_diff("SECOND", "watermark", F.lit(now).cast("timestamp_ntz"))
    return newest.select(
        F.col(source).alias("source_key"),
        "watermark",
        age.alias("age_seconds"),
        (age > max_hours * 3600).alias("overdue"),
    )


def run_counters(routed: DataFrame) -> DataFrame:
    """seen, upserts, deletes and skipped in one pass over routed articles."""
    return routed.agg(
        F.count("*").alias("seen"),
        F.count_if(F.col("action") == "upsert").alias("upserts"),
        F.count_if(F.col("action") == "delete").alias("deletes"),
        F.count_if(F.col("action") == "skip").alias("skipped"),
    )


def change_timeline(events: DataFrame, when: str, op: str = "op") -> DataFrame:
    """What changed and when: events per day and action."""
    day = F.date_format(when, "yyyy-MM-dd").alias("day")
    return events.groupBy(day, F.col(op).alias("action")).agg(F.count("*").alias("changes"))
