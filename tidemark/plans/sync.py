"""Change capture and sync over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators.documents import route_by_status
from tidemark.plans import inputs as X
from tidemark.plans.documents import ROUTED
from tidemark.plans.registry import query
from tidemark.session import cut_lineage
from tidemark.sinks.batching import numbered_batches
from tidemark.session import run_folder
from tidemark.sinks.tables import append_events
from tidemark.sources.tables import incremental_scan

CUT = dt.datetime(2024, 1, 25)
SYNCED = "2024-01-31 00:00:00"
NOW = dt.datetime(2024, 1, 30, 23, 0)


def _q(name, ctes, body):
    return query(name, X.sql_with(ctes, body))


@query(
    "watermark_advance",
    """WITH stored AS (SELECT DISTINCT event_type AS source_key, TIMESTAMP '2024-01-25' AS watermark FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'idle', TIMESTAMP '2024-01-02'),
seen AS (SELECT e.event_type AS source_key, max(e.ts) AS newest, count(*) AS n FROM events e LEFT JOIN stored s ON s.source_key = e.event_type
WHERE s.watermark IS NULL OR e.ts > s.watermark GROUP BY e.event_type)
SELECT coalesce(s.source_key, n.source_key) AS source_key, s.watermark AS watermark_from, coalesce(n.newest, s.watermark) AS watermark_to,
coalesce(n.n, 0) AS rows_read FROM stored s FULL JOIN seen n ON s.source_key = n.source_key""",
)
def watermark_advance(spark, sf):
    """Four sources resume from a mark, one starts cold, one has no rows."""
    events = X.table(spark, sf, "events")
    names = events.where("event_type <> 'error'").select(F.col("event_type").alias("source_key")).distinct()
    stored = names.withColumn("watermark", F.to_timestamp_ntz(F.lit("2024-01-25 00:00:00"))).unionByName(
        spark.range(1).select(F.lit("idle").alias("source_key"), F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")).alias("watermark"))
    )
    return C.advance_watermarks(stored, events, "event_type", "ts")


@query(
    "safety_window_scan",
    "SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-25' - INTERVAL 60 SECOND",
)
def safety_window_scan(spark, sf):
    events = X.table(spark, sf, "events").select("event_id", "ts", "user_id")
    return incremental_scan(events, "ts", CUT, overlap_seconds=60)


@_q(
    "full_reconcile",
    "act mir",
    """SELECT coalesce(a.id, m.id) AS id, CASE WHEN m.id IS NULL THEN 'add' WHEN a.id IS NULL THEN 'delete' ELSE 'keep' END AS action
FROM act a FULL JOIN mir m ON a.id = m.id""",
)
def full_reconcile(spark, sf):
    return C.full_reconcile(X.mir(spark, sf), X.act(spark, sf))


@query("event_append", X.sql_with("ev", "SELECT id, ts, event_id, op, strftime(ts, '%Y-%m-%d') AS event_date FROM ev"))
def event_append(spark, sf):
    """Two appends to one date-partitioned log, read back whole."""
    folder = run_folder(spark, "events")
    events = X.ev(spark, sf).select("id", "ts", "event_id", "op")
    append_events(X.before_cut(events), folder, "ts")
    append_events(incremental_scan(events, "ts", CUT, inclusive=True), folder, "ts")
    schema = "id bigint, ts timestamp_ntz, event_id bigint, op string, event_date string"
    return spark.read.schema(schema).parquet(folder)


@_q("active_state", "act", "SELECT id, ts, event_id, content_hash, acl_hash FROM act")
def active_state(spark, sf):
    return X.act(spark, sf)


@_q("state_mirror_diff", "diff", "SELECT id, change FROM diff")
def state_mirror_diff(spark, sf):
    return X.diff(spark, sf)


@_q("acl_only_changes", "diff", "SELECT d.id, a.acl_hash FROM diff d JOIN act a ON a.id = d.id WHERE change = 'acl'")
def acl_only_changes(spark, sf):
    return C.acl_only(X.diff(spark, sf)).join(X.act(spark, sf).select("id", "acl_hash"), "id").select("id", "acl_hash")


@_q(
    "import_batch",
    "diff act",
    """SELECT d.id, d.change, CAST(json_object('id', CAST(d.id AS VARCHAR), 'props', a.props, 'event_id', a.event_id) AS VARCHAR) AS document_json
FROM diff d JOIN act a ON a.id = d.id WHERE d.change IN ('insert', 'update')""",
)
def import_batch(spark, sf):
    """The diff runs on hashes; payloads are read again only for changed ids."""
    payloads = X.act(spark, sf, ("props",)).select(
        "id", F.to_json(F.struct(F.col("id").cast("string").alias("id"), "props", "event_id")).alias("document_json")
    )
    return C.import_batch(X.diff(spark, sf), payloads)


@_q("delete_ids", "act mir", "SELECT id FROM mir WHERE id NOT IN (SELECT id FROM act)")
def delete_ids(spark, sf):
    return C.missing_ids(X.mir(spark, sf), X.act(spark, sf))


_RECENT = f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS r
FROM ev WHERE ts >= TIMESTAMP '{X.MIRROR_CUT}') WHERE r = 1 AND op <> 'delete'"""


@_q(
    "incremental_upsert",
    "mir",
    f""", recent AS ({_RECENT}) SELECT id, ts, event_id, content_hash, acl_hash FROM recent
UNION ALL SELECT id, ts, event_id, content_hash, acl_hash FROM mir WHERE id NOT IN (SELECT id FROM recent)""",
)
def incremental_upsert(spark, sf):
    events = incremental_scan(X.ev(spark, sf), "ts", CUT, inclusive=True)
    recent = C.active_state(events, "id", ["ts", "event_id"], ["content_hash", "acl_hash"])
    return C.upsert(X.mir(spark, sf), recent)


def _stamped(state, when):
    return state.withColumn("last_synced", F.to_timestamp_ntz(F.lit(when)))


def new_mirror(spark, sf):
    return C.advance_mirror(
        X.act(spark, sf), _stamped(X.mir(spark, sf), X.MIRROR_CUT), F.to_timestamp_ntz(F.lit(SYNCED))
    )


@_q(
    "mirror_update",
    "diff act",
    f"""SELECT a.id, a.content_hash, a.acl_hash,
CASE WHEN d.change = 'same' THEN TIMESTAMP '{X.MIRROR_CUT}' ELSE TIMESTAMP '{SYNCED}' END AS last_synced
FROM act a JOIN diff d ON a.id = d.id""",
)
def mirror_update(spark, sf):
    return new_mirror(spark, sf)


_CLASS_COUNTS = """count(*) FILTER (change = 'insert') AS inserts, count(*) FILTER (change = 'update') AS updates,
count(*) FILTER (change = 'acl') AS acl_updates, count(*) FILTER (change = 'delete') AS deletes, count(*) FILTER (change = 'same') AS unchanged"""


@_q(
    "sync_history",
    "diff",
    f"""SELECT 'run-1' AS run_id, 'events' AS source_key, 'incremental' AS mode, {_CLASS_COUNTS},
(SELECT count(*) FROM (SELECT DISTINCT (row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR)), 1, 4), id) - 1) // 10 AS r FROM diff WHERE change <> 'same') WHERE r % 3 <> 0) AS errors FROM diff""",
)
def sync_history(spark, sf):
    """Two of three requests of ten ids fail."""
    difference = cut_lineage(X.diff(spark, sf))
    requests = numbered_batches(difference.where("change <> 'same'").select("id"), "id", 10).select("batch").distinct()
    outcomes = requests.select(F.when(F.col("batch") % 3 == 0, "acknowledged").otherwise("failed").alias("outcome"))
    return C.sync_history(difference, "run-1", "events", "incremental", outcomes)


@_q(
    "run_counters",
    "articles",
    f"""SELECT count(*) AS seen, count(*) FILTER (action = 'upsert') AS upserts, count(*) FILTER (action = 'delete') AS deletes,
count(*) FILTER (action = 'skip') AS skipped FROM ({ROUTED})""",
)
def run_counters(spark, sf):
    return C.run_counters(route_by_status(X.articles(spark, sf)))


@_q(
    "idempotent_rerun",
    "act",
    """SELECT CAST(0 AS BIGINT) AS "insert", CAST(0 AS BIGINT) AS "update", CAST(0 AS BIGINT) AS acl, CAST(0 AS BIGINT) AS "delete", count(*) AS same FROM act""",
)
def idempotent_rerun(spark, sf):
    """A second run against the mirror the first run left finds nothing to do."""
    return C.change_counts(C.state_mirror_diff(X.act(spark, sf), new_mirror(spark, sf)))


@_q("tombstone_split", "articles", f"SELECT CAST(id AS VARCHAR) AS id FROM ({ROUTED}) WHERE action = 'delete'")
def tombstone_split(spark, sf):
    return route_by_status(X.articles(spark, sf)).where("action = 'delete'").select(F.col("id").cast("string").alias("id"))


@query("hard_delete_audit", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def hard_delete_audit(spark, sf):
    """Documents held downstream that the labelled source no longer lists."""
    return C.missing_ids(X.table(spark, sf, "documents"), X.table(spark, sf, "labels"), "doc_id")


@query(
    "watermark_age",
    """SELECT event_type AS source_key, max(ts) AS watermark, date_sub('second', max(ts), TIMESTAMP '2024-01-30 23:00:00') AS age_seconds,
date_sub('second', max(ts), TIMESTAMP '2024-01-30 23:00:00') > 10800 AS overdue FROM events GROUP BY event_type""",
)
def watermark_age(spark, sf):
    return C.watermark_age(X.table(spark, sf, "events"), "event_type", "ts", NOW)


@_q(
    "change_timeline",
    "ev",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, op AS action, count(*) AS changes FROM ev GROUP BY ALL",
)
def change_timeline(spark, sf):
    return C.change_timeline(X.ev(spark, sf), "ts")
