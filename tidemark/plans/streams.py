"""Streaming jobs over the events table, landed as files; each result must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import inputs as X
from tidemark.plans.registry import query
from tidemark.plans.sinks import _place
from tidemark.session import cut_lineage, run_folder
from tidemark.sources.tables import union_sources
from tidemark.sinks.batching import numbered_batches
from tidemark.streaming import acknowledge as K
from tidemark.streaming import expiring as V
from tidemark.streaming import jobs as J

# Three arrivals that together hold every event.
SLICES = [("0001-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "9999-01-01")]
ORDER = ["ts", "event_id"]
CARRY = ["op", "content_hash", "acl_hash"]


def _slice(events, bounds):
    low, high = (F.to_timestamp_ntz(F.lit(f"{b} 00:00:00")) for b in bounds)
    return events.where((F.col("ts") >= low) & (F.col("ts") < high))


def _land(spark, arrivals):
    """Each arrival becomes files that are newer than those of the one before."""
    folder = run_folder(spark, "landing")
    for rows in arrivals:
        rows.write.mode("append").parquet(folder)
    return folder


def _land_shuffled(rows, folder):
    """One arrival as six files, each with rows of all its times."""
    rows.repartition(6).write.mode("append").parquet(folder)


def _events(spark, sf):
    return X.ev(spark, sf).select("id", "ts", "event_id", "op", "content_hash", "acl_hash")


@query("stream_incremental", X.sql_with("ev", "SELECT id, ts, event_id, op, content_hash, acl_hash FROM ev"))
def stream_incremental(spark, sf):
    """Two arrivals, a run, a third arrival, a run, and one more run that finds nothing."""
    events = _events(spark, sf)
    first, second, third = (_slice(events, s) for s in SLICES)
    folder = _land(spark, [first, second])
    sink, checkpoint = run_folder(spark, "copy"), run_folder(spark, "checkpoint")
    for late in (None, third, None):
        if late is not None:
            late.write.mode("append").parquet(folder)
        J.copy_new(J.read_landed(spark, folder, events.schema), sink, checkpoint)
    return spark.read.schema(events.schema).parquet(sink)


def _folded(spark, sf, slices):
    events = _events(spark, sf)
    folder = _land(spark, [_slice(events, s) for s in slices])
    sink, checkpoint = run_folder(spark, "state"), run_folder(spark, "checkpoint")
    stream = J.read_landed(spark, folder, events.schema, files_per_batch=1)
    J.fold_state(stream, "id", ORDER, CARRY, sink, checkpoint)
    return J.read_folded(spark, sink, "id", ORDER, CARRY)


_STATE = X.sql_with("act", "SELECT id, ts, event_id, op, content_hash, acl_hash FROM act")


@query("stream_active_state", _STATE)
def stream_active_state(spark, sf):
    return _folded(spark, sf, SLICES)


@query("stream_out_of_order", _STATE)
def stream_out_of_order(spark, sf):
    """The newest slice arrives first; older events must not overwrite it."""
    return _folded(spark, sf, SLICES[::-1])


KEEP_MS = 3 * 86_400_000 + 500  # half a second more than three days: no event lies on the limit


@query(
    "stream_state_with_expiry",
    X.sql_with(
        "ev",
        """, newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS r FROM ev) WHERE r = 1)
SELECT id, ts, event_id, op, content_hash FROM newest
WHERE op <> 'delete' OR ts + INTERVAL 3 DAY + INTERVAL 500 MILLISECOND > (SELECT max(ts) FROM ev) - INTERVAL 12 HOUR""",
    ),
)
def stream_state_with_expiry(spark, sf):
    """Three arrivals, a restart before each; of the deleted ids, those of the last three days are still known."""
    events = _events(spark, sf).select("id", F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("number"), "op", F.col("content_hash").cast("string").alias("carried"))
    folder, sink, checkpoint, now = (run_folder(spark, x) for x in ("landing", "sink", "checkpoint", "now"))
    for bounds in SLICES:
        low, high = (F.to_timestamp(F.lit(f"{b} 00:00:00")) for b in bounds)
        _land_shuffled(events.where((F.col("at") >= low) & (F.col("at") < high)), folder)
        V.fold_expiring(J.read_landed(spark, folder, events.schema), KEEP_MS, "12 hours", sink, checkpoint)
    rows = V.compact(spark, sink, now)
    return rows.select("id", F.col("at").cast("timestamp_ntz").alias("ts"), F.col("number").alias("event_id"), "op", F.col("carried").cast(X.ev(spark, sf).schema["content_hash"].dataType).alias("content_hash"))


@query("stream_redelivery_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_redelivery_dedup(spark, sf):
    """The second arrival repeats the first one whole."""
    events = X.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    first, second, third = (_slice(events, s) for s in SLICES)
    folder, sink, checkpoint = (run_folder(spark, x) for x in ("landing", "once", "checkpoint"))
    for arrival in (first, union_sources(first, second), third):
        _land_shuffled(arrival, folder)
        stream = J.read_landed(spark, folder, events.schema).withColumn("at", F.col("ts").cast("timestamp"))
        J.drop_redelivered(stream, "event_id", "at", "15 days", sink, checkpoint)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type")


@query(
    "stream_change_counts",
    X.sql_with(
        "ev",
        """SELECT date_trunc('hour', ts) AS window_start, op, count(*) AS changes FROM ev
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM ev) - INTERVAL 1 DAY GROUP BY ALL""",
    ),
)
def stream_change_counts(spark, sf):
    """Hourly counts of the windows that a one-day delay has closed."""
    events = _events(spark, sf)
    folder, sink, checkpoint = (run_folder(spark, x) for x in ("landing", "windows", "checkpoint"))
    for bounds in SLICES:
        _land_shuffled(_slice(events, bounds), folder)
        stream = J.read_landed(spark, folder, events.schema).withColumn("at", F.col("ts").cast("timestamp"))
        J.windowed_counts(stream, "at", "op", "1 hour", "1 day", sink, checkpoint)
    return spark.read.parquet(sink).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "op", "changes")


PER_REQUEST = 10
SENT = "2024-02-01 00:00:00"
_REQUESTS = f""", requests AS (SELECT id, {_place("id")} // {PER_REQUEST} AS request FROM diff WHERE change <> 'same')"""


def _acknowledged(spark, sf):
    """(changes, requests, outcomes). Of three requests one is acknowledged, one fails and one is never answered; a later run moves time on."""
    changes = cut_lineage(X.diff(spark, sf))
    requests = cut_lineage(numbered_batches(changes.where("change <> 'same'").select("id"), "id", PER_REQUEST).withColumnRenamed("batch", "request"))
    at = F.to_timestamp(F.lit(SENT)) + F.make_dt_interval(secs=F.col("request").cast("decimal(18,6)"))
    numbers = requests.select("request").distinct()
    sent = numbers.select("request", at.alias("sent_at"))
    error = F.when(F.col("request") % 3 == 1, "quota")
    told = numbers.where("request % 3 <> 2").select("request", (at + F.expr("INTERVAL 20 SECONDS")).alias("answered_at"), error.alias("error"))
    later = spark.range(1).select((-F.col("id") - 1).alias("request"), F.to_timestamp(F.lit("2024-02-20 00:00:00")).alias("at"))
    folders = [run_folder(spark, x) for x in ("requests", "results", "outcomes", "checkpoint")]
    arrivals = [(sent, told), (later.select("request", F.col("at").alias("sent_at")), later.select("request", F.col("at").alias("answered_at"), F.lit(None).cast("string").alias("error")))]
    for rows in arrivals:
        for one, folder in zip(rows, folders):
            one.write.mode("append").parquet(folder)
        streams = [J.read_landed(spark, folder, one.schema) for one, folder in zip(rows, folders)]
        K.request_outcomes(*streams, "10 MINUTES", "1 hour", *folders[2:])
    outcomes = spark.read.parquet(folders[2]).where("request >= 0")
    return changes, requests, cut_lineage(K.final_outcomes(outcomes))


@query(
    "request_outcomes",
    X.sql_with("diff", "").rstrip()
    + _REQUESTS
    + """ SELECT CAST(request AS BIGINT) AS request, ['acknowledged', 'failed', 'unanswered'][request % 3 + 1] AS outcome, CASE WHEN request % 3 = 1 THEN 'quota' END AS error,
count(*) AS ids FROM requests GROUP BY request""",
)
def request_outcomes(spark, sf):
    _, requests, outcomes = _acknowledged(spark, sf)
    return outcomes.join(requests.groupBy("request").agg(F.count("*").alias("ids")), "request").select("request", "outcome", "error", "ids")


@query(
    "acknowledged_mirror",
    X.sql_with("diff act mir", "").rstrip()
    + _REQUESTS
    + f""", done AS (SELECT diff.id, change FROM diff JOIN requests USING (id) WHERE request % 3 = 0)
SELECT id, content_hash, acl_hash, TIMESTAMP '{X.MIRROR_CUT}' AS last_synced, id IN (SELECT id FROM requests) AS staged_again FROM mir WHERE id NOT IN (SELECT id FROM done)
UNION ALL SELECT act.id, content_hash, acl_hash, TIMESTAMP '{SENT}', false FROM act JOIN done ON act.id = done.id AND change <> 'delete'
UNION ALL SELECT id, NULL, NULL, NULL, true FROM requests WHERE request % 3 <> 0 AND id NOT IN (SELECT id FROM mir)""",
)
def acknowledged_mirror(spark, sf):
    """The mirror after a run of which a third was acknowledged, and what has to be sent again (not in the mirror yet, or still as it was)."""
    changes, requests, outcomes = _acknowledged(spark, sf)
    done = cut_lineage(K.acknowledged_changes(changes, requests, outcomes))
    old = X.mir(spark, sf).withColumn("last_synced", F.to_timestamp_ntz(F.lit(X.MIRROR_CUT)))
    mirror = K.acknowledged_mirror(X.act(spark, sf), old, done, F.to_timestamp_ntz(F.lit(SENT)))
    again = K.staged_again(changes, done).select("id", F.lit(True).alias("staged_again"))
    return mirror.join(again, "id", "full_outer").withColumn("staged_again", F.coalesce("staged_again", F.lit(False)))
