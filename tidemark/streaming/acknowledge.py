"""What became of staged requests: sent requests joined with their results as two streams.

A result counts if it comes within a stated time of its request. A request is known to be unanswered once the watermarks have passed that
time; the join's state is then dropped. Only what was acknowledged enters the mirror; all else is staged again by the next run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.jobs import copy_new


def request_outcomes(requests: DataFrame, results: DataFrame, within: str, delay: str, sink: str, checkpoint: str) -> None:
    """Append (request, outcome, error) to ``sink`` for every request whose outcome is certain.

    ``requests``: stream of (request, sent_at); ``results``: stream of (request, answered_at, error), error NULL if it went well. ``outcome`` is
    acknowledged, failed or unanswered.
    """
    sent = requests.withWatermark("sent_at", delay)
    told = results.select(F.col("request").alias("answers"), "answered_at", "error").withWatermark("answered_at", delay)
    in_time = F.col("answered_at").between(F.col("sent_at"), F.col("sent_at") + F.expr(f"INTERVAL {within}"))
    joined = sent.join(told, (F.col("request") == F.col("answers")) & in_time, "left_outer")
    outcome = F.when(F.col("answers").isNull(), "unanswered").when(F.col("error").isNotNull(), "failed").otherwise("acknowledged")
    copy_new(joined.select("request", outcome.alias("outcome"), "error"), sink, checkpoint)


def final_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per request: with several results in time, one that acknowledges decides."""
    first = F.min(F.struct((F.col("outcome") != "acknowledged").alias("late"), "outcome", "error"))
    return outcomes.groupBy("request").agg(first.alias("o")).select("request", "o.outcome", "o.error")


def acknowledged_changes(difference: DataFrame, requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The changes of ids whose request was acknowledged. ``requests``: (request, id)."""
    done = requests.join(outcomes.where("outcome = 'acknowledged'"), "request", "left_semi")
    return difference.where("change <> 'same'").join(done.select("id"), "id", "left_semi")


def acknowledged_mirror(active: DataFrame, mirror: DataFrame, done: DataFrame, synced_at: Column) -> DataFrame:
    """The mirror with acknowledged changes alone: what failed or was not answered stays as it was, so the next diff finds it again."""
    touched = done.select("id")
    fresh = active.join(done.where("change <> 'delete'").select("id"), "id", "left_semi").select("id", "content_hash", "acl_hash", synced_at.alias("last_synced"))
    return mirror.select("id", "content_hash", "acl_hash", "last_synced").join(touched, "id", "left_anti").unionByName(fresh)


def staged_again(difference: DataFrame, done: DataFrame) -> DataFrame:
    """Changes that the next run has to send once more."""
    return difference.where("change <> 'same'").join(done.select("id"), "id", "left_anti")
