"""One identity run: plan, check, stage the changes. Run it before the document sync,
so that new members can read what the documents name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import MAPPINGS_PER_REQUEST
from tidemark.operators import identity as I
from tidemark.sinks.batching import numbered_batches

KEYS = ["external_identity", "target_user", "target_group"]


@dataclass(frozen=True)
class IdentityResult:
    run_id: str
    added: int
    removed: int
    requests: int
    folder: str

    def mapping(self, spark: SparkSession) -> DataFrame:
        """What the next run takes as ``stored``."""
        return spark.read.parquet(f"{self.folder}/mapping")


def _entry(rows: DataFrame) -> DataFrame:
    blank = F.lit("")
    parts = [F.coalesce(c, blank) for c in KEYS]
    return rows.withColumn("entry", F.to_json(F.array(*parts)))


def run_identity_sync(
    spark: SparkSession, mappings: DataFrame, root: str, run_id: str, stored: DataFrame | None = None, dry_run: bool = False,
    allow_empty: bool = False, per_request: int = MAPPINGS_PER_REQUEST,
) -> IdentityResult:
    """Bring the stored mapping to ``mappings`` (an action). ``stored`` is the mapping of the current run, None on the first.

    The plan is complete and checked before anything is staged. Only the difference is: ``adds`` and ``removes``, each numbered into
    requests, so access never lapses for members who stay. The new mapping is written whole; a dry run writes none. An
    empty mapping that would remove everything is an error unless ``allow_empty`` is given.
    """
    folder = f"{root.rstrip('/')}/identities/runs/{run_id}{'-dry' if dry_run else ''}"
    _entry(mappings.select(*KEYS).distinct()).write.mode("overwrite").parquet(f"{folder}/planned")
    planned = spark.read.parquet(f"{folder}/planned")
    bad = [r[0] for r in I.mapping_violations(planned).select("external_identity").take(5)]
    if bad:
        raise ValueError(f"set exactly one of a target user or a target group: {bad}")
    if stored is not None and not allow_empty and planned.isEmpty() and not stored.isEmpty():
        raise ValueError("the mapping is empty and would remove everybody; pass allow_empty to mean it")
    before = planned.where("false") if stored is None else stored
    I.mapping_diff(before.select(*KEYS), planned.select(*KEYS)).write.mode("overwrite").parquet(f"{folder}/diff")
    change = spark.read.parquet(f"{folder}/diff")
    for kind, name in (("add", "adds"), ("remove", "removes")):
        rows = _entry(change.where(F.col("change") == kind))
        numbered_batches(rows, "entry", per_request).write.mode("overwrite").parquet(f"{folder}/{name}")
    counts = {r["change"]: r["count"] for r in change.groupBy("change").count().collect()}
    if not dry_run:
        planned.write.mode("overwrite").parquet(f"{folder}/mapping")
    requests = sum(-(-counts.get(kind, 0) // per_request) for kind in ("add", "remove"))
    return IdentityResult(run_id, counts.get("add", 0), counts.get("remove", 0), requests, folder)
