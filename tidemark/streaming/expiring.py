"""The newest version per id with tombstones that expire.

State of an id is a row in the state store (RocksDB), updated in place: an older event that arrives later changes nothing. A delete keeps its
row, so that late inserts of the same id stay deleted, until the watermark is ``keep`` past it; then a timer takes the row away. What each batch changed goes to a
sink by batch; ``compact`` folds these batches into one row per id, so neither state nor sink grows with the number of events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.changes import latest
from tidemark.streaming.jobs import _run

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERSION = "at timestamp, number long, op string, carried string"
EXPIRED = "expired"


class Newest(StatefulProcessor):
    """Rows (id, at, number, op, carried); the version is (at, number)."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.newest = handle, handle.getValueState("newest", VERSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        best = held
        for frame in rows:
            for row in frame.itertuples(index=False):
                version = (pd.Timestamp(row.at), int(row.number))
                if best is None or version > (pd.Timestamp(best[0]), int(best[1])):
                    best = (row.at.to_pydatetime(), int(row.number), row.op, row.carried)
        if best is not held:
            self.newest.update(best)
            if best[2] == "delete":
                self.handle.registerTimer(self._due(best))
            yield pd.DataFrame([[key[0], *best]], columns=["id", "at", "number", "op", "carried"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        if held is not None and held[2] == "delete" and self._due(held) <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
            yield pd.DataFrame([[key[0], held[0], held[1], EXPIRED, held[3]]], columns=["id", "at", "number", "op", "carried"])

    def _due(self, version) -> int:
        return int(pd.Timestamp(version[0]).timestamp() * 1000) + self.keep_ms

    def close(self) -> None:
        pass


def fold_expiring(stream: DataFrame, keep_ms: int, delay: str, sink: str, checkpoint: str) -> None:
    """Fold (id, at, number, op, carried) into the newest version per id. Needs the RocksDB state store, which is set for this query alone."""
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    try:
        grouped = stream.withWatermark("at", delay).groupBy("id")
        id_type = stream.schema["id"].dataType.simpleString()
        folded = grouped.transformWithStateInPandas(Newest(keep_ms), outputStructType=f"id {id_type}, {VERSION}", outputMode="Update", timeMode="EventTime")
        _run(folded.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state store holds: one row per id."""
    read = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
    return read.select("key.*", "value.*")


def compact(spark: SparkSession, sink: str, folder: str) -> DataFrame:
    """All batches of ``sink`` as one row per id, written to ``folder``; ids whose tombstone expired are gone."""
    changes = spark.read.parquet(sink).withColumn("last", F.col("op") == EXPIRED)
    rows = latest(changes, "id", ["at", "number", "last"], ["op", "carried"]).where(F.col("op") != EXPIRED).drop("last")
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)
