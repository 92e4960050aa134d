"""The event log on plain Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_events(events: DataFrame, folder: str, when: str) -> None:
    """Append events to the log, one folder per day (an action).

    The rebalance hint lets adaptive execution merge small days and split a day
    that holds a third of all rows over several files.
    """
    dated = events.withColumn("event_date", F.date_format(when, "yyyy-MM-dd"))
    dated.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(folder)
