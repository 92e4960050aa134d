import datetime as dt

from tidemark.streaming import expiring as E
from tidemark.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)
EVENTS = "id long, at timestamp, number long, op string, carried string"
HOUR = 3_600_000


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_tombstones_expire_and_older_events_change_nothing(spark, tmp_path):
    landing, sink, checkpoint = (str(tmp_path / x) for x in ("landing", "sink", "checkpoint"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(landing)
        stream = J.read_landed(spark, landing, spark.read.parquet(landing).schema)
        E.fold_expiring(stream, 24 * HOUR, "12 hours", sink, checkpoint)  # each call is a restart
        state = {r.id: (r.number, r.op, r.carried) for r in E.state_rows(spark, checkpoint).collect()}
        told = {r.id: (r.number, r.op, r.carried) for r in E.compact(spark, sink, str(tmp_path / "now")).collect()}
        assert state == told
        return state

    first = arrive((1, at(1), 1, "upsert", "a"), (2, at(1), 2, "upsert", "b"), (2, at(2), 3, "delete", None), (1, at(0), 0, "upsert", "old"))
    assert first == {1: (1, "upsert", "a"), 2: (3, "delete", None)}
    second = arrive((2, at(1), 9, "upsert", "late insert"), (3, at(5), 10, "upsert", "c"), (1, at(1), 4, "upsert", "same time, later number"))
    assert second == {1: (4, "upsert", "same time, later number"), 2: (3, "delete", None), 3: (10, "upsert", "c")}
    third = arrive((4, at(60), 11, "upsert", "d"))  # the watermark passes the tombstone by a day
    assert third == {1: second[1], 3: second[3], 4: (11, "upsert", "d")}
    assert arrive((2, at(61), 12, "upsert", "again"))[2] == (12, "upsert", "again")
