import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.streaming import acknowledge as K
from tidemark.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)
SENT, TOLD = "request long, sent_at timestamp", "request long, answered_at timestamp, error string"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_outcomes_wait_for_late_results(spark, tmp_path):
    folders = [str(tmp_path / x) for x in ("requests", "results", "outcomes", "checkpoint")]

    def run(sent, told):
        spark.createDataFrame(sent, SENT).write.mode("append").parquet(folders[0])
        spark.createDataFrame(told, TOLD).write.mode("append").parquet(folders[1])
        streams = [J.read_landed(spark, f, spark.read.parquet(f).schema) for f in folders[:2]]
        K.request_outcomes(*streams, "10 MINUTES", "5 minutes", *folders[2:])
        return {r.request: (r.outcome, r.error) for r in K.final_outcomes(spark.read.parquet(folders[2])).collect()}

    first = run([(i, at(i)) for i in range(5)], [(0, at(1), None), (1, at(2), "quota"), (9, at(2), None)])
    assert first == {0: ("acknowledged", None), 1: ("failed", "quota")}  # the others may still be answered
    second = run([(5, at(12))], [(2, at(11), None), (3, at(11), "gone"), (3, at(12), None)])
    assert second == {**first, 2: ("acknowledged", None), 3: ("acknowledged", None)}
    third = run([(6, at(90))], [(6, at(90), None), (4, at(89), None)])  # the answer to 4 is too late
    assert third[4] == ("unanswered", None) and third[5] == ("unanswered", None) and third[6][0] == "acknowledged"
    assert run([(7, at(200))], [(7, at(201), None)]) == {**third, 7: ("acknowledged", None)}


def test_only_acknowledged_changes_enter_the_mirror(spark):
    state = "id string, content_hash string, acl_hash string"
    active = spark.createDataFrame([("a", "2", "x"), ("b", "2", "x"), ("new", "1", "x"), ("new2", "1", "x"), ("s", "1", "x")], state)
    mirror = spark.createDataFrame([(i, "1", "x") for i in ("a", "b", "gone", "gone2", "s")], state).withColumn("last_synced", F.lit(T0).cast("timestamp_ntz"))
    difference = C.state_mirror_diff(active, mirror)
    requests = spark.createDataFrame([(1, "a"), (1, "new"), (1, "gone"), (2, "b"), (3, "new2"), (3, "gone2")], "request long, id string")
    outcomes = spark.createDataFrame([(1, "acknowledged"), (2, "failed"), (3, "unanswered")], "request long, outcome string")
    done = K.acknowledged_changes(difference, requests, outcomes)
    after = K.acknowledged_mirror(active, mirror, done, F.lit(at(9)).cast("timestamp_ntz"))
    assert {r.id: (r.content_hash, r.last_synced) for r in after.collect()} == {"a": ("2", at(9)), "new": ("1", at(9)), "b": ("1", T0), "gone2": ("1", T0), "s": ("1", T0)}
    again = {r.id: r.change for r in K.staged_again(difference, done).collect()}
    assert again == {"b": "update", "new2": "insert", "gone2": "delete"}
    left = {r.id: r.change for r in C.state_mirror_diff(active, after).where("change <> 'same'").collect()}
    assert left == again  # the next run finds exactly these
    history = C.sync_history(difference, "r", "s", "incremental", outcomes).first()
    assert (history.inserts, history.updates, history.deletes, history.unchanged, history.errors) == (2, 2, 2, 1, 2)


def test_counts_come_from_the_write(spark, tmp_path):
    rows = spark.range(1000)
    seen = C.counted_while_written(rows, lambda df: df.write.parquet(str(tmp_path / "t")), n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"n": 1000, "odd": 500}
