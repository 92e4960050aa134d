import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.sources.files import changed_objects
from tidemark.sources.tables import active_in_categories, incremental_scan, projected_scan

T0 = dt.datetime(2024, 1, 1)
STATE = "id string, content_hash string, acl_hash string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_event_wins_with_ties_and_a_hot_key(spark):
    rng = random.Random(7)
    events = [
        ("hot" if rng.random() < 0.35 else f"k{rng.randrange(40)}", T0 + dt.timedelta(minutes=rng.randrange(30)), i,
         rng.choice(["insert", "update", "delete"]), rng.randrange(9))
        for i in range(2000)
    ]
    rng.shuffle(events)
    frame = spark.createDataFrame(events, "id string, ts timestamp_ntz, event_id long, op string, v int")
    expected = {}
    for e in sorted(events, key=lambda e: (e[1], e[2])):
        expected[e[0]] = e
    alive = sorted((e[0], e[1], e[2], e[4]) for e in expected.values() if e[3] != "delete")
    assert rows(C.active_state(frame, "id", ["ts", "event_id"], ["v"])) == alive


def test_diff_then_mirror_then_nothing_to_do(spark):
    active = spark.createDataFrame([("a", "1", "x"), ("b", "2", "x"), ("c", "3", "y"), ("d", "4", "x")], STATE)
    mirror = spark.createDataFrame([("b", "9", "x", T0), ("c", "3", "x", T0), ("d", "4", "x", T0), ("e", "5", "x", T0)], STATE + ", last_synced timestamp_ntz")
    diff = C.state_mirror_diff(active, mirror)
    assert rows(diff) == [("a", "insert"), ("b", "update"), ("c", "acl"), ("d", "same"), ("e", "delete")]
    now = T0 + dt.timedelta(days=1)
    updated = C.advance_mirror(active, mirror, F.lit(now).cast("timestamp_ntz"))
    assert [(r[0], r[3] == now) for r in rows(updated)] == [("a", True), ("b", True), ("c", True), ("d", False)]
    assert C.change_counts(C.state_mirror_diff(active, updated)).first().asDict() == {
        "insert": 0, "update": 0, "acl": 0, "delete": 0, "same": 4,
    }


def test_diff_and_next_mirror_from_one_join(spark):
    """As ``state_mirror_diff`` and ``advance_mirror`` give them, NULL hashes included."""
    active = spark.createDataFrame([("a", "1", "x"), ("b", "2", "x"), ("c", "3", "y"), ("d", "4", "x"), ("n", None, "x")], STATE)
    mirror = spark.createDataFrame([(i, c, a, T0) for i, c, a in (("b", "9", "x"), ("c", "3", "x"), ("d", "4", "x"), ("e", "5", "x"), ("n", None, "x"))], STATE + ", last_synced timestamp_ntz")
    stamp = F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz")
    both = C.diff_with_mirror(active, mirror, stamp)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(both.select("id", "change")) == rows(C.state_mirror_diff(active, mirror))
    assert rows(both.where("change <> 'delete'").drop("change")) == rows(C.advance_mirror(active, mirror, stamp))


def test_upsert_never_deletes_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", "1", "x"), ("b", "2", "x")], STATE)
    changed = spark.createDataFrame([("b", "3", "x"), ("c", "4", "x")], STATE)
    once = C.upsert(target, changed)
    assert rows(once) == rows(C.upsert(once, changed)) == [("a", "1", "x"), ("b", "3", "x"), ("c", "4", "x")]


def test_full_reconcile_of_an_empty_snapshot_deletes_all(spark):
    target = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(C.full_reconcile(target, target.where("false"))) == [("a", "delete"), ("b", "delete")]


def test_modes():
    assert C.reconcile_mode("incremental", None) == ("FULL", None)
    assert C.reconcile_mode("incremental", T0) == ("INCREMENTAL", T0)
    assert C.reconcile_mode("reconcile", T0) == ("FULL", None)
    with pytest.raises(ValueError):
        C.reconcile_mode("sometimes", T0)


def test_null_watermark_is_kept_by_full_and_dropped_by_incremental(spark):
    table = spark.createDataFrame([(1, T0), (2, None), (3, T0 + dt.timedelta(seconds=1))], "k int, t timestamp_ntz")
    assert incremental_scan(table, "t", None).count() == incremental_scan(table, None, T0).count() == 3
    assert [r["k"] for r in incremental_scan(table, "t", T0).collect()] == [3]
    assert sorted(r["k"] for r in incremental_scan(table, "t", T0, inclusive=True).collect()) == [1, 3]
    assert sorted(r["k"] for r in incremental_scan(table, "t", T0, overlap_seconds=60).collect()) == [1, 3]


def test_scan_pushes_filter_and_columns(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    scan = incremental_scan(projected_scan(orders, "o_orderkey", ["o_orderstatus"], [], "o_orderdate"), "o_orderdate", T0)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan
    assert "struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_active_in_categories(spark):
    table = spark.createDataFrame([(1, "a", True, T0), (2, "a", False, T0), (3, "b", True, T0)], "k int, c string, on boolean, t timestamp_ntz")
    before = T0 - dt.timedelta(days=1)
    assert [r["k"] for r in active_in_categories(table, "c", ["a"], "on", [True], "t", before).collect()] == [1]


def test_empty_mirror_makes_every_object_new(spark):
    objects = spark.createDataFrame([("u", T0, 1)], "uri string, updated timestamp_ntz, size long")
    mirror = spark.createDataFrame([], "id string, last_synced timestamp_ntz")
    assert changed_objects(objects, mirror).count() == 1
    seen = spark.createDataFrame([("u", T0)], "id string, last_synced timestamp_ntz")
    assert changed_objects(objects, seen).count() == 0


def test_watermarks(spark):
    stored = spark.createDataFrame([("a", T0), ("quiet", T0)], "source_key string, watermark timestamp_ntz")
    later = T0 + dt.timedelta(hours=1)
    events = spark.createDataFrame([("a", T0), ("a", later), ("cold", T0)], "s string, t timestamp_ntz")
    assert rows(C.advance_watermarks(stored, events, "s", "t").drop("watermark_from")) == [
        ("a", later, 1), ("cold", T0, 1), ("quiet", T0, 0),
    ]


def test_watermark_age(spark):
    events = spark.createDataFrame([("a", T0), ("b", T0 + dt.timedelta(hours=3))], "s string, t timestamp_ntz")
    got = rows(C.watermark_age(events, "s", "t", T0 + dt.timedelta(hours=4)).select("source_key", "age_seconds", "overdue"))
    assert got == [("a", 14400, True), ("b", 3600, False)]
