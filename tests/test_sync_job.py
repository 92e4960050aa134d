import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import access as A
from tidemark.plans import sync_job
from tidemark.plans.identity_job import run_identity_sync
from tidemark.plans.ingest import table_source
from tidemark.plans.sync_job import run_sync

T0 = dt.datetime(2024, 1, 1)
SCHEMA = f"id string, title string, body string, mime_type string, metadata string, updated_at timestamp_ntz, principals {A.PRINCIPALS}"


def doc(i, body="b", minute=0, readers=("g",)):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return (i, "t", body, "text/plain", "{}", at, [("group", r) for r in readers])


class Caller:
    """Keeps which run is current, as a caller must."""

    def __init__(self, spark, root, docs=()):
        self.spark, self.root, self.docs, self.current, self.runs = spark, str(root), list(docs), None, 0

    def read(self, since):
        df = self.spark.createDataFrame(self.docs, SCHEMA)
        return df if since is None else df.where(F.col("updated_at") > F.lit(since).cast("timestamp_ntz"))

    def sync(self, mode="incremental", source=None, run=None, **more):
        self.runs += 1
        known = {} if self.current is None else {"mirror": self.current.mirror(self.spark), "mark": self.current.watermark}
        at = T0 + dt.timedelta(days=1)
        self.current = run_sync(self.spark, source or self.read, self.root, "src", mode, run or f"r{self.runs}", at, **known, **more)
        return self.current

    def mirror(self):
        return sorted(r["id"] for r in self.current.mirror(self.spark).collect())


def test_life_of_a_source(spark, tmp_path):
    caller = Caller(spark, tmp_path, [doc("a"), doc("b", minute=1), doc("c", minute=2)])
    first = caller.sync(docs_per_shard=2)
    assert (first.mode, first.counts["insert"], first.watermark) == ("FULL", 3, T0 + dt.timedelta(minutes=2))
    assert spark.read.json(f"{first.folder}/shards/files").count() == 3 and first.requests == 1
    again = caller.sync()
    assert (again.mode, sum(again.counts.values()), again.watermark, again.requests) == ("INCREMENTAL", 0, first.watermark, 0)

    caller.docs = [doc("a", minute=5, readers=("h",)), doc("c", "new", 6), doc("d", minute=7)]  # b left
    delta = caller.sync()
    assert delta.counts == {"insert": 1, "update": 1, "acl": 1, "delete": 0, "same": 0}
    assert caller.mirror() == ["a", "b", "c", "d"]
    assert sorted(r["id"] for r in spark.read.json(f"{delta.folder}/shards/files").collect()) == ["c", "d"]
    assert [tuple(r) for r in spark.read.json(f"{delta.folder}/patches").select("id", "readers").collect()] == [("a", ["group:h"])]

    full = caller.sync("reconcile")
    assert full.counts == {"insert": 0, "update": 0, "acl": 0, "delete": 1, "same": 3}
    assert [r["filter"] for r in spark.read.json(f"{full.folder}/purges").collect()] == ['id: ANY("b")']
    assert caller.mirror() == ["a", "c", "d"]
    history = spark.read.parquet(f"{tmp_path}/src/history").orderBy("run_id").collect()
    assert [(h["inserts"], h["deletes"]) for h in history] == [(3, 0), (0, 0), (1, 0), (0, 1)]


def test_tombstones_and_reinsert(spark, tmp_path):
    caller = Caller(spark, tmp_path, [doc("a"), doc("b")])
    caller.sync("initial")
    caller.docs = [doc("c", minute=1)]
    gone = spark.createDataFrame([("a",), ("never",), ("a",)], "id string")
    assert caller.sync(deleted_ids=gone).counts["delete"] == 1
    assert caller.mirror() == ["b", "c"]
    caller.docs = [doc("a", minute=2)]
    assert caller.sync().counts["insert"] == 1
    assert caller.mirror() == ["a", "b", "c"]


def test_run_that_died_can_be_made_again(spark, tmp_path, monkeypatch):
    caller = Caller(spark, tmp_path, [doc("a")])
    caller.sync()
    caller.docs.append(doc("b", minute=1))

    def die(*_):
        raise RuntimeError("lost the driver")

    for step in ("_difference", "_stage", "_next_mirror"):
        monkeypatch.setattr(sync_job, step, die)
        with pytest.raises(RuntimeError, match="lost"):
            caller.sync(run="r2")
        monkeypatch.undo()
    assert caller.sync(run="r2").counts["insert"] == 1
    assert caller.mirror() == ["a", "b"] and sum(caller.sync().counts.values()) == 0


def test_guards(spark, tmp_path):
    caller = Caller(spark, tmp_path, [doc("a"), doc("a")])
    with pytest.raises(ValueError, match="more than once"):
        caller.sync("initial")
    caller.docs = [doc("a"), doc(None)]
    with pytest.raises(ValueError, match="no id"):
        caller.sync("initial")
    caller.docs = [doc("a")]
    caller.sync("initial")
    caller.docs = []
    with pytest.raises(ValueError, match="empty"):
        caller.sync("reconcile")
    assert caller.sync("reconcile", allow_empty=True).counts["delete"] == 1
    assert caller.mirror() == []


def test_rows_without_a_time_are_no_updates_and_move_no_mark(spark, tmp_path):
    table = spark.createDataFrame([(1, "x", T0), (2, "y", None)], "k int, v string, t timestamp_ntz")
    for column, mark in ((None, None), ("t", T0)):
        caller = Caller(spark, tmp_path / str(column))
        source = table_source(table, "c", "s", "t", "k", ["v"], [], column)
        assert caller.sync("initial", source).counts["insert"] == 2 and caller.current.watermark == mark
        assert caller.sync("reconcile", source).counts["same"] == 2


def test_late_rows_within_the_overlap_are_read(spark, tmp_path):
    rows = [(1, "x", T0), (2, "y", T0 + dt.timedelta(minutes=9))]
    schema, caller = "k int, v string, t timestamp_ntz", Caller(spark, tmp_path)

    def source(rows, overlap):
        return table_source(spark.createDataFrame(rows, schema), "c", "s", "t", "k", ["v"], [], "t", overlap_seconds=overlap)

    caller.sync("initial", source(rows, 600))
    late = [*rows, (3, "z", T0 + dt.timedelta(minutes=5)), (4, "same time", T0 + dt.timedelta(minutes=9))]
    assert sum(caller.sync(source=source(late, 0)).counts.values()) == 0
    assert caller.sync(source=source(late, 600)).counts == {"insert": 2, "update": 0, "acl": 0, "delete": 0, "same": 2}


def test_shards_are_bounded_by_bytes(spark, tmp_path):
    caller = Caller(spark, tmp_path, [doc(f"d{i}", "x" * 300) for i in range(40)])
    done = caller.sync(bytes_per_shard=3000)
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(f"{done.folder}/shards/files")
    assert sizes.agg(F.max("length")).first()[0] <= 3000 and sizes.count() > 5
    manifest = spark.read.parquet(f"{done.folder}/manifest").agg(F.sum("docs"), F.sum("files")).first()
    assert tuple(manifest) == (40, sizes.count())
    with pytest.raises(ValueError, match="longer than a file"):
        caller.sync("reconcile", lambda since: spark.createDataFrame([doc("big", "x" * 9000)], SCHEMA), bytes_per_shard=3000)


def test_identity_run(spark, tmp_path):
    def mapping(*rows):
        return spark.createDataFrame(list(rows), "external_identity string, target_user string, target_group string")

    first = mapping(("g", "a", None), ("g", "b", None), ("h", None, "h@x"))
    dry = run_identity_sync(spark, first, str(tmp_path), "r1", dry_run=True)
    assert (dry.added, dry.removed) == (3, 0)
    done = run_identity_sync(spark, first, str(tmp_path), "r1", per_request=2)
    assert (done.added, done.removed, done.requests) == (3, 0, 2)
    second = mapping(("g", "a", None), ("g", "c", None), ("h", None, "h@x"), ("g", "c", None))
    left = run_identity_sync(spark, second, str(tmp_path), "r2", done.mapping(spark))
    assert (left.added, left.removed, left.requests) == (1, 1, 2)
    removes = spark.read.parquet(f"{left.folder}/removes").collect()
    assert [(r["external_identity"], r["target_user"], r["batch"]) for r in removes] == [("g", "b", 0)]
    again = run_identity_sync(spark, second, str(tmp_path), "r3", left.mapping(spark))
    assert (again.added, again.removed, again.requests) == (0, 0, 0)
    with pytest.raises(ValueError, match="exactly one"):
        run_identity_sync(spark, mapping(("g", "a", "b")), str(tmp_path), "r4", again.mapping(spark))
    none = second.where("false")
    with pytest.raises(ValueError, match="everybody"):
        run_identity_sync(spark, none, str(tmp_path), "r5", again.mapping(spark))
    assert run_identity_sync(spark, none, str(tmp_path), "r5", again.mapping(spark), allow_empty=True).removed == 3
