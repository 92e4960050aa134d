import datetime as dt
import json
import os

import pytest

from tidemark.plans.ingest import file_source, table_source
from tidemark.plans.sync_job import run_sync
from tidemark.sinks.shards import read_jsonl
from tidemark.sources.feeds import read_feed
from tidemark.sources.identity_config import plan_mappings, read_identity_config


def test_feed_shapes(spark, tmp_path):
    record = {"id": 1, "title": "t", "status": "published", "ignored": {"x": 1}}
    pages = [
        {"articles": [record, {"id": 2}], "next_page_token": "n"},
        {"items": [{"id": 3}], "next_page": None, "total": 1},
        {"result": [{"id": 4}]},
        {"d": {"results": [{"id": 5}]}},
        {"articles": []},
    ]
    (tmp_path / "pages.json").write_text("\n".join(json.dumps(p) for p in pages))
    rows = read_feed(spark, str(tmp_path), "struct<id:bigint,title:string>").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "t"), (2, None), (3, None), (4, None), (5, None)]


@pytest.fixture
def directory(spark):
    members = spark.createDataFrame(
        [("vendors", "Users/1", None, "1"), ("vendors", "Users/2", None, "2"), ("vendors", "Users/3", None, "3")],
        "group_name string, ref string, display string, value string",
    )
    users = spark.createDataFrame([("1", "a.src"), ("2", "b.src"), ("3", "c@x")], "user_id string, user_name string")
    return members, users, members.select("group_name").distinct()


def test_identity_config(spark, tmp_path, directory):
    config = {
        "groups": [
            {"databricks_group": "eng", "google_group": "eng@x"},
            {"databricks_group": "vendors", "expand_members": True, "user_overrides": {"a.src": "a@x"}},
        ],
        "users": [{"databricks_user_name": "svc@x"}, {"databricks_user_name": "u", "google_email": "u@x"}],
        "user_overrides": {"a.src": "wrong@x", "b.src": "b@x"},
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config, indent=1))
    got = plan_mappings(read_identity_config(spark, str(path)), *directory).collect()
    assert sorted((r[0], r[1] or r[2]) for r in got) == [
        ("eng", "eng@x"), ("svc@x", "svc@x"), ("u", "u@x"), ("vendors", "a@x"), ("vendors", "b@x"), ("vendors", "c@x"),
    ]
    config["groups"].append({"databricks_group": "ghosts", "expand_members": True})
    path.write_text(json.dumps(config))
    with pytest.raises(ValueError, match="ghosts"):
        plan_mappings(read_identity_config(spark, str(path)), *directory)
    config["groups"][-1] = {"databricks_group": "both", "google_group": "b@x", "expand_members": True}
    path.write_text(json.dumps(config))
    with pytest.raises(ValueError, match="both"):
        plan_mappings(read_identity_config(spark, str(path)), *directory)


def test_files_and_rows_end_to_end(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for i, name in enumerate(("a.txt", "b.md")):
        (files / name).write_bytes(b"body %d" % i)
        os.utime(files / name, (1_700_000_000 + i, 1_700_000_000 + i))
    root, now = str(tmp_path / "state"), dt.datetime(2024, 1, 1)

    current = {}

    def run(source, key, run_id):
        known = {"mirror": current[key].mirror(spark), "mark": current[key].watermark} if key in current else {}
        current[key] = run_sync(spark, source, root, key, "incremental", run_id, now, **known)
        return current[key]

    source = file_source(spark, str(files), ["readers"])
    first = run(source, "files", "r1")
    assert first.counts["insert"] == 2 and first.watermark == dt.datetime(2023, 11, 14, 22, 13, 21)
    bodies = sorted((bytes(r["body"]), r["mime_type"]) for r in read_jsonl(spark, f"{first.folder}/shards/files").collect())
    assert bodies == [(b"body 0", "text/plain"), (b"body 1", "text/markdown")]
    assert sum(run(source, "files", "r2").counts.values()) == 0
    (files / "a.txt").write_bytes(b"changed")
    assert run(source, "files", "r3").counts["update"] == 1

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rows = table_source(orders, "main", "sales", "orders", "o_orderkey", ["o_orderstatus"], ["o_totalprice"], "o_orderdate", ["g"])
    assert run(rows, "orders", "r1").counts["insert"] == orders.count()
    assert sum(run(rows, "orders", "r2").counts.values()) == 0
