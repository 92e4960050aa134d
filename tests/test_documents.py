import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.access import principal_text
from tidemark.operators import documents as D

ARTICLE = "id string, title string, body_html string, author string, tags array<string>, url string, updated_at timestamp_ntz, status string"
AT = dt.datetime(2023, 11, 2, 7, 45)


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(
        [
            ("n1", "Canteen menu", "<div>Soup &amp; bread</div>", "Sam", ["food", "week"], "http://news.test/n1", AT, "published"),
            ("n2", "Old", "<p>gone</p>", None, None, None, AT, "deleted"),
            ("n3", None, "<p>not yet</p>", None, None, None, AT, "draft"),
            ("n4", None, "\t", None, None, None, AT, "published"),
            ("n5", None, "<p>&nbsp;</p>", None, None, None, AT, None),
            ("n6", None, "<p>text</p>", None, None, None, AT, None),
        ],
        ARTICLE,
    )


def test_routing(articles):
    got = {r["id"]: r["action"] for r in D.route_by_status(articles).collect()}
    assert got == {"n1": "upsert", "n2": "delete", "n3": "skip", "n4": "skip", "n5": "skip", "n6": "upsert"}


def test_published_article(articles):
    doc = D.published_html_document(articles).where("title = 'Canteen menu'").first()
    assert doc["mime_type"] == "text/html"
    assert base64.b64decode(doc["raw_bytes"], validate=True) == b"<div>Soup &amp; bread</div>"
    assert json.loads(doc["metadata"])["title"] == "Canteen menu"


def test_long_html_is_one_base64_line(spark):
    long = spark.createDataFrame([("1", "t", "<p>" + "é" * 500, "a", [], "u", AT, "published")], ARTICLE)
    raw = D.published_html_document(long).first()["raw_bytes"]
    assert base64.b64decode(raw, validate=True).decode() == "<p>" + "é" * 500


def test_row_metadata_replaces_built_in_and_keeps_types(spark):
    table = spark.createDataFrame(
        [(1, "own title", 2, True, None, dt.datetime(2024, 1, 1, 0, 0, 0, 5), [1, 2])],
        "k int, title string, n int, b boolean, missing string, t timestamp_ntz, l array<int>",
    ).withColumn("price", F.lit("2.50").cast("decimal(9,2)"))
    doc = D.row_to_document(table, "c", "s", "t", "k", ["n"], ["title", "n", "b", "missing", "t", "price", "l"], "t").first()
    metadata = json.loads(doc["metadata"])
    assert doc["id"] == "databricks_row:c.s.t:1"
    assert metadata["title"] == "own title" and metadata["n"] == 2 and metadata["b"] is True
    assert metadata["t"] == "2024-01-01 00:00:00.000005" and metadata["price"] == "2.50" and metadata["l"] == "[1,2]"
    assert metadata["updated_at"] == "2024-01-01T00:00:00.000005+00:00" and metadata["missing"] is None
    assert doc["principals"] == []


def test_policy_readers(spark):
    schema = (
        "document_id string, title string, name string, description string, business_unit string, language string, effective_date timestamp_ntz,"
        "expiration_date timestamp_ntz, updated_at timestamp_ntz, groups array<string>, is_public boolean, mime_type string, body string"
    )
    policies = spark.createDataFrame(
        [
            ("1", "", None, None, None, None, None, None, AT, ["r"], None, None, "b"),
            ("2", "t", "n", None, None, None, AT, None, AT, ["ALL_EMPLOYEES"], False, None, "b"),
            ("3", "t", "n", None, None, None, AT, None, AT, [], False, None, "b"),
            ("4", "t", "n", None, None, None, AT, None, AT, None, True, None, "b"),
            ("5", "t", "n", None, None, None, AT, None, AT, None, None, None, "b"),
        ],
        schema,
    )
    got = D.policy_to_document(policies, "h").select("id", "title", principal_text(F.col("principals")).alias("r")).collect()
    assert [(r["id"], r["title"], r["r"]) for r in got] == [
        ("sf:dms:1", "1", ["group:external_group:r"]), ("sf:dms:2", "t", ["idp_wide"]), ("sf:dms:3", "t", []),
        ("sf:dms:4", "t", ["idp_wide"]), ("sf:dms:5", "t", []),
    ]


def test_duplicate_ids(spark):
    assert [tuple(r) for r in D.duplicate_ids(spark.createDataFrame([("a",), ("b",), ("a",)], "id string")).collect()] == [("a", 2)]
