import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.payload import decode_attachment
from tidemark.sources.files import mime_by_extension, read_files


def one(spark, value, expression, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expression(F.col("v"))).first()[0]


def html_text(spark, value, **flags):
    return X.with_html_text(spark.createDataFrame([(value,)], "v string"), "v", "t", **flags).first()["t"]


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<h1>Two</h1>words", "Two words"),
        ("x y &nbsp; z", "x y z"),
        ("&amp;quot; &eacute; &#x41; &amp", "&quot; é A &"),
        ("<style>p { margin: 1 < 2</style>end", "p { margin: 1 end"),
        ("  \x1c lead\x85 ", "lead"),
        ("", ""),
        ("&lt;b&gt; &#39;q&#39; &middot; &copy;", "<b> 'q' · ©"),
    ],
)
def test_html_to_text(spark, source, expected):
    assert html_text(spark, source) == expected


def test_html_to_text_of_null_is_empty(spark):
    assert html_text(spark, None) == ""


WRAPPED = st.tuples(st.sampled_from(["<p>", "<br/>", " ", "\n", "<a href='x'>", "&nbsp;", "\t<i>"]), st.sampled_from([("one", "one"), ("&lt;", "<"), ("&amp;lt;", "&lt;"), ("caf&eacute;", "café"), ("&#51;", "3"), ("a&b", "a&b")]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(WRAPPED, max_size=8), min_size=20, max_size=20))
def test_html_to_text_any(spark, sources):
    """Words are known first and then wrapped in tags, spaces and entities."""
    rows = spark.createDataFrame([(i, "".join(gap + word for gap, (word, _) in parts)) for i, parts in enumerate(sources)], "i int, v string")
    got = {r["i"]: r["t"] for r in X.with_html_text(rows, "v", "t").collect()}
    assert got == {i: " ".join(text for _, (_, text) in parts) for i, parts in enumerate(sources)}


def test_raw_variants_keep_spaces_or_entities(spark):
    assert html_text(spark, "<p>a  &amp; b</p>", space="strip") == "a  & b"
    assert html_text(spark, "<p>a &amp; b</p>", unescape=False, space="strip") == "a &amp; b"


@pytest.mark.parametrize("value", [0.1, 1.0, 12345678.9, 1e7, 1e15, 1e16, 1.5e-4, 1e-5, 2.5e300, -1e7, float("inf"), 1e22])
def test_floats_print_like_the_sources(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(X.as_text("v", df.schema["v"].dataType)).first()[0] == str(value)


def test_row_text(spark):
    df = spark.createDataFrame(
        [(1, "x", True, dt.datetime(2024, 1, 1, 0, 0, 0, 500000)), (None, None, None, None)],
        "n int, s string, b boolean, t timestamp_ntz",
    )
    got = [r[0] for r in df.select(X.render_row_text(["s", "n", "b", "t"], df.schema)).collect()]
    assert sorted(got) == [".", "s: x. n: 1. b: True. t: 2024-01-01 00:00:00.500000."]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("/Date(1700000000123)/", dt.datetime(2023, 11, 14, 22, 13, 20, 123000)),
        ("/Date(1700000000000+0060)/", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("2024-05-15T10:00:00Z", dt.datetime(2024, 5, 15, 10)),
        ("2024-05-15T10:00:00+02:00", dt.datetime(2024, 5, 15, 8)),
        ("2024-05-15T10:00:00", dt.datetime(2024, 5, 15, 10)),
        ("/Date(-1000)/", dt.datetime(1969, 12, 31, 23, 59, 59)),
        ("bad", None),
        (None, None),
    ],
)
def test_mixed_dates(spark, value, expected):
    assert one(spark, value, X.parse_mixed_date) == expected


def test_first_filled(spark):
    df = spark.createDataFrame([(None, "", "id"), ("", "n", "id"), ("t", "n", "id")], "a string, b string, c string")
    got = [r[0] for r in df.select(X.first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["id", "n", "t"]


def test_file_ids_are_short_and_tell_paths_apart(spark):
    def make(c):
        return X.file_document_id("f", c)

    assert one(spark, "/a/b", make) == "f:_a_b" and one(spark, "/a_b", make).startswith("f:_a_b_")
    cut = [one(spark, "x" * 3000 + end, make) for end in "ab"]
    assert [len(i) for i in cut] == [1024, 1024] and cut[0] != cut[1]


def test_mime(spark):
    got = [one(spark, n, mime_by_extension) for n in ("A.PDF", "b.tar.gz", "README", ".csv", "x.Htm")]
    assert got == ["application/pdf", "application/octet-stream", "application/octet-stream", "text/csv", "text/html"]


def test_decode_attachment(spark):
    import base64
    import gzip

    bodies = [b"plain", gzip.compress(b"zipped"), b"\x1f\x8bnot gzip", b""]
    rows = [(i, base64.b64encode(b).decode()) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", decode_attachment(F.col("v")).alias("b"))
    got = [bytes(r["b"]) for r in df.orderBy("i").collect()]
    assert got == [b"plain", b"zipped", b"\x1f\x8bnot gzip", b""]


def test_files_changed_strictly_after(spark, tmp_path):
    import os

    for i, name in enumerate(("a.txt", "sub/b.pdf", "sub/deep/c")):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * (i + 1))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    everything = read_files(spark, str(tmp_path), with_body=True).collect()
    assert sorted((r["name"], r["length"], bytes(r["body"])) for r in everything) == [
        ("a.txt", 1, b"x"), ("b.pdf", 2, b"xx"), ("c", 3, b"xxx"),
    ]
    later = read_files(spark, str(tmp_path), since="2023-11-14T22:13:20").collect()
    assert sorted(r["name"] for r in later) == ["b.pdf", "c"]


def test_objects_are_opened_by_name(spark, tmp_path):
    from tidemark.sources.files import read_objects

    (tmp_path / "a.bin").write_bytes(b"\x00\x01" * 10)
    (tmp_path / "empty").write_bytes(b"")
    uris = [(f"file:{tmp_path}/a.bin",), (f"file://{tmp_path}/empty",), (f"file:{tmp_path}/gone",), (None,)]
    got = {r.uri.rsplit("/", 1)[1]: (r.body, r.error is None) for r in read_objects(spark.createDataFrame(uris, "uri string"), 2).collect()}
    assert got == {"a.bin": (b"\x00\x01" * 10, True), "empty": (b"", True), "gone": (None, False)}
    assert read_objects(spark.createDataFrame([], "uri string")).count() == 0
