import pytest
from pyspark.sql import functions as F

from tidemark.functions import access as A
from tidemark.operators import access as O


def readers(df, principals):
    return [r[0] for r in df.select(A.principal_text(principals)).collect()]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(["a@x"], ["g", "t@x"], False), (["a@x"], ["g"], True), ([], [], False), (None, None, None)],
        "users array<string>, groups array<string>, public boolean",
    )


def test_principals(rows):
    got = readers(rows, A.reader_principals(F.col("users"), F.col("groups"), F.col("public")))
    assert got == [["user:a@x", "group:external_group:g", "group:t@x"], ["idp_wide"], [], []]


def test_external_principals_mark_nobody(rows):
    got = readers(rows, A.external_principals(F.col("users"), F.col("groups"), F.col("public")))
    nobody = ["user:external_user:__no_readers_sentinel__"]
    assert got == [
        ["user:external_user:a@x", "group:external_group:g", "group:external_group:t@x"], ["idp_wide"], nobody, nobody,
    ]


@pytest.mark.parametrize("policy, empty", [("deny", []), ("open", ["idp_wide"])])
def test_csv_lists(spark, policy, empty):
    df = spark.createDataFrame([(" a, ,b ,",), ("",), (" , ",), (None,)], "c string")
    got = readers(df, A.csv_principals(F.col("c"), policy))
    assert got == [["group:external_group:a", "group:external_group:b"], empty, empty, empty]


def test_access_key_ignores_order_and_repeats(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "a", "a"],), (["a"],)], "users array<string>")
    none = F.array().cast("array<string>")
    keys = [r[0] for r in df.select(A.access_key(A.reader_principals(F.col("users"), none, F.lit(False)))).collect()]
    assert keys[0] == keys[1] != keys[2]


def test_visibility_against_brute_force(spark):
    """One reader list on a third of all documents, groups that overlap, public and unread documents."""
    names = ["u1", "u2", "u3", "u4"]
    documents = []
    for i in range(60):
        if i % 3 == 0:
            documents.append((i, [], ["hot"], False))
        elif i % 7 == 0:
            documents.append((i, [], [], i % 2 == 0))
        else:
            documents.append((i, [names[i % 4]], [f"g{i % 5}", "t@x"][: i % 3], False))
    frame = spark.createDataFrame(documents, "doc_id long, users array<string>, groups array<string>, public boolean")
    acl = frame.select("doc_id", A.reader_principals(F.col("users"), F.col("groups"), F.col("public")).alias("principals"))
    mappings = spark.createDataFrame(
        [("hot", "u1", None), ("hot", "u2", None), ("g1", None, "grp@x"), ("g2", "u3", None), ("u4", "u4", None), ("u1", "u1", None)],
        "external_identity string, target_user string, target_group string",
    )
    memberships = spark.createDataFrame([("grp@x", "u4"), ("grp@x", "u1"), ("t@x", "u2")], "target_group string, user string")
    held = O.user_principals(mappings, memberships)

    texts = {r["doc_id"]: set(r["p"]) for r in acl.select("doc_id", A.principal_text(F.col("principals")).alias("p")).collect()}
    tokens = {}
    for r in held.collect():
        tokens.setdefault(r["user"], set()).add(r["principal"])
    expected = {u: {d for d, p in texts.items() if p & (t | {"idp_wide"})} for u, t in tokens.items()}

    apart = (F.col("doc_id") * 9001).cast("bigint")  # over many bitmaps
    for number in (F.col("doc_id"), apart):
        counted = {r["user"]: r["visible"] for r in O.visible_counts(acl, held, number).collect()}
        assert counted == {u: len(d) for u, d in expected.items()}
    users, of_profiles, own = O.visible_bitmaps(O.principal_bitmaps(acl, apart), held)
    bits = lambda r: {(r["bucket"] - 1) * 32768 + 8 * k + j + 1 if r["bucket"] else 0 for k, byte in enumerate(r["docs"]) for j in range(8) if byte >> j & 1}
    seen = {u: set() for u in expected}
    for r in users.join(of_profiles, "profile").select("user", "bucket", "docs").unionByName(own.drop("profile")).collect():
        seen[r["user"]] |= bits(r)
    assert seen == {u: {9001 * d for d in docs} for u, docs in expected.items()}
    for user, docs in expected.items():
        opened = O.open_classes(acl, held.where(F.col("user") == user))
        assert sorted(r[0] for r in O.visible_documents(acl, opened).collect()) == sorted(docs)
        assert sorted(r[0] for r in O.hidden_documents(acl, opened).collect()) == sorted(set(texts) - docs)


def test_sum_of_visible_numbers(spark):
    """Numbers in several bitmaps, 0 and the ends of bitmaps among them, some of them named by the user and by a group of theirs."""
    numbers = [0, 1, 2, 32767, 32768, 32769, 65536, 65537, 9_000_000]
    documents = spark.createDataFrame([(n, [p for p, c in (("group:g", i % 2), ("user:a", i % 3), ("idp_wide", i != 4)) if not c]) for i, n in enumerate(numbers)], "n long, names array<string>")
    acl = documents.select("n", F.transform("names", lambda p: F.struct(F.substring_index(p, ":", 1).alias("kind"), F.when(F.contains(p, F.lit(":")), F.substring_index(p, ":", -1)).alias("id"))).alias("principals"))
    texts = {r["n"]: set(r["p"]) for r in acl.select("n", A.principal_text(F.col("principals")).alias("p")).collect()}
    held = spark.createDataFrame([("a", "group:g", True), ("a", "user:a", False), ("b", "group:other", True)], "user string, principal string, shared boolean")
    tokens = {"a": {"group:g", "user:a", "idp_wide"}, "b": {"idp_wide", "group:other"}}
    want = {u: (len(d), sum(d)) for u, t in tokens.items() for d in [[n for n, p in texts.items() if p & t]]}
    assert {r["user"]: (r["visible"], r["checksum"]) for r in O.visible_counts(acl, held, F.col("n")).collect()} == want


def test_principals_that_no_document_names_make_no_profiles(spark):
    """The table of profiles and buckets grows with what documents name, not with the users."""
    index = O.principal_bitmaps(spark.range(5).select("id", F.array(F.struct(F.lit("group").alias("kind"), F.lit("g").alias("id"))).alias("principals")), F.col("id"))
    held = spark.range(40).select(F.format_string("u%d", "id").alias("user"), F.explode(F.array(F.format_string("group:own%d", "id"), F.lit("group:g"))).alias("principal"), F.lit(True).alias("shared"))
    held = held.unionByName(spark.createDataFrame([("nobody", "user:nobody", False)], held.schema))
    users, of_profiles, own = O.visible_bitmaps(index, held)
    assert (users.count(), users.select("profile").distinct().count(), own.count()) == (41, 2, 0)
    assert of_profiles.groupBy("profile").count().count() == 1


def test_unresolved(spark):
    acl = spark.createDataFrame([(1, [("group", "external_group:gone")]), (2, [("user", "u1")])], f"doc_id long, principals {A.PRINCIPALS}")
    mappings = spark.createDataFrame([("g", "u1", None)], "external_identity string, target_user string, target_group string")
    assert [tuple(r) for r in O.unresolved_principals(acl, mappings).collect()] == [("group:external_group:gone", "gone", 1)]
