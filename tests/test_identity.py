import pytest

from tidemark.operators import identity as I
from tidemark.sources.identity_config import read_identity_config

MAPPING = "external_identity string, target_user string, target_group string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_member_resolution(spark):
    members = spark.createDataFrame(
        [
            ("g", "https://x/Groups/7", "nested", "7"),
            ("g", "Users/1", "a@x", "1"),
            ("g", "Users/2", "No Address", "2"),
            ("g", None, None, "404"),
            ("g", "Users/3", None, None),
        ],
        "group_name string, ref string, display string, value string",
    )
    users = spark.createDataFrame([("1", "other"), ("2", "b")], "user_id string, user_name string")
    assert rows(I.resolve_members(members, users)) == [("g", "a@x"), ("g", "b")]


def test_group_override_wins(spark):
    resolved = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a"), ("h", "c")], "group_name string, user_name string")
    group = spark.createDataFrame([("g", "a", "group@x")], "group_name string, user_name string, email string")
    everywhere = spark.createDataFrame([("a", "global@x"), ("b", "bb@x")], "user_name string, email string")
    assert rows(I.override_email(resolved, group, everywhere)) == [
        ("g", "a", "group@x"), ("g", "b", "bb@x"), ("h", "a", "global@x"), ("h", "c", "c"),
    ]


def test_violations(spark):
    mappings = spark.createDataFrame(
        [("ok", "u", None), ("both", "u", "g"), ("none", None, None), ("blank", "", None), ("ok2", "", "g")], MAPPING
    )
    assert [r[0] for r in rows(I.mapping_violations(mappings).select("external_identity"))] == ["blank", "both", "none"]
    groups = spark.createDataFrame(
        [("a", "g@x", False), ("b", None, True), ("c", "", True), ("d", None, None)],
        "group_name string, target_group string, expand_members boolean",
    )
    assert [r[0] for r in rows(I.config_violations(groups))] == ["c", "d"]


def test_unknown_group(spark):
    groups = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "group_name string, expand_members boolean")
    known = spark.createDataFrame([("a",)], "group_name string")
    assert rows(I.unknown_groups(groups, known)) == [("b",)]


def test_repurge_diff_and_stale(spark):
    stored = spark.createDataFrame([("g", "old", None), ("g", "stays", None), ("h", "x", None)], MAPPING)
    current = spark.createDataFrame([("g", "stays", None), ("g", "new", None)], MAPPING)
    groups = spark.createDataFrame([("g", True), ("emptied", True)], "group_name string, expand_members boolean")
    assert [r[1] for r in rows(I.repurge(stored, current, groups))] == ["new", "stays", "x"]
    only_g = stored.where("external_identity = 'g'")
    assert [(r[1], r[3]) for r in I.mapping_diff(only_g, current).orderBy("target_user").collect()] == [("new", "add"), ("old", "remove")]
    assert [r[1] for r in I.stale_grants(only_g, current).collect()] == ["old"]


def test_roster(spark):
    roster = spark.createDataFrame(
        [("s1", "a@x", ["g", "g"], True), (None, "b@x", ["g"], True), ("s3", "", ["g"], True), ("s4", "d@x", None, False)],
        "external_id string, email string, groups array<string>, active boolean",
    )
    assert [r[:2] for r in rows(I.roster_mappings(roster).fillna(""))] == [("g", "a@x"), ("g", "b@x"), ("s1", "a@x"), ("s4", "d@x")]
    assert [r[0] for r in I.active_worker_mappings(roster).collect()] == ["s1"]


def test_nested_groups_with_a_cycle(spark):
    nested = spark.createDataFrame([("top", "mid"), ("mid", "low"), ("low", "top"), ("top", "side")], "parent string, child string")
    members = spark.createDataFrame([("low", "u1"), ("side", "u2"), ("alone", "u3"), ("mid", "u1")], "group_name string, user_name string")
    got = rows(I.flatten_groups(nested, members))
    ring = [(g, u) for g in ("low", "mid", "top") for u in ("u1", "u2")]
    assert got == sorted(ring + [("side", "u2"), ("alone", "u3")])


def test_nesting_has_no_bound(spark):
    nested = spark.createDataFrame([(str(i), str(i + 1)) for i in range(40)], "parent string, child string")
    assert I.group_closure(nested).count() == 40 * 41 // 2


def test_cut_off_config_is_an_error(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{"groups": [{"databricks_group": "a", "google_group": "b@x"}, {"databr')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_identity_config(spark, str(path)).groups.collect()
