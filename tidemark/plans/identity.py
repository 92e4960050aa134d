"""Identity mapping over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import identity as I
from tidemark.plans import inputs as X
from tidemark.plans.registry import query


def _q(name, ctes, body):
    return query(name, X.sql_with(ctes, body))


@_q("user_mappings", "user_map", "SELECT * FROM user_map")
def user_mappings(spark, sf):
    return I.user_mappings(X.people(spark, sf))


@_q("group_mappings", "group_map", "SELECT * FROM group_map")
def group_mappings(spark, sf):
    return I.group_mappings(X.directory(spark, sf))


@_q("group_expand", "expanded", "SELECT * FROM expanded")
def group_expand(spark, sf):
    return X.expanded(spark, sf)


@_q("member_resolution", "resolved", "SELECT * FROM resolved")
def member_resolution(spark, sf):
    return X.resolved(spark, sf)


@_q("override_precedence", "emails", "SELECT * FROM emails")
def override_precedence(spark, sf):
    return X.emails(spark, sf)


@_q(
    "mapping_violations",
    "people",
    """SELECT user_name AS external_identity, email AS target_user, CASE WHEN c_nationkey = 3 THEN 'n3@example.com' END AS target_group
FROM people WHERE (coalesce(email, '') = '') = (c_nationkey <> 3)
UNION ALL SELECT r_name, NULL, NULL FROM region WHERE r_regionkey <> 2""",
)
def mapping_violations(spark, sf):
    """Mappings with neither or both targets, and config groups with neither or both settings."""
    second = F.when(F.col("c_nationkey") == 3, "n3@example.com")
    rows = X.people(spark, sf).select(
        F.col("user_name").alias("external_identity"), F.col("email").alias("target_user"), second.alias("target_group")
    )
    region_no = F.col("r_regionkey")
    config = X.table(spark, sf, "region").select(
        F.col("r_name").alias("group_name"),
        F.when(region_no == 0, F.lit("")).when(region_no == 2, "asia@example.com").alias("target_group"),
        F.when(region_no == 0, True).otherwise(False).alias("expand_members"),
    )
    bad_groups = I.config_violations(config).select(
        F.col("group_name").alias("external_identity"),
        F.lit(None).cast("string").alias("target_user"),
        F.lit(None).cast("string").alias("target_group"),
    )
    return I.mapping_violations(rows).unionByName(bad_groups)


@_q("mapping_union", "mappings", "SELECT * FROM mappings")
def mapping_union(spark, sf):
    return X.mappings(spark, sf)


_NONE = "CAST(NULL AS VARCHAR) AS target_group"


@_q(
    "roster_mappings",
    "roster",
    f"""SELECT external_id AS external_identity, email AS target_user, {_NONE} FROM roster
WHERE coalesce(external_id, '') <> '' AND email <> ''
UNION ALL SELECT DISTINCT g, email, NULL FROM (SELECT unnest(groups) AS g, email FROM roster WHERE email <> '')""",
)
def roster_mappings(spark, sf):
    return I.roster_mappings(X.roster(spark, sf))


@_q(
    "group_member_counts",
    "expanded",
    "SELECT external_identity, count(*) AS members FROM expanded GROUP BY external_identity",
)
def group_member_counts(spark, sf):
    return I.member_counts(X.expanded(spark, sf))


@_q(
    "mapping_repurge",
    "old_expanded mappings expanded directory",
    """SELECT * FROM user_map UNION ALL SELECT * FROM group_map UNION ALL SELECT * FROM expanded""",
)
def mapping_repurge(spark, sf):
    """The store holds an old expansion; only the expanded groups are replaced."""
    stored = (
        I.user_mappings(X.people(spark, sf))
        .unionByName(I.group_mappings(X.directory(spark, sf)))
        .unionByName(X.old_expanded(spark, sf))
    )
    return I.repurge(stored, X.expanded(spark, sf), X.directory(spark, sf))


@_q(
    "mapping_diff",
    "expanded old_expanded",
    """SELECT *, 'add' AS change FROM (SELECT * FROM expanded EXCEPT SELECT * FROM old_expanded)
UNION ALL SELECT *, 'remove' FROM (SELECT * FROM old_expanded EXCEPT SELECT * FROM expanded)""",
)
def mapping_diff(spark, sf):
    return I.mapping_diff(X.old_expanded(spark, sf), X.expanded(spark, sf))


@_q("stale_grants", "expanded old_expanded", "SELECT * FROM old_expanded EXCEPT SELECT * FROM expanded")
def stale_grants(spark, sf):
    return I.stale_grants(X.old_expanded(spark, sf), X.expanded(spark, sf))


@_q(
    "flatten_nested_groups",
    "people",
    """, nested AS (SELECT r_name AS parent, n_name AS child FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'EVERYWHERE', r_name FROM region UNION ALL SELECT n_name, 'AFRICA' FROM nation WHERE n_nationkey = 0),
names AS (SELECT parent AS g FROM nested UNION SELECT child FROM nested),
closure AS (SELECT * FROM (WITH RECURSIVE c(root, descendant) AS (SELECT g, g FROM names UNION
SELECT c.root, n.child FROM c JOIN nested n ON n.parent = c.descendant) SELECT * FROM c))
SELECT DISTINCT root AS group_name, user_name FROM closure JOIN nation ON n_name = descendant JOIN people ON c_nationkey = n_nationkey""",
)
def flatten_nested_groups(spark, sf):
    """Nations nest in regions, regions in one top group; one nation contains its own region (a cycle)."""
    nation, region = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    nested = (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
        .unionByName(region.select(F.lit("EVERYWHERE").alias("parent"), F.col("r_name").alias("child")))
        .unionByName(nation.where("n_nationkey = 0").select(F.col("n_name").alias("parent"), F.lit("AFRICA").alias("child")))
    )
    members = X.people(spark, sf).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return I.flatten_groups(nested, members.select(F.col("n_name").alias("group_name"), "user_name"))


@_q(
    "active_worker_mappings",
    "roster",
    f"""SELECT external_id AS external_identity, email AS target_user, {_NONE} FROM roster
WHERE active AND coalesce(external_id, '') <> '' AND email <> ''""",
)
def active_worker_mappings(spark, sf):
    return I.active_worker_mappings(X.roster(spark, sf))
