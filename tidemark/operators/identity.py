"""Identity mapping: external names to target users and groups.

A mapping row is (external_identity, target_user, target_group) with exactly one
target. Joins run on user keys, never on group names, so a group holding a third
of all members is not a hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import first_filled
from tidemark.session import cut_lineage


def _mapping(external: Column, user: Column | None = None, group: Column | None = None) -> list[Column]:
    missing = F.lit(None).cast("string")
    return [
        external.cast("string").alias("external_identity"),
        (missing if user is None else user).alias("target_user"),
        (missing if group is None else group).alias("target_group"),
    ]


def user_mappings(users: DataFrame) -> DataFrame:
    """user_name to email; without an email the user_name itself."""
    return users.select(*_mapping(F.col("user_name"), user=first_filled(F.col("email"), F.col("user_name"))))


def group_mappings(groups: DataFrame) -> DataFrame:
    """Groups with a target group, one to one."""
    return groups.where("target_group is not null").select(
        *_mapping(F.col("group_name"), group=F.col("target_group"))
    )


def resolve_members(members: DataFrame, users: DataFrame) -> DataFrame:
    """Members (group_name, ref, display, value) to user names.

    Nested groups are skipped, a display name holding ``@`` wins, otherwise the id is
    looked up; unknown ids drop out. Members that need no lookup bypass the join, so
    no pile of NULL keys meets in one task.
    """
    people = members.where(~F.lower(F.coalesce("ref", F.lit(""))).contains("groups/"))
    has_name = F.coalesce(F.col("display").contains("@"), F.lit(False))
    shown = people.where(has_name).select("group_name", F.col("display").alias("user_name"))
    looked_up = (
        people.where(~has_name)
        .select("group_name", F.col("value").alias("user_id"))
        .join(users.where("user_name is not null").select("user_id", "user_name"), "user_id")
        .select("group_name", "user_name")
    )
    return shown.unionByName(looked_up)


def override_email(resolved: DataFrame, group_overrides: DataFrame, global_overrides: DataFrame) -> DataFrame:
    """Adds ``email``: the group's own override, else the global one, else the user name."""
    return (
        resolved.join(group_overrides.withColumnRenamed("email", "group_email"), ["group_name", "user_name"], "left")
        .join(global_overrides.withColumnRenamed("email", "global_email"), "user_name", "left")
        .select("group_name", "user_name", F.coalesce("group_email", "global_email", "user_name").alias("email"))
    )


def expand_groups(groups: DataFrame, emails: DataFrame) -> DataFrame:
    """One mapping row per current member of every group marked for expansion."""
    wanted = groups.where("expand_members").select("group_name")
    return emails.join(wanted, "group_name", "left_semi").select(
        *_mapping(F.col("group_name"), user=F.col("email"))
    )


def unknown_groups(groups: DataFrame, directory: DataFrame) -> DataFrame:
    """Groups to expand that the directory does not know: an error for the caller to raise."""
    return groups.where("expand_members").select("group_name").join(directory.select("group_name"), "group_name", "left_anti")


def mapping_violations(mappings: DataFrame) -> DataFrame:
    """Rows that set both targets or neither; an empty string counts as not set."""

    def unset(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) == ""

    return mappings.where(unset("target_user") == unset("target_group"))


def config_violations(groups: DataFrame) -> DataFrame:
    """Config groups that set both or neither of a target group and member expansion.
    A target group counts as set when present at all, even if empty."""
    return groups.where(F.col("target_group").isNotNull() == F.coalesce("expand_members", F.lit(False)))


def roster_mappings(roster: DataFrame) -> DataFrame:
    """Roster rows (external_id, email, groups) to user rows and per-group member rows."""
    mailed = roster.where("coalesce(email, '') <> ''")
    users = mailed.where("coalesce(external_id, '') <> ''").select(*_mapping(F.col("external_id"), user=F.col("email")))
    members = (
        mailed.select(F.explode("groups").alias("g"), "email").distinct().select(*_mapping(F.col("g"), user=F.col("email")))
    )
    return users.unionByName(members)


def active_worker_mappings(workers: DataFrame) -> DataFrame:
    """Active workers that have both an external id and an address."""
    return workers.where("active and coalesce(external_id, '') <> '' and coalesce(email, '') <> ''").select(
        *_mapping(F.col("external_id"), user=F.col("email"))
    )


def member_counts(expanded: DataFrame) -> DataFrame:
    return expanded.groupBy("external_identity").agg(F.count("*").alias("members"))


def repurge(stored: DataFrame, expanded: DataFrame, groups: DataFrame) -> DataFrame:
    """The mapping after replacing all rows of the expanded groups by current ones.

    Built as one new table, so there is no moment without access. A group that lost
    its last member is purged too.
    """
    purged = groups.where("expand_members").select(F.col("group_name").alias("external_identity"))
    return stored.join(purged, "external_identity", "left_anti").unionByName(expanded)


def mapping_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Rows to add and rows to remove; rows in both are left alone.

    One grouped pass with partial counts; set semantics, so repeats do not matter.
    """
    both = stored.withColumn("side", F.lit(1)).unionByName(current.withColumn("side", F.lit(2)))
    keys = ["external_identity", "target_user", "target_group"]
    seen = both.groupBy(*keys).agg(F.min("side").alias("lo"), F.max("side").alias("hi")).where("lo = hi")
    return seen.select(*keys, F.when(F.col("lo") == 1, "remove").otherwise("add").alias("change"))


def stale_grants(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Stored rows that current membership no longer supports."""
    return mapping_diff(stored, current).where("change = 'remove'").drop("change")


def group_closure(nested: DataFrame) -> DataFrame:
    """(root, descendant) for groups nested in groups at any depth (an action per level).

    ``nested`` is (parent, child). Visited pairs are dropped each round, which ends
    cycles and the loop: there are only so many pairs. Lineage is cut in the shared folder each round.
    """
    nested = nested.distinct()
    reached = cut_lineage(nested.select(F.col("parent").alias("root"), F.col("child").alias("descendant")))
    frontier = reached
    while True:
        step = (
            frontier.join(nested, frontier["descendant"] == nested["parent"])
            .select("root", F.col("child").alias("descendant"))
            .distinct()
            .join(reached, ["root", "descendant"], "left_anti")
        )
        frontier = cut_lineage(step)
        if frontier.isEmpty():
            return reached
        reached = cut_lineage(reached.unionByName(frontier))


def flatten_groups(nested: DataFrame, members: DataFrame) -> DataFrame:
    """(group_name, user_name) with members of nested groups counted in their ancestors."""
    direct = members.select("group_name", "user_name")
    inherited = direct.join(group_closure(nested), F.col("group_name") == F.col("descendant"))
    return direct.unionByName(inherited.select(F.col("root").alias("group_name"), "user_name")).distinct()
