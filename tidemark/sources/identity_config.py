"""Identity configuration files: which groups map one to one, which are expanded, and overrides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import identity as I
from tidemark.sources.tables import union_sources

_SCHEMA = (
    f"groups array<struct<{K.CONFIG_GROUP}:string,{K.CONFIG_TARGET_GROUP}:string,expand_members:boolean,user_overrides:map<string,string>>>, "
    f"users array<struct<{K.CONFIG_USER}:string,{K.CONFIG_TARGET_EMAIL}:string>>, user_overrides map<string,string>"
)


@dataclass(frozen=True)
class IdentityConfig:
    """groups(group_name, target_group, expand_members), users(user_name, email),
    group_overrides(group_name, user_name, email), global_overrides(user_name, email)."""

    groups: DataFrame
    users: DataFrame
    group_overrides: DataFrame
    global_overrides: DataFrame


def read_identity_config(spark: SparkSession, path: str) -> IdentityConfig:
    config = spark.read.schema(_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    groups = config.select(F.explode("groups").alias("g")).select(
        F.col(f"g.{K.CONFIG_GROUP}").alias("group_name"),
        F.col(f"g.{K.CONFIG_TARGET_GROUP}").alias("target_group"),
        F.coalesce("g.expand_members", F.lit(False)).alias("expand_members"),
        F.col("g.user_overrides").alias("overrides"),
    )
    users = config.select(F.explode("users").alias("u")).select(
        F.col(f"u.{K.CONFIG_USER}").alias("user_name"), F.col(f"u.{K.CONFIG_TARGET_EMAIL}").alias("email")
    )
    return IdentityConfig(
        groups.drop("overrides"),
        users,
        groups.select("group_name", F.explode("overrides").alias("user_name", "email")),
        config.select(F.explode("user_overrides").alias("user_name", "email")),
    )


def plan_mappings(config: IdentityConfig, members: DataFrame, users: DataFrame, directory: DataFrame) -> DataFrame:
    """All mapping rows of a configuration (an action: broken settings and unknown
    groups are errors, found before anything is replaced)."""
    broken = I.config_violations(config.groups).select("group_name")
    unknown = I.unknown_groups(config.groups, directory)
    for names, what in ((broken, "set exactly one of a target group or expand_members"), (unknown, "unknown group")):
        first = names.orderBy("group_name").take(5)
        if first:
            raise ValueError(f"{what}: {[r[0] for r in first]}")
    resolved = I.resolve_members(members, users)
    emails = I.override_email(resolved, config.group_overrides, config.global_overrides)
    return union_sources(
        I.user_mappings(config.users), I.group_mappings(config.groups), I.expand_groups(config.groups, emails)
    )
