"""Access list expressions. A principal is STRUCT<kind, id>, kind being user, group, entity or idp_wide."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import EXTERNAL_GROUP, EXTERNAL_USER, NO_READERS

PRINCIPALS = "array<struct<kind:string,id:string>>"


def principal(kind: str, identity: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), identity.cast("string").alias("id"))


def _none() -> Column:
    return F.array().cast(PRINCIPALS)


def everyone() -> Column:
    return F.array(principal("idp_wide", F.lit(None))).cast(PRINCIPALS)


def _listed(kind: str, names: Column, prefix: str = "", bare_if_mail: bool = False) -> Column:
    def one(name: Column) -> Column:
        full = F.concat(F.lit(prefix), name)
        return principal(kind, F.when(name.contains("@"), name).otherwise(full) if bare_if_mail else full)

    return F.coalesce(F.transform(names, one).cast(PRINCIPALS), _none())


def reader_principals(users: Column, groups: Column, public: Column) -> Column:
    """Public is everyone alone; otherwise users as given, then groups, prefixed unless an address."""
    listed = F.concat(_listed("user", users), _listed("group", groups, EXTERNAL_GROUP, bare_if_mail=True))
    return F.when(F.coalesce(public, F.lit(False)), everyone()).otherwise(listed)


def external_principals(users: Column, groups: Column, public: Column, empty_policy: str = "sentinel") -> Column:
    """The variant that prefixes every user and group and, by default, marks unreadable rows."""
    listed = F.concat(_listed("user", users, EXTERNAL_USER), _listed("group", groups, EXTERNAL_GROUP))
    return apply_empty_policy(
        F.when(F.coalesce(public, F.lit(False)), everyone()).otherwise(listed), empty_policy
    )


def split_list(csv: Column) -> Column:
    """Comma list to array; blanks dropped."""
    trimmed = F.transform(F.split(F.coalesce(csv, F.lit("")), ","), lambda part: F.trim(part))
    return F.filter(trimmed, lambda x: x != "")


def csv_principals(csv: Column, empty_policy: str = "deny", kind: str = "group") -> Column:
    """External groups out of a comma list; ``kind`` is group, or entity where the target wants that."""
    return apply_empty_policy(_listed(kind, split_list(csv), EXTERNAL_GROUP), empty_policy)


def apply_empty_policy(principals: Column, policy: str) -> Column:
    """What an empty list means: ``deny`` (nobody), ``sentinel`` (nobody, marked) or ``open``."""
    instead = {
        "deny": _none,
        "sentinel": lambda: F.array(principal("user", F.lit(NO_READERS))).cast(PRINCIPALS),
        "open": everyone,
    }[policy]()
    return F.when(F.size(principals) == 0, instead).otherwise(principals)


def principal_text(principals: Column) -> Column:
    """``kind:id`` per principal, in list order."""
    return F.transform(principals, lambda p: F.concat_ws(":", p["kind"], p["id"]))


def access_key(principals: Column) -> Column:
    """A hash of who may read, the same for any order and any repeats."""
    return F.sha2(F.concat_ws("\x01", F.array_sort(F.array_distinct(principal_text(principals)))), 256)


def bare_identity(identity: Column) -> Column:
    """A referenced identity as stored in the mapping: without its prefix."""
    return F.regexp_replace(identity, f"^(?:{EXTERNAL_USER}|{EXTERNAL_GROUP})", "")
