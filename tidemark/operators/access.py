"""Who can read what.

Documents are grouped into *access classes* (documents with the same reader
list) before anything fans out. A reader list on a third of all documents is one
class row, and identities are resolved on the identity side once, so no join
ever multiplies documents by group members.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import access as A
from tidemark.session import cut_lineage


def access_classes(documents: DataFrame) -> DataFrame:
    """One row per distinct reader list, with its number of documents."""
    listed = F.array_sort(F.array_distinct(A.principal_text(F.col("principals"))))
    keyed = documents.withColumn("readers", listed)
    return keyed.groupBy("readers").agg(F.count("*").alias("docs"))


def principal_counts(documents: DataFrame) -> DataFrame:
    """Distinct principals in use with the number of documents naming each."""
    classes = access_classes(documents)
    return (
        classes.select(F.explode("readers").alias("principal"), "docs")
        .groupBy("principal")
        .agg(F.sum("docs").cast("bigint").alias("docs"))
    )


def _identity(principal: Column) -> Column:
    return A.bare_identity(F.regexp_replace(principal, "^(?:user|group|entity):", ""))


def _is_external(principal: Column) -> Column:
    return F.regexp_like(principal, F.lit("^(?:user|group|entity):external_(?:user|group):"))


def resolve_principals(documents: DataFrame, mappings: DataFrame) -> DataFrame:
    """Each principal in use with the subjects it stands for.

    External ones are joined to the mapping on their bare name; others stand for
    themselves. ``docs`` says how many documents each grant reaches.
    """
    used = principal_counts(documents)
    external = used.where(_is_external(F.col("principal"))).withColumn(
        "external_identity", _identity(F.col("principal"))
    )
    subject_kind = F.when(F.col("target_user").isNotNull(), "user").otherwise("group")
    mapped = external.join(mappings, "external_identity").select(
        "principal", subject_kind.alias("subject_kind"), F.coalesce("target_user", "target_group").alias("subject"), "docs"
    )
    own = used.where(~_is_external(F.col("principal"))).select(
        "principal",
        F.substring_index("principal", ":", 1).alias("subject_kind"),
        F.when(F.col("principal") == "idp_wide", "*")
        .otherwise(F.regexp_replace("principal", "^(?:user|group|entity):", ""))
        .alias("subject"),
        "docs",
    )
    return mapped.distinct().unionByName(own)


def unresolved_principals(documents: DataFrame, mappings: DataFrame) -> DataFrame:
    """External principals that no mapping row resolves; their documents stay unread."""
    used = principal_counts(documents).where(_is_external(F.col("principal")))
    known = mappings.select("external_identity")
    return (
        used.withColumn("external_identity", _identity(F.col("principal")))
        .join(known, "external_identity", "left_anti")
        .select("principal", "external_identity", "docs")
    )


def user_principals(mappings: DataFrame, memberships: DataFrame) -> DataFrame:
    """(user, principal, shared): every principal text that lets a user read.

    A mapped user holds the external names mapped to their address; a member of a
    target group holds the external names mapped to that group and the group itself.
    ``memberships`` is (target_group, user). ``shared`` marks group principals.
    """

    def texts(kind: Column, name: str) -> Column:
        return F.concat(kind, F.col(name))

    direct = mappings.where("target_user is not null")
    via_user = direct.select(F.col("target_user").alias("user"), "external_identity")
    via_group = mappings.where("target_group is not null").join(memberships, "target_group").select(
        "user", "external_identity"
    )
    named = via_user.unionByName(via_group).select(
        "user",
        F.explode(
            F.array(
                texts(F.lit("user:external_user:"), "external_identity"),
                texts(F.lit("group:external_group:"), "external_identity"),
                texts(F.lit("entity:external_group:"), "external_identity"),
            )
        ).alias("principal"),
    )
    own = direct.select(F.col("target_user").alias("user"), texts(F.lit("user:"), "target_user").alias("principal"))
    in_group = memberships.select("user", texts(F.lit("group:"), "target_group").alias("principal"))
    everything = named.unionByName(own).unionByName(in_group).distinct()
    return everything.withColumn("shared", ~F.col("principal").startswith("user:"))


def open_classes(documents: DataFrame, held: DataFrame) -> DataFrame:
    """Access keys of the reader lists one asker can pass (an action); ``held`` is that
    asker's principals (column ``principal``).

    Reader lists are reduced to distinct ones per task before the shuffle. The result
    is written, so its real size decides the join with documents: a broadcast next to
    a scan that is not shuffled, whatever share of documents one list has.
    """
    keyed = documents.select(A.access_key(F.col("principals")).alias("access_key"), "principals")
    classes = keyed.groupBy("access_key").agg(F.first("principals").alias("principals"))
    texts = classes.select("access_key", F.explode(A.principal_text(F.col("principals"))).alias("principal"))
    passes = held.select("principal").unionByName(held.sparkSession.range(1).select(F.lit("idp_wide").alias("principal")))
    return cut_lineage(texts.join(passes, "principal", "left_semi").select("access_key").distinct())


def visible_documents(documents: DataFrame, opened: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Ids of the documents in opened classes; one hash is compared per document."""
    keyed = documents.select(id_column, A.access_key(F.col("principals")).alias("access_key"))
    return keyed.join(opened, "access_key", "left_semi").select(id_column)


def hidden_documents(documents: DataFrame, opened: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The complement of ``visible_documents``."""
    keyed = documents.select(id_column, A.access_key(F.col("principals")).alias("access_key"))
    return keyed.join(opened, "access_key", "left_anti").select(id_column)


def principal_bitmaps(documents: DataFrame, number: Column) -> DataFrame:
    """(principal, bucket, docs): the documents that name a principal, as one bitmap of 32,768 numbers per bucket.

    ``number`` is a whole number, 0 or more, of its own for every document (``dense_index`` gives one where ids are not numbers). Bits are set in the
    task before the shuffle, so a principal on a third of all documents is one bitmap per task and bucket.
    """
    named = documents.select(number.cast("bigint").alias("n"), F.explode(A.principal_text(F.col("principals"))).alias("principal"))
    placed = named.select("principal", F.bitmap_bucket_number("n").alias("bucket"), F.bitmap_bit_position("n").alias("bit"))
    return placed.groupBy("principal", "bucket").agg(F.bitmap_construct_agg("bit").alias("docs"))


def user_profiles(users: DataFrame, user_principals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((user, profile), (profile, principal)): users with the same shared principals have one profile. ``users`` (distinct) need not hold any.

    A profile's name is made of sums over hashes of its principals, so no list of them is gathered; its principals are those of one of its users.
    """
    everyone = users.withColumns({"principal": F.lit("idp_wide"), "shared": F.lit(True)})
    rows = user_principals.unionByName(everyone).where("shared").select("user", "principal").distinct()
    parts = [F.count("*"), F.bit_xor(F.xxhash64("principal")), F.bit_xor(F.xxhash64(F.lit("again"), "principal"))]
    users = rows.groupBy("user").agg(F.concat_ws(":", *[p.cast("string") for p in parts]).alias("profile"))
    first = users.groupBy("profile").agg(F.min("user").alias("user"))
    return users, rows.join(first, "user").select("profile", "principal")


def visible_bitmaps(index: DataFrame, user_principals: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((user, profile), (profile, bucket, docs), (user, profile, bucket, docs)) from ``principal_bitmaps`` and ``user_principals``.

    A profile reads the union of its principals' bitmaps. The third table has only what personal principals name, before the union with the
    user's profile. No row stands for a profile or a user together with a document or a reader list. Principals that no document names
    make no profiles: each user has some of their own, which would give every user a profile and each of them all public documents.
    """
    named = index.select("principal").distinct()
    users = user_principals.select("user").distinct()
    user_principals = cut_lineage(user_principals.join(named, "principal", "left_semi"))
    users, shared = user_profiles(users, user_principals)
    users = cut_lineage(users)
    union = F.bitmap_or_agg("docs").alias("docs")
    of_profiles = shared.join(index, "principal").groupBy("profile", "bucket").agg(union)
    personal = user_principals.where(~F.col("shared")).select("user", "principal")
    own = personal.join(index, "principal").groupBy("user", "bucket").agg(union).join(users, "user")
    return users, cut_lineage(of_profiles), cut_lineage(own.select("user", "profile", "bucket", "docs"))


#: Per value of a byte: the sum of the places of its bits, and how many there are.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES, _ONES = _BITS @ np.arange(8), _BITS.sum(axis=1)


def _sum_of_places(bitmaps: pd.Series) -> pd.Series:
    """The sum of the places of the bits that are set."""

    def places(bitmap) -> int:
        held = np.frombuffer(bitmap, dtype=np.uint8)
        at = held.nonzero()[0]
        return int((8 * at * _ONES[held[at]] + _PLACES[held[at]]).sum())

    return bitmaps.map(places)


def sum_of_numbers(bucket: Column, docs: Column) -> Column:
    """The sum of the numbers in one bitmap; bucket 0 holds the number 0 alone."""
    first = (bucket - 1) * 32768 + 1
    return F.when(bucket > 0, first * F.bitmap_count(docs) + F.pandas_udf(_sum_of_places, "bigint")(docs)).otherwise(F.lit(0)).cast("bigint")


def visible_counts(documents: DataFrame, user_principals: DataFrame, number: Column) -> DataFrame:
    """Documents each user may read, for all users at once, as a count and the sum of their numbers (an action: the index and the unions are written).

    Counted per profile; where a user has documents of their own, the union with the profile is counted for those buckets alone.
    """
    users, of_profiles, own = visible_bitmaps(cut_lineage(principal_bitmaps(documents, number)), user_principals)
    told = of_profiles.select("profile", "bucket", "docs", F.bitmap_count("docs").alias("n"), sum_of_numbers(F.col("bucket"), F.col("docs")).alias("sum"))
    shared = told.groupBy("profile").agg(F.sum("n").alias("shared"), F.sum("sum").alias("shared_sum"))
    beside = own.select("user", "profile", "bucket").join(told, ["profile", "bucket"])
    zeros = F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("sum")
    both = own.select("user", "bucket", "docs", *zeros).unionByName(beside.select("user", "bucket", "docs", "n", "sum"))
    both = both.groupBy("user", "bucket").agg(F.bitmap_or_agg("docs").alias("docs"), F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    more = both.select("user", (F.bitmap_count("docs") - F.col("n")).alias("n"), (sum_of_numbers(F.col("bucket"), F.col("docs")) - F.col("sum")).alias("sum"))
    more = more.groupBy("user").agg(F.sum("n").alias("more"), F.sum("sum").alias("more_sum"))

    def total(of_profile: str, of_user: str) -> Column:
        return (F.coalesce(of_profile, F.lit(0)) + F.coalesce(of_user, F.lit(0))).cast("bigint")

    counted = users.join(shared, "profile", "left").join(more, "user", "left")
    return counted.select("user", total("shared", "more").alias("visible"), total("shared_sum", "more_sum").alias("checksum"))


def documents_without_readers(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return documents.where(F.size("principals") == 0).select(id_column)
