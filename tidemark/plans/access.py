"""Access lists over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import access as A
from tidemark.operators import access as O
from tidemark.plans import inputs as X
from tidemark.plans.registry import query


def _readers(principals):
    return F.array_join(A.principal_text(principals), ",")


@query(
    "acl_principals",
    X.sql_with("doc_principals", "SELECT doc_id, array_to_string(principals, ',') AS readers FROM doc_principals"),
)
def acl_principals(spark, sf):
    return X.doc_principals(spark, sf).select("doc_id", _readers(F.col("principals")).alias("readers"))


@query(
    "acl_external_users",
    X.sql_with(
        "readers",
        """SELECT doc_id, CASE WHEN is_public THEN 'idp_wide'
WHEN len(users) + len(groups) = 0 THEN 'user:external_user:__no_readers_sentinel__'
ELSE array_to_string(list_concat(list_transform(users, lambda u: 'user:external_user:' || u),
  list_transform(groups, lambda g: 'group:external_group:' || g)), ',') END AS readers FROM readers""",
    ),
)
def acl_external_users(spark, sf):
    principals = A.external_principals(F.col("users"), F.col("groups"), F.col("is_public"))
    return X.readers(spark, sf).select("doc_id", _readers(principals).alias("readers"))


_CSV = "list_filter(list_transform(string_split(can_read_user_criteria, ','), lambda x: trim(x)), lambda x: x <> '')"
_CSV_READERS = f"array_to_string(list_transform({_CSV}, lambda g: 'group:external_group:' || g), ',')"


@query("acl_from_csv", X.sql_with("kb", f"SELECT sys_id, {_CSV_READERS} AS readers FROM kb"))
def acl_from_csv(spark, sf):
    principals = A.csv_principals(F.col("can_read_user_criteria"))
    return X.kb(spark, sf).select("sys_id", _readers(principals).alias("readers"))


@query(
    "acl_policy_compare",
    X.sql_with(
        "kb",
        f"""SELECT sys_id, {_CSV_READERS} AS deny,
CASE WHEN len({_CSV}) = 0 THEN 'user:external_user:__no_readers_sentinel__' ELSE {_CSV_READERS} END AS sentinel,
CASE WHEN len({_CSV}) = 0 THEN 'idp_wide' ELSE {_CSV_READERS} END AS open FROM kb""",
    ),
)
def acl_policy_compare(spark, sf):
    csv = F.col("can_read_user_criteria")
    return X.kb(spark, sf).select(
        "sys_id", *[_readers(A.csv_principals(csv, policy)).alias(policy) for policy in ("deny", "sentinel", "open")]
    )


@query(
    "acl_all_employees",
    X.sql_with(
        "policies",
        """SELECT document_id, coalesce(is_public, false) OR list_contains(groups, 'ALL_EMPLOYEES') AS all_employees FROM policies""",
    ),
)
def acl_all_employees(spark, sf):
    flagged = F.coalesce("is_public", F.lit(False)) | F.array_contains("groups", "ALL_EMPLOYEES")
    return X.policies(spark, sf).select("document_id", flagged.alias("all_employees"))


_USED = """, used AS (SELECT principal, count(*) AS docs FROM
(SELECT doc_id, unnest(list_distinct(principals)) AS principal FROM doc_principals) GROUP BY principal)
"""


@query(
    "acl_resolve",
    X.sql_with("doc_principals mappings", "").rstrip()
    + _USED
    + """SELECT DISTINCT principal, CASE WHEN target_user IS NOT NULL THEN 'user' ELSE 'group' END AS subject_kind,
coalesce(target_user, target_group) AS subject, docs
FROM used JOIN mappings ON external_identity = regexp_replace(principal, '^(user|group):external_(user|group):', '')
WHERE regexp_matches(principal, '^(user|group):external_(user|group):')
UNION ALL
SELECT principal, split_part(principal, ':', 1), CASE WHEN principal = 'idp_wide' THEN '*' ELSE regexp_replace(principal, '^(user|group):', '') END, docs
FROM used WHERE NOT regexp_matches(principal, '^(user|group):external_(user|group):')""",
)
def acl_resolve(spark, sf):
    return O.resolve_principals(X.doc_principals(spark, sf), X.mappings(spark, sf))


VISIBLE = f""", visible AS (SELECT doc_id FROM doc_principals WHERE list_contains(principals, 'idp_wide')
OR list_has_any(principals, (SELECT list(principal) FROM held WHERE "user" = '{X.ASKER}')))
"""


def held_by_asker(spark, sf):
    return X.held(spark, sf).where(F.col("user") == X.ASKER).select("principal")


@query("visible_documents", X.sql_with("doc_principals held", "").rstrip() + VISIBLE + "SELECT doc_id FROM visible")
def visible_documents(spark, sf):
    documents = X.doc_principals(spark, sf)
    return O.visible_documents(documents, O.open_classes(documents, held_by_asker(spark, sf)))


@query(
    "hidden_documents",
    X.sql_with("doc_principals held", "").rstrip()
    + VISIBLE
    + "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM visible)",
)
def hidden_documents(spark, sf):
    documents = X.doc_principals(spark, sf)
    return O.hidden_documents(documents, O.open_classes(documents, held_by_asker(spark, sf)))


@query(
    "visible_document_counts",
    X.sql_with(
        "doc_principals held",
        """SELECT "user", CAST(count(DISTINCT doc_id) AS BIGINT) AS visible, CAST(sum(doc_id) AS BIGINT) AS checksum FROM (
SELECT DISTINCT "user", doc_id FROM held JOIN (SELECT doc_id, unnest(principals) AS principal FROM doc_principals) USING (principal)
UNION ALL
SELECT u."user", d.doc_id FROM (SELECT DISTINCT "user" FROM held) u, doc_principals d WHERE list_contains(d.principals, 'idp_wide'))
GROUP BY "user" """,
    ),
)
def visible_document_counts(spark, sf):
    return O.visible_counts(X.doc_principals(spark, sf), X.held(spark, sf), F.col("doc_id"))


@query(
    "unresolved_principals",
    X.sql_with("doc_principals mappings", "").rstrip()
    + _USED
    + """SELECT principal, regexp_replace(principal, '^(user|group):external_(user|group):', '') AS external_identity, docs FROM used
WHERE regexp_matches(principal, '^(user|group):external_(user|group):')
AND regexp_replace(principal, '^(user|group):external_(user|group):', '') NOT IN (SELECT external_identity FROM mappings)""",
)
def unresolved_principals(spark, sf):
    return O.unresolved_principals(X.doc_principals(spark, sf), X.mappings(spark, sf))


@query(
    "no_reader_documents",
    X.sql_with("doc_principals", "SELECT doc_id FROM doc_principals WHERE len(principals) = 0"),
)
def no_reader_documents(spark, sf):
    return O.documents_without_readers(X.doc_principals(spark, sf))
