"""Source-shaped inputs derived from the given tables, in Spark and as SQL.

Each Spark function has a SQL twin of the same name in ``CTE``; both derive every
row of the table they read. ``sql_with`` puts the needed twins before a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import identity as I
from tidemark.operators.metrics import Star, calendar
from tidemark.sources.tables import union_sources

SUFFIXES = [".pdf", ".TXT", ".md", ".Html", ".htm", ".docx", ".PPTX", ".xlsx", ".json", ".csv", ".bin", ""]
FISCAL_START_MONTH = 4
ANCHOR = "2001-08-02"
MIRROR_CUT = "2024-01-25 00:00:00"
ASKER = "customer#000000022"
NO_NAMES = "array<string>"

CTE: dict[str, str] = {}
_NEEDS: dict[str, list[str]] = {}


def sql_with(names: str, body: str) -> str:
    """``WITH`` the named inputs, and what they need, before ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    listed = ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered)
    return f"WITH {listed}\n{body}"  # a body may start with a comma to add its own


def _cte(name: str, sql: str, needs: str = "") -> None:
    CTE[name] = sql
    _NEEDS[name] = needs.split()


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from a footer once per process, not once per use."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _hours_after(day: str, column: str):
    start = F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))
    hours = (F.col(column) % 8760).cast("int")
    return start + F.make_dt_interval(F.lit(0), hours, F.lit(0), F.lit(0))


# --- documents as files, knowledge articles, policies -----------------------------------------

_cte(
    "files",
    f"""SELECT doc_id, doc_id || sfx AS name, '/Volumes/main/docs/' || source || '/' || doc_id || sfx AS path,
       TIMESTAMP '2024-01-01' + to_hours(doc_id % 8760) AS updated_at
FROM (SELECT *, list_extract({SUFFIXES}, CAST(doc_id % 12 AS INT) + 1) AS sfx FROM documents)""",
)


def files(spark, sf, with_body: bool = False) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("doc_id") % 12).cast("int") + 1)
    name = F.concat(F.col("doc_id").cast("string"), suffix)
    return table(spark, sf, "documents").select(
        "doc_id",
        name.alias("name"),
        F.concat(F.lit("/Volumes/main/docs/"), "source", F.lit("/"), name).alias("path"),
        _hours_after("2024-01-01", "doc_id").alias("updated_at"),
        *([F.encode("text", "UTF-8").alias("body")] if with_body else []),
    )


_cte(
    "kb",
    """SELECT doc_id AS sys_id, 'KB' || doc_id AS number, source || ' ' || doc_id AS short_description,
       '<p>' || text || '</p>' AS text, lang AS kb_category, 'published' AS workflow_state,
       CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN 'n/a' ELSE CAST(n_chars AS VARCHAR) END AS view_count,
       strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id % 8760), '%Y-%m-%d %H:%M:%S') AS sys_updated_on,
       CASE WHEN lang = 'es' THEN '' ELSE lang || ', ,' || source END AS can_read_user_criteria
FROM documents""",
)


def kb(spark, sf) -> DataFrame:
    lang = F.col("lang")
    views = F.when(lang == "de", None).when(lang == "fr", "n/a").otherwise(F.col("n_chars").cast("string"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("sys_id"),
        F.concat(F.lit("KB"), "doc_id").alias("number"),
        F.concat("source", F.lit(" "), "doc_id").alias("short_description"),
        F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("text"),
        lang.alias("kb_category"),
        F.lit("published").alias("workflow_state"),
        views.alias("view_count"),
        F.date_format(_hours_after("2024-01-01", "doc_id"), "yyyy-MM-dd HH:mm:ss").alias("sys_updated_on"),
        F.when(lang == "es", "").otherwise(F.concat("lang", F.lit(", ,"), "source")).alias("can_read_user_criteria"),
    )


_cte(
    "policies",
    """SELECT CAST(doc_id AS VARCHAR) AS document_id,
       CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Policy ' || doc_id END AS title,
       CASE WHEN lang = 'en' THEN 'name ' || doc_id ELSE '' END AS name,
       CASE WHEN source = 'src1' THEN NULL ELSE source || ' policy' END AS description,
       CASE WHEN source = 'src2' THEN NULL ELSE source END AS business_unit,
       CASE WHEN lang = 'es' THEN NULL ELSE lang END AS language,
       CASE WHEN source = 'src4' THEN NULL ELSE TIMESTAMP '2023-01-01' + to_hours(doc_id % 8760) END AS effective_date,
       CASE WHEN source = 'src6' THEN NULL ELSE TIMESTAMP '2023-07-01' + to_hours(doc_id % 8760) END AS expiration_date,
       TIMESTAMP '2024-01-01' + to_hours(doc_id % 8760) AS updated_at,
       CASE WHEN lang = 'de' THEN ['ALL_EMPLOYEES', 'rbp_' || source] WHEN source = 'src5' THEN [] ELSE ['rbp_' || source] END AS groups,
       CASE WHEN source = 'src8' THEN NULL ELSE lang = 'fr' END AS is_public,
       CASE WHEN source = 'src7' THEN NULL ELSE 'text/plain' END AS mime_type, text AS body, doc_id
FROM documents""",
)


def policies(spark, sf) -> DataFrame:
    source, lang = F.col("source"), F.col("lang")
    remainder = F.col("doc_id") % 3
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.when(remainder == 0, None).when(remainder == 1, "").otherwise(F.concat(F.lit("Policy "), "doc_id")).alias("title"),
        F.when(lang == "en", F.concat(F.lit("name "), "doc_id")).otherwise("").alias("name"),
        F.when(source != "src1", F.concat("source", F.lit(" policy"))).alias("description"),
        F.when(source != "src2", source).alias("business_unit"),
        F.when(lang != "es", lang).alias("language"),
        F.when(source != "src4", _hours_after("2023-01-01", "doc_id")).alias("effective_date"),
        F.when(source != "src6", _hours_after("2023-07-01", "doc_id")).alias("expiration_date"),
        _hours_after("2024-01-01", "doc_id").alias("updated_at"),
        F.when(lang == "de", F.array(F.lit("ALL_EMPLOYEES"), F.concat(F.lit("rbp_"), "source")))
        .when(source == "src5", F.array().cast(NO_NAMES))
        .otherwise(F.array(F.concat(F.lit("rbp_"), "source")))
        .alias("groups"),
        F.when(source != "src8", lang == "fr").alias("is_public"),
        F.when(source != "src7", "text/plain").alias("mime_type"),
        F.col("text").alias("body"),
        "doc_id",
    )


# --- pages as articles ---------------------------------------------------------------------------

_cte(
    "articles",
    r"""SELECT *, CASE WHEN url LIKE '%blog.%' THEN [author] ELSE [] END AS reader_users,
       CASE WHEN lang <> 'en' OR url LIKE '%www.%' THEN [lang || '-readers'] ELSE [] END AS reader_groups,
       [lang] AS tags, url LIKE 'http://%' AS is_public
FROM (SELECT page_id AS id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS body_html, url,
             'editor@' || regexp_extract(url, '://([^/]+)/', 1) AS author,
             regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS lang,
             CASE WHEN url LIKE '%#%' THEN 'draft' WHEN url LIKE '%utm_source%' THEN 'deleted'
                  WHEN url LIKE '%ref=%' THEN NULL ELSE 'published' END AS status,
             TIMESTAMP '2024-01-01' + to_hours(page_id % 8760) AS updated_at
      FROM pages)""",
)


def articles(spark, sf) -> DataFrame:
    url = F.col("url")
    none = F.array().cast(NO_NAMES)
    status = (
        F.when(url.contains("#"), "draft")
        .when(url.contains("utm_source"), "deleted")
        .when(url.contains("ref="), None)
        .otherwise("published")
    )
    return (
        table(spark, sf, "pages")
        .select(
            F.col("page_id").alias("id"),
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
            F.col("html").alias("body_html"),
            "url",
            F.concat(F.lit("editor@"), F.regexp_extract("url", "://([^/]+)/", 1)).alias("author"),
            F.regexp_extract("url", "://[^/]+/([a-z]+)/", 1).alias("lang"),
            status.alias("status"),
            _hours_after("2024-01-01", "page_id").alias("updated_at"),
        )
        .withColumn("reader_users", F.when(url.contains("blog."), F.array("author")).otherwise(none))
        .withColumn(
            "reader_groups",
            F.when((F.col("lang") != "en") | url.contains("www."), F.array(F.concat("lang", F.lit("-readers")))).otherwise(none),
        )
        .withColumn("tags", F.array("lang"))
        .withColumn("is_public", url.startswith("http://"))
    )


# --- readers of documents ------------------------------------------------------------------------

_cte(
    "readers",
    """SELECT doc_id, CASE WHEN lang = 'fr' THEN ['customer#' || lpad(CAST(doc_id AS VARCHAR), 9, '0')] ELSE [] END AS users,
       CASE WHEN source = 'src11' THEN []
            ELSE list_concat(['NATION_' || (doc_id % 25)],
                 list_concat(CASE WHEN source = 'src7' THEN ['missing_group'] ELSE [] END,
                             CASE WHEN lang = 'de' THEN ['team@example.com'] ELSE [] END)) END AS groups,
       source = 'src3' AS is_public
FROM documents""",
)

_cte(
    "doc_principals",
    """SELECT doc_id, CASE WHEN is_public THEN ['idp_wide']
       ELSE list_concat(list_transform(users, lambda u: 'user:' || u),
            list_transform(groups, lambda g: CASE WHEN contains(g, '@') THEN 'group:' || g ELSE 'group:external_group:' || g END))
       END AS principals
FROM readers""",
    "readers",
)


def readers(spark, sf) -> DataFrame:
    none = F.array().cast(NO_NAMES)
    source, lang = F.col("source"), F.col("lang")
    login = F.concat(F.lit("customer#"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    groups = F.concat(
        F.array(F.concat(F.lit("NATION_"), F.col("doc_id") % 25)),
        F.when(source == "src7", F.array(F.lit("missing_group"))).otherwise(none),
        F.when(lang == "de", F.array(F.lit("team@example.com"))).otherwise(none),
    )
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(lang == "fr", F.array(login)).otherwise(none).alias("users"),
        F.when(source == "src11", none).otherwise(groups).alias("groups"),
        (source == "src3").alias("is_public"),
    )


def doc_principals(spark, sf) -> DataFrame:
    from tidemark.functions.access import reader_principals

    return readers(spark, sf).select(
        "doc_id", reader_principals(F.col("users"), F.col("groups"), F.col("is_public")).alias("principals")
    )


# --- identities ----------------------------------------------------------------------------------

_cte(
    "people",
    """SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_name) AS user_name,
       CASE WHEN c_custkey % 10 = 0 THEN 'u' || c_custkey || '@example.com' WHEN c_mktsegment = 'FURNITURE' THEN '' END AS email,
       c_nationkey, c_mktsegment, c_custkey
FROM customer""",
)
_cte(
    "directory",
    """SELECT n_name AS group_name, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) || '@example.com' END AS target_group,
       n_nationkey % 2 = 1 AS expand_members
FROM nation""",
)
_cte(
    "members",
    """SELECT n_name AS group_name, 'Users/' || c_custkey AS ref,
       CASE c_mktsegment WHEN 'BUILDING' THEN lower(c_name) || '@example.com' WHEN 'AUTOMOBILE' THEN c_name END AS display,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'gone-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS value
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT r_name, 'Groups/' || n_name, n_name, CAST(n_nationkey AS VARCHAR) FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
_cte(
    "old_members",
    """SELECT n_name AS group_name, 'Users/' || c_custkey AS ref,
       CASE c_mktsegment WHEN 'BUILDING' THEN lower(c_name) || '@example.com' WHEN 'AUTOMOBILE' THEN c_name END AS display,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'gone-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS value
FROM customer JOIN nation ON CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN (c_nationkey + 1) % 25 ELSE c_nationkey END = n_nationkey
WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
_RESOLVE = """SELECT m.group_name, CASE WHEN contains(m.display, '@') THEN m.display ELSE p.user_name END AS user_name
FROM {members} m LEFT JOIN people p ON m.value = p.user_id AND coalesce(contains(m.display, '@'), false) = false
WHERE NOT contains(lower(m.ref), 'groups/') AND (coalesce(contains(m.display, '@'), false) OR p.user_name IS NOT NULL)"""
_cte("resolved", _RESOLVE.format(members="members"), "people members")
_cte("old_resolved", _RESOLVE.format(members="old_members"), "people old_members")
_cte(
    "global_overrides",
    "SELECT lower(c_name) AS user_name, 'g' || c_custkey || '@example.com' AS email FROM customer WHERE c_mktsegment = 'FURNITURE'",
)
_cte(
    "group_overrides",
    """SELECT n_name AS group_name, lower(c_name) AS user_name, 'go' || c_custkey || '@example.com' AS email
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000""",
)
_EMAILS = """SELECT r.group_name, r.user_name, coalesce(go.email, g.email, r.user_name) AS email
FROM {resolved} r LEFT JOIN group_overrides go ON go.group_name = r.group_name AND go.user_name = r.user_name
LEFT JOIN global_overrides g ON g.user_name = r.user_name"""
_cte("emails", _EMAILS.format(resolved="resolved"), "resolved global_overrides group_overrides")
_cte("old_emails", _EMAILS.format(resolved="old_resolved"), "old_resolved global_overrides group_overrides")
_EXPANDED = """SELECT e.group_name AS external_identity, e.email AS target_user, CAST(NULL AS VARCHAR) AS target_group
FROM {emails} e JOIN directory d ON d.group_name = e.group_name AND d.expand_members"""
_cte("expanded", _EXPANDED.format(emails="emails"), "emails directory")
_cte("old_expanded", _EXPANDED.format(emails="old_emails"), "old_emails directory")
_cte(
    "user_map",
    """SELECT user_name AS external_identity, coalesce(nullif(email, ''), user_name) AS target_user, CAST(NULL AS VARCHAR) AS target_group
FROM people""",
    "people",
)
_cte(
    "group_map",
    """SELECT group_name AS external_identity, CAST(NULL AS VARCHAR) AS target_user, target_group
FROM directory WHERE target_group IS NOT NULL""",
    "directory",
)
_cte(
    "mappings",
    "SELECT * FROM user_map UNION ALL SELECT * FROM group_map UNION ALL SELECT * FROM expanded",
    "user_map group_map expanded",
)
_cte(
    "group_members",
    """SELECT d.target_group, coalesce(nullif(p.email, ''), p.user_name) AS "user"
FROM people p JOIN nation n ON p.c_nationkey = n.n_nationkey JOIN directory d ON d.group_name = n.n_name
WHERE d.target_group IS NOT NULL""",
    "people directory",
)
_cte(
    "held",
    """SELECT DISTINCT "user", principal FROM (
SELECT target_user AS "user", unnest(['user:external_user:' || external_identity, 'group:external_group:' || external_identity, 'entity:external_group:' || external_identity]) AS principal
FROM mappings WHERE target_user IS NOT NULL
UNION ALL
SELECT g."user", unnest(['user:external_user:' || m.external_identity, 'group:external_group:' || m.external_identity, 'entity:external_group:' || m.external_identity])
FROM mappings m JOIN group_members g ON g.target_group = m.target_group
UNION ALL SELECT target_user, 'user:' || target_user FROM mappings WHERE target_user IS NOT NULL
UNION ALL SELECT "user", 'group:' || target_group FROM group_members)""",
    "mappings group_members",
)
_cte(
    "roster",
    """SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'SAP' || c_custkey END AS external_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE lower(c_name) || '@example.com' END AS email,
       ['rbp_' || c_nationkey, 'rbp_' || c_nationkey, 'seg_' || c_mktsegment] AS groups, c_acctbal > 0 AS active
FROM customer""",
)


def people(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    email = F.when(key % 10 == 0, F.concat(F.lit("u"), "c_custkey", F.lit("@example.com"))).when(
        F.col("c_mktsegment") == "FURNITURE", ""
    )
    return table(spark, sf, "customer").select(
        key.cast("string").alias("user_id"),
        F.lower("c_name").alias("user_name"),
        email.alias("email"),
        "c_nationkey",
        "c_mktsegment",
        "c_custkey",
    )


def directory(spark, sf) -> DataFrame:
    odd = F.col("n_nationkey") % 2 == 1
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("group_name"),
        F.when(~odd, F.concat(F.lower("n_name"), F.lit("@example.com"))).alias("target_group"),
        odd.alias("expand_members"),
    )


def _user_members(spark, sf, nation_key) -> DataFrame:
    segment = F.col("c_mktsegment")
    people_in = table(spark, sf, "customer").withColumn("nk", nation_key)
    return people_in.join(table(spark, sf, "nation"), F.col("nk") == F.col("n_nationkey")).select(
        F.col("n_name").alias("group_name"),
        F.concat(F.lit("Users/"), "c_custkey").alias("ref"),
        F.when(segment == "BUILDING", F.concat(F.lower("c_name"), F.lit("@example.com")))
        .when(segment == "AUTOMOBILE", F.col("c_name"))
        .alias("display"),
        F.when(segment == "MACHINERY", F.concat(F.lit("gone-"), "c_custkey"))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("value"),
    )


def members(spark, sf) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    nested = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("group_name"),
        F.concat(F.lit("Groups/"), "n_name").alias("ref"),
        F.col("n_name").alias("display"),
        F.col("n_nationkey").cast("string").alias("value"),
    )
    return _user_members(spark, sf, F.col("c_nationkey")).unionByName(nested)


def old_members(spark, sf) -> DataFrame:
    """Membership as once stored: one segment had not joined yet, another sat in the next group."""
    moved = F.when(F.col("c_mktsegment") == "AUTOMOBILE", (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    joined = table(spark, sf, "customer").where("c_mktsegment <> 'HOUSEHOLD'")
    segment = F.col("c_mktsegment")
    return joined.withColumn("nk", moved).join(table(spark, sf, "nation"), F.col("nk") == F.col("n_nationkey")).select(
        F.col("n_name").alias("group_name"),
        F.concat(F.lit("Users/"), "c_custkey").alias("ref"),
        F.when(segment == "BUILDING", F.concat(F.lower("c_name"), F.lit("@example.com")))
        .when(segment == "AUTOMOBILE", F.col("c_name"))
        .alias("display"),
        F.when(segment == "MACHINERY", F.concat(F.lit("gone-"), "c_custkey"))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("value"),
    )


def resolved(spark, sf) -> DataFrame:
    return I.resolve_members(members(spark, sf), people(spark, sf))


def global_overrides(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").where("c_mktsegment = 'FURNITURE'").select(
        F.lower("c_name").alias("user_name"), F.concat(F.lit("g"), "c_custkey", F.lit("@example.com")).alias("email")
    )


def group_overrides(spark, sf) -> DataFrame:
    named = table(spark, sf, "customer").where("c_acctbal > 5000")
    return named.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("group_name"),
        F.lower("c_name").alias("user_name"),
        F.concat(F.lit("go"), "c_custkey", F.lit("@example.com")).alias("email"),
    )


def emails(spark, sf) -> DataFrame:
    return I.override_email(resolved(spark, sf), group_overrides(spark, sf), global_overrides(spark, sf))


def expanded(spark, sf) -> DataFrame:
    return I.expand_groups(directory(spark, sf), emails(spark, sf))


def old_expanded(spark, sf) -> DataFrame:
    was = I.resolve_members(old_members(spark, sf), people(spark, sf))
    return I.expand_groups(
        directory(spark, sf), I.override_email(was, group_overrides(spark, sf), global_overrides(spark, sf))
    )


def mappings(spark, sf) -> DataFrame:
    return union_sources(
        I.user_mappings(people(spark, sf)), I.group_mappings(directory(spark, sf)), expanded(spark, sf)
    )


def group_members(spark, sf) -> DataFrame:
    address = F.coalesce(F.nullif("email", F.lit("")), "user_name").alias("user")
    nation = table(spark, sf, "nation")
    targets = directory(spark, sf).where("target_group is not null")
    return (
        people(spark, sf)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(targets, F.col("group_name") == F.col("n_name"))
        .select("target_group", address)
    )


def held(spark, sf) -> DataFrame:
    from tidemark.operators.access import user_principals

    return user_principals(mappings(spark, sf), group_members(spark, sf))


def roster(spark, sf) -> DataFrame:
    segment = F.col("c_mktsegment")
    by_nation = F.concat(F.lit("rbp_"), "c_nationkey")
    return table(spark, sf, "customer").select(
        F.when(segment != "MACHINERY", F.concat(F.lit("SAP"), "c_custkey")).alias("external_id"),
        F.when(segment == "BUILDING", "").otherwise(F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.array(by_nation, by_nation, F.concat(F.lit("seg_"), "c_mktsegment")).alias("groups"),
        (F.col("c_acctbal") > 0).alias("active"),
    )


# --- events as change capture --------------------------------------------------------------------

_cte(
    "ev",
    """SELECT user_id AS id, ts, event_id,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
       CAST(floor(value / 10) AS BIGINT) % 3 AS content_hash, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS acl_hash,
       value, props, event_type
FROM events""",
)
_LATEST = """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS r FROM ev {where})
WHERE r = 1 AND op <> 'delete'"""
_cte("act", _LATEST.format(where=""), "ev")
_cte("mir", _LATEST.format(where=f"WHERE ts < TIMESTAMP '{MIRROR_CUT}'"), "ev")
_cte(
    "diff",
    """SELECT coalesce(a.id, m.id) AS id, CASE WHEN m.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete'
       WHEN a.content_hash <> m.content_hash THEN 'update' WHEN a.acl_hash <> m.acl_hash THEN 'acl' ELSE 'same' END AS change
FROM act a FULL JOIN mir m ON a.id = m.id""",
    "act mir",
)


def ev(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        "ts",
        "event_id",
        F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update").alias("op"),
        (F.floor(F.col("value") / 10).cast("bigint") % 3).alias("content_hash"),
        (F.from_json("props", "k bigint")["k"] % 3).alias("acl_hash"),
        "value",
        "props",
        "event_type",
    )


def before_cut(events: DataFrame) -> DataFrame:
    return events.where(F.col("ts") < F.to_timestamp_ntz(F.lit(MIRROR_CUT)))


def act(spark, sf, carry=("content_hash", "acl_hash")) -> DataFrame:
    from tidemark.operators.changes import active_state

    return active_state(ev(spark, sf), "id", ["ts", "event_id"], list(carry))


def mir(spark, sf, carry=("content_hash", "acl_hash")) -> DataFrame:
    from tidemark.operators.changes import active_state

    return active_state(before_cut(ev(spark, sf)), "id", ["ts", "event_id"], list(carry))


def diff(spark, sf) -> DataFrame:
    from tidemark.operators.changes import state_mirror_diff

    return state_mirror_diff(act(spark, sf), mir(spark, sf))


# --- star ----------------------------------------------------------------------------------------

_cte(
    "lines",
    """SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
       CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
       CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem""",
)
_cte("star_orders", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date FROM orders")
_cte(
    "star_customers",
    """SELECT c_custkey AS customer_id, c_mktsegment AS segment, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
_cte("products", "SELECT p_partkey AS product_id, p_type AS category, p_brand AS sku FROM part")
_cte(
    "dates",
    f"""SELECT d AS date_key,
       'FY' || year(d + INTERVAL {(13 - FISCAL_START_MONTH) % 12} MONTH) || '-Q' || quarter(d + INTERVAL {(13 - FISCAL_START_MONTH) % 12} MONTH) AS fiscal_quarter,
       CAST(year(d + INTERVAL {(13 - FISCAL_START_MONTH) % 12} MONTH) AS BIGINT) AS fiscal_year, strftime(d, '%Y-%m') AS calendar_month
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))""",
)
_cte(
    "star",
    """SELECT l.*, customer_id, order_date, segment, region, category, sku, fiscal_quarter, fiscal_year, calendar_month
FROM lines l JOIN star_orders USING (order_id) JOIN star_customers USING (customer_id)
JOIN products USING (product_id) JOIN dates ON order_date = date_key""",
    "lines star_orders star_customers products dates",
)


def star(spark, sf) -> Star:
    # Amounts in 1/10000 of the currency: price and discount both have two decimals.
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.round(F.col("l_discount") * 100).cast("bigint")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        (cents * 100).alias("gross_amount"),
        (cents * percent).alias("discount_amount"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    raw_orders = table(spark, sf, "orders")
    orders = raw_orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    customers = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("region"))
    )
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("sku")
    )
    dates = calendar(
        F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date"), raw_orders, FISCAL_START_MONTH
    )
    return Star(lines, orders, customers, products, dates, minor_digits=4)
