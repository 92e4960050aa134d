"""Discovery and ad hoc reads over the given tables."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import catalog as C
from tidemark.plans import inputs as X
from tidemark.plans.registry import query
from tidemark.session import cut_lineage

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "table_inventory",
    "SELECT name, 'TABLE' AS type, row_count, row_count < 50000 AS ingest_rows, row_count > 100000 AS over_scale_gate FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS row_count FROM {t}" for t in TABLES)
    + ") ORDER BY name",
)
def table_inventory(spark, sf):
    return C.table_inventory({t: X.table(spark, sf, t) for t in TABLES})


#: Columns of the given tables, and what orders their rows. Fixed values.
COLUMNS = {
    "region": "r_regionkey:int r_name:string",
    "nation": "n_nationkey:int n_name:string n_regionkey:int",
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "supplier": "s_suppkey:bigint s_name:string s_nationkey:int s_acctbal:double",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority:string",
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double l_extendedprice:double l_discount:double l_tax:double "
    "l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz",
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double props:string",
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
    "embeddings": "vec_id:bigint embedding:array<float> label:int",
    "pages": "page_id:bigint url:string html:string",
    "benchmark": "item_id:bigint text:string",
    "labels": "doc_id:bigint quality:int toxic:int",
    "conversations": "conv_id:bigint turn:bigint role:string text:string",
}
ORDER = {"lineitem": "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice", "conversations": "conv_id turn role"}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in COLUMNS[table].split()]


def _order(table: str) -> list[str]:
    return ORDER.get(table, _columns(table)[0][0]).split()


def _shown(column: str, kind: str) -> str:
    return f"printf('%.6f', {column})" if kind == "double" else f"CAST(len({column}) AS VARCHAR)" if kind.startswith("array") else f"CAST({column} AS VARCHAR)"


def _profile_sql(table: str) -> str:
    order = ", ".join(_order(table))
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", {i} AS ordinal, '{c}' AS "column", '{t}' AS type, true AS nullable, CAST(NULL AS VARCHAR) AS comment,
count(*) AS rows, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count,
{"CAST(NULL AS VARCHAR)" if t.startswith("array") else _shown(f"min({c})", t)} AS min_value, {"CAST(NULL AS VARCHAR)" if t.startswith("array") else _shown(f"max({c})", t)} AS max_value,
(SELECT string_agg(substr({_shown(c, t)}, 1, 60), '|' ORDER BY {order}) FROM (SELECT * FROM {table} ORDER BY {order} LIMIT 5)) AS samples,
true AS distinct_within, true AS median_within FROM {table}"""
        for i, (c, t) in enumerate(_columns(table), 1)
    )


@query("column_profile", " UNION ALL ".join(map(_profile_sql, TABLES)))
def column_profile(spark, sf):
    """All columns of all tables. The sketches' figures are given as whether they are within their stated errors, three deviations of the distinct
    count and 1.5 % of the rank of the median, by exact counts."""
    tables = {t: X.table(spark, sf, t) for t in TABLES}
    profile = cut_lineage(C.column_profile(tables, {t: _order(t) for t in TABLES}))
    medians: dict[str, dict[str, float]] = {}
    for r in profile.where("median_estimate is not null").select("table", "column", "median_estimate").collect():
        medians.setdefault(r["table"], {})[r["column"]] = r["median_estimate"]
    ranks = reduce(DataFrame.unionByName, [C.median_ranks(tables[t], m).withColumn("table", F.lit(t)) for t, m in medians.items()])
    near = ranks.select("table", "column", ((F.col("below") <= 0.515 * F.col("n")) & (F.col("upto") >= 0.485 * F.col("n"))).alias("near"))
    error = 3 * 1.04 / 2 ** (C.HLL_BITS / 2)
    within = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.ceil(error * F.col("distinct_count"))
    profile = profile.join(near, ["table", "column"], "left").withColumns({"distinct_within": within, "median_within": F.coalesce("near", F.lit(True))})
    return profile.drop("near", "distinct_estimate", "median_estimate")


@query(
    "bounded_query",
    """SELECT o_orderkey, o_totalprice, 1000 AS row_count, true AS truncated, true AS cap_reached FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000""",
)
def bounded_query(spark, sf):
    """The dearest orders; asking for 5000 rows gives the hard cap of 1000."""
    orders = X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return C.bounded_query(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 5000).withColumn(
        "row_count", F.col("row_count").cast("int")
    )


@query(
    "batch_key_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r
FROM lineitem WHERE l_orderkey IN (SELECT user_id FROM events)) WHERE r = 1""",
)
def batch_key_lookup(spark, sf):
    """First line of every order whose key some event names; line keys are not unique."""
    lines = X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    keys = X.table(spark, sf, "events").select(F.col("user_id").alias("key"))
    found = C.lookup_by_key(lines, "l_orderkey", keys, ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "candidate_keys",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(DISTINCT {c}) AS distinct_values, count(*) = count(DISTINCT {c}) AS is_key FROM {t}"""
        for t in TABLES
        for c, _ in _columns(t)
    ),
)
def candidate_keys(spark, sf):
    return C.candidate_keys({t: X.table(spark, sf, t) for t in TABLES})


def _keys_sql() -> str:
    """Distinct counts of every set of up to three columns; of the sets that tell all rows apart, those without a smaller one inside."""
    tried = [(t, s) for t in TABLES for n in (1, 2, 3) for s in combinations([c for c, _ in _columns(t)], n)]
    sets = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", [{", ".join(f"'{c}'" for c in s)}] AS columns, (SELECT count(*) FROM (SELECT DISTINCT {", ".join(s)} FROM {t}
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in s)})) = (SELECT count(*) FROM {t}) AND (SELECT count(*) FROM {t}) > 0 AS is_key"""
        for t, s in tried
    )
    return f"""WITH sets AS ({sets}), keys AS (SELECT * FROM sets WHERE is_key)
SELECT "table", array_to_string(columns, ',') AS columns, CAST(len(columns) AS INTEGER) AS size FROM keys AS k
WHERE NOT EXISTS (SELECT 1 FROM keys AS s WHERE s."table" = k."table" AND len(s.columns) < len(k.columns) AND list_has_all(k.columns, s.columns))"""


@query("composite_keys", _keys_sql())
def composite_keys(spark, sf):
    return C.composite_keys({t: X.table(spark, sf, t) for t in TABLES})


def _order_facts(spark, sf):
    orders = X.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderdate",
    )
    return orders.join(X.star(spark, sf).customers, "customer_id")


@query(
    "revenue_by_region",
    X.sql_with(
        "star_customers",
        f"""SELECT region, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders JOIN star_customers ON customer_id = o_custkey
WHERE o_orderdate >= TIMESTAMP '{X.ANCHOR}' - INTERVAL 7 DAY AND o_orderdate < TIMESTAMP '{X.ANCHOR}' GROUP BY region""",
    ),
)
def revenue_by_region(spark, sf):
    """Last week's revenue by region; the date filter reaches the order scan."""
    anchor = F.to_timestamp_ntz(F.lit(f"{X.ANCHOR} 00:00:00"))
    week = _order_facts(spark, sf).where(
        (F.col("o_orderdate") >= anchor - F.expr("interval 7 days")) & (F.col("o_orderdate") < anchor)
    )
    return week.groupBy("region").agg(F.sum("price").cast("double").alias("revenue"), F.count("*").alias("orders"))


_RIGHTS = """, rights AS (SELECT 'u' || r_regionkey AS "user", r_name AS region FROM region
UNION ALL SELECT 'u0', r_name FROM region WHERE r_regionkey = 1)
"""


def _rights(spark, sf):
    region = X.table(spark, sf, "region")
    own = region.select(F.concat(F.lit("u"), "r_regionkey").alias("user"), F.col("r_name").alias("region"))
    return own.unionByName(region.where("r_regionkey = 1").select(F.lit("u0").alias("user"), F.col("r_name").alias("region")))


@query(
    "row_access_filter",
    X.sql_with("star_customers", "").rstrip()
    + _RIGHTS
    + """SELECT o_orderkey AS order_id, region FROM orders JOIN star_customers ON customer_id = o_custkey
WHERE region IN (SELECT region FROM rights WHERE "user" = 'u0')""",
)
def row_access_filter(spark, sf):
    return C.row_access_filter(_order_facts(spark, sf), _rights(spark, sf), "region", "u0").select("order_id", "region")


@query(
    "entitled_revenue",
    X.sql_with("star_customers", "").rstrip()
    + _RIGHTS
    + """SELECT "user", CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders JOIN star_customers ON customer_id = o_custkey JOIN rights USING (region) GROUP BY "user" """,
)
def entitled_revenue(spark, sf):
    """Revenue each user may see, all users at once."""
    return C.entitled_totals(
        _order_facts(spark, sf),
        _rights(spark, sf),
        "region",
        [F.sum("price").alias("revenue"), F.count("*").alias("orders")],
        [F.sum("revenue").cast("double").alias("revenue"), F.sum("orders").cast("bigint").alias("orders")],
    )


@query(
    "mask_columns",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE regexp_replace(c_name, '[0-9]', '#', 'g') END AS c_name,
c_mktsegment FROM customer""",
)
def mask_columns(spark, sf):
    entitled = F.col("c_nationkey") % 2 == 0
    return X.table(spark, sf, "customer").select(
        "c_custkey", C.mask_digits(F.col("c_name"), entitled).alias("c_name"), "c_mktsegment"
    )
