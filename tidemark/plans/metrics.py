"""The metric layer over orders, lines, customers, parts and days."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.plans import inputs as X
from tidemark.plans.registry import query
from tidemark.session import cut_lineage

NET = "CAST(sum(gross_amount - discount_amount) AS DOUBLE) AS net_revenue"
ORDERS = "count(DISTINCT order_id) AS total_orders"
UNITS = "CAST(sum(quantity) AS BIGINT) AS units_sold"
AOV = "CAST(sum(gross_amount) AS DOUBLE) / CAST(count(DISTINCT order_id) AS DOUBLE) AS avg_order_value"


def _q(name, ctes, body):
    return query(name, X.sql_with(ctes, body))


@_q(
    "star_join",
    "star",
    """SELECT order_id, product_id, customer_id, CAST(gross_amount AS DOUBLE) AS gross, quantity, segment, region, category, sku,
fiscal_quarter, calendar_month FROM star""",
)
def star_join(spark, sf):
    return M.star_join(X.star(spark, sf)).select(
        "order_id", "product_id", "customer_id", (F.col("gross_amount") / 10000).alias("gross"), "quantity", "segment",
        "region", "category", "sku", "fiscal_quarter", "calendar_month",
    )


@_q(
    "fact_columns",
    "lines",
    """SELECT order_id, product_id, CAST(gross_amount AS DOUBLE) AS gross_revenue, CAST(discount_amount AS DOUBLE) AS discount,
quantity AS units FROM lines""",
)
def fact_columns(spark, sf):
    facts = M.fact_columns(X.star(spark, sf).lines)
    return facts.select(
        "order_id", "product_id", (F.col("gross_revenue") / 10000).alias("gross_revenue"),
        (F.col("discount") / 10000).alias("discount"), "units",
    )


@_q("net_revenue", "star", f"SELECT calendar_month, {NET} FROM star GROUP BY calendar_month")
def net_revenue(spark, sf):
    return M.metrics_by_dimension(X.star(spark, sf), ["net_revenue"], ["calendar_month"])


@_q("total_orders", "star", f"SELECT segment, {ORDERS} FROM star GROUP BY segment")
def total_orders(spark, sf):
    return M.metrics_by_dimension(X.star(spark, sf), ["total_orders"], ["segment"])


@_q("units_sold", "star", f"SELECT category, {UNITS} FROM star GROUP BY category")
def units_sold(spark, sf):
    return M.metrics_by_dimension(X.star(spark, sf), ["units_sold"], ["category"])


@_q("avg_order_value", "star", f"SELECT sku, {AOV} FROM star GROUP BY sku")
def avg_order_value(spark, sf):
    return M.metrics_by_dimension(X.star(spark, sf), ["AOV"], ["sku"])


@_q(
    "metrics_by_dimension",
    "star",
    f"SELECT segment, region, fiscal_quarter, {NET}, {ORDERS}, {UNITS}, {AOV} FROM star GROUP BY segment, region, fiscal_quarter",
)
def metrics_by_dimension(spark, sf):
    """All metrics by tier, territory and fiscal quarter, named as a user would say them."""
    words = ["revenue", "order count", "volume", "AOV"]
    return M.metrics_by_dimension(X.star(spark, sf), words, ["tier", "territory", "fiscal_quarter"])


@_q(
    "metrics_by_product",
    "star",
    f"SELECT category, region, fiscal_year, {NET}, {ORDERS}, {UNITS}, {AOV} FROM star GROUP BY category, region, fiscal_year",
)
def metrics_by_product(spark, sf):
    words = ["net sales", "order count", "units", "AOV"]
    return M.metrics_by_dimension(X.star(spark, sf), words, ["product category", "geo", "fiscal_year"])


@_q(
    "calendar_dimension",
    "dates",
    "SELECT strftime(date_key, '%Y-%m-%d') AS day, fiscal_quarter, fiscal_year, calendar_month FROM dates",
)
def calendar_dimension(spark, sf):
    dates = X.star(spark, sf).dates
    return dates.select(F.date_format("date_key", "yyyy-MM-dd").alias("day"), "fiscal_quarter", "fiscal_year", "calendar_month")


@_q(
    "last_quarter_revenue",
    "star",
    f"""SELECT region, {NET} FROM star WHERE order_date >= date_trunc('quarter', DATE '{X.ANCHOR}') - INTERVAL 3 MONTH
AND order_date < date_trunc('quarter', DATE '{X.ANCHOR}') GROUP BY region""",
)
def last_quarter_revenue(spark, sf):
    """Net revenue by region in the quarter before the anchor date."""
    star = X.star(spark, sf)
    this_quarter = F.date_trunc("quarter", F.lit(X.ANCHOR).cast("timestamp_ntz")).cast("date")
    orders = star.orders.where(
        (F.col("order_date") >= F.add_months(this_quarter, -3)) & (F.col("order_date") < this_quarter)
    )
    narrowed = replace(star, orders=orders, narrowed=True)
    return M.metrics_by_dimension(narrowed, ["revenue"], ["region"])


@_q(
    "year_over_year",
    "star",
    f""", yearly AS (SELECT region, fiscal_year, {NET} FROM star GROUP BY region, fiscal_year)
SELECT a.region, a.fiscal_year, a.net_revenue, b.net_revenue AS previous, (a.net_revenue - b.net_revenue) / b.net_revenue AS growth
FROM yearly a LEFT JOIN yearly b ON b.region = a.region AND b.fiscal_year = a.fiscal_year - 1""",
)
def year_over_year(spark, sf):
    yearly = M.metrics_by_dimension(X.star(spark, sf), ["revenue"], ["region", "fiscal_year"])
    return M.year_over_year(yearly, "fiscal_year", "net_revenue", ["region"])


@_q(
    "metric_rollup",
    "star",
    f"SELECT segment, region, CAST(grouping_id(segment, region) AS BIGINT) AS level, {NET}, {ORDERS}, {UNITS}, {AOV} FROM star GROUP BY ROLLUP (segment, region)",
)
def metric_rollup(spark, sf):
    return M.metric_rollup(X.star(spark, sf), ["revenue", "order count", "units", "AOV"], ["tier", "geo"])


@_q(
    "metric_rollup_products",
    "star",
    f"SELECT category, region, CAST(grouping_id(category, region) AS BIGINT) AS level, {NET}, {ORDERS}, {UNITS}, {AOV} FROM star GROUP BY ROLLUP (category, region)",
)
def metric_rollup_products(spark, sf):
    return M.metric_rollup(X.star(spark, sf), ["revenue", "order count", "units", "AOV"], ["category", "geo"])


@_q(
    "metric_cells_rollup",
    "star",
    f"SELECT category, region, CAST(grouping_id(category, region) AS BIGINT) AS level, {NET}, {ORDERS}, {UNITS}, {AOV} FROM star GROUP BY ROLLUP (category, region)",
)
def metric_cells_rollup(spark, sf):
    """Stored cells after two further increments, each with lines of orders that are in them already."""
    star, dimensions, cells = X.star(spark, sf), ["category", "region", "fiscal_year"], None
    numbered = star.lines.withColumn("part", F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3)))
    for part in range(3):
        more = M.metric_cells(replace(star, lines=numbered.where(F.col("part") == part).drop("part")), dimensions)
        cells = cut_lineage(more if cells is None else M.merge_cells(cells, more))
    return M.rollup_cells(cells, ["revenue", "order count", "units", "AOV"], ["category", "geo"], star.minor_digits)
