"""A metric layer over a star of orders, customers, products and dates.

Order lines are reduced to one row per order (and product attribute, when one is
asked for) before any join. An order holding a third of all lines is then a
single row per task, order counts need no second distinct, and only dimensions
that were asked for are joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.constants import TERM_SYNONYMS

CUSTOMER_DIMENSIONS = ("segment", "region")
PRODUCT_DIMENSIONS = ("category", "sku")
DATE_DIMENSIONS = ("fiscal_quarter", "fiscal_year", "calendar_month")
DIMENSIONS = CUSTOMER_DIMENSIONS + PRODUCT_DIMENSIONS + DATE_DIMENSIONS
METRICS = ("net_revenue", "total_orders", "units_sold", "avg_order_value")


@dataclass(frozen=True)
class Star:
    """lines(order_id, product_id, gross_amount, discount_amount, quantity),
    orders(order_id, customer_id, order_date), customers(customer_id, segment, region),
    products(product_id, category, sku), dates(date_key, fiscal_quarter, fiscal_year, calendar_month).

    Amounts are decimals, or integers counting ``10 ** -minor_digits`` of the currency.
    Integers are added without boxing, and an overflow is an error, never a wrong sum."""

    lines: DataFrame
    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    dates: DataFrame
    minor_digits: int = 0
    narrowed: bool = False
    """Whether ``orders`` was filtered: then lines of other orders go before anything is summed."""


def fact_columns(lines: DataFrame) -> DataFrame:
    return (
        lines.withColumn("gross_revenue", F.col("gross_amount"))
        .withColumn("discount", F.col("discount_amount"))
        .withColumn("units", F.col("quantity"))
    )


def star_join(star: Star) -> DataFrame:
    """Facts with every dimension over the declared many-to-one keys. Small
    dimensions are broadcast by Spark's own size check; an order or product key
    that is hot on the fact side is split by the adaptive skew join."""
    return (
        star.lines.join(star.orders, "order_id")
        .join(star.customers, "customer_id")
        .join(star.products, "product_id")
        .join(star.dates, F.col("order_date") == F.col("date_key"))
        .drop("date_key")
    )


def resolve_term(word: str) -> str:
    """A business word to its metric or dimension name."""
    name = TERM_SYNONYMS.get(word, word)
    if name not in METRICS + DIMENSIONS:
        raise ValueError(f"unknown metric or dimension {word!r}")
    return name


def calendar(first: Column, last: Column, source: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """One row per day from the earliest to the latest date in ``source``."""
    span = source.agg(first.alias("lo"), last.alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key"))
    shifted = F.add_months("date_key", (13 - fiscal_start_month) % 12)
    return days.select(
        "date_key",
        F.concat(F.lit("FY"), F.year(shifted), F.lit("-Q"), F.quarter(shifted)).alias("fiscal_quarter"),
        F.year(shifted).cast("bigint").alias("fiscal_year"),
        F.date_format("date_key", "yyyy-MM").alias("calendar_month"),
    )


def per_order(star: Star, dimensions: list[str], firsts: bool = False) -> DataFrame:
    """One row per order and requested product attribute, with all requested dimensions. With ``firsts``, ``first0``, ``first1``, ...: whether (1 or 0)
    the row is the first of its order among those with the same first 0, 1, ... product attributes; lines without an order are none."""
    by_product = [d for d in dimensions if d in PRODUCT_DIMENSIONS]
    lines = star.lines
    if star.narrowed:
        lines = lines.join(star.orders.select("order_id"), "order_id", "left_semi")
    if by_product:
        lines = lines.join(star.products.select("product_id", *by_product), "product_id")
    facts = lines.groupBy("order_id", *by_product).agg(
        F.sum(F.col("gross_amount") - F.col("discount_amount")).alias("net"),
        F.sum("gross_amount").alias("gross"),
        F.sum("quantity").alias("units"),
    )
    if firsts:
        for k in range(len(by_product)):
            order = W.partitionBy("order_id", *by_product[:k]).orderBy(*by_product[k:])
            facts = facts.withColumn(f"first{k}", ((F.row_number().over(order) == 1) & F.col("order_id").isNotNull()).cast("int"))
        facts = facts.withColumn(f"first{len(by_product)}", F.col("order_id").isNotNull().cast("int"))
    by_customer = [d for d in dimensions if d in CUSTOMER_DIMENSIONS]
    by_date = [d for d in dimensions if d in DATE_DIMENSIONS]
    if by_customer or by_date:
        facts = facts.join(star.orders, "order_id")
    if by_customer:
        facts = facts.join(star.customers.select("customer_id", *by_customer), "customer_id")
    if by_date:
        dates = star.dates.select("date_key", *by_date)
        facts = facts.join(dates, F.col("order_date") == F.col("date_key"))
    return facts


def _money(total: str, minor_digits: int) -> Column:
    """A sum of per-order amounts as a double, rounded once. Integer amounts are
    added as wide decimals here, so a grand total cannot overflow."""
    if not minor_digits:
        return F.sum(total).cast("double")
    unit = F.lit(Decimal(1).scaleb(-minor_digits))
    return (F.sum(F.col(total).cast("decimal(28,0)")).cast("decimal(38,0)") * unit).cast("double")


def _measures(names: list[str], orders: Column, minor_digits: int) -> list[Column]:
    known = {
        "net_revenue": _money("net", minor_digits),
        "total_orders": orders.cast("bigint"),
        "units_sold": F.sum("units").cast("bigint"),
        "avg_order_value": F.try_divide(_money("gross", minor_digits), orders.cast("double")),
    }
    return [known[n].alias(n) for n in names]


def metrics_by_dimension(star: Star, metrics: list[str], dimensions: list[str]) -> DataFrame:
    """Any metrics by any dimensions; both may be given as business words."""
    metrics, dimensions = [resolve_term(m) for m in metrics], [resolve_term(d) for d in dimensions]
    facts = per_order(star, dimensions)
    orders = F.count("order_id")  # one row per order and product attributes, all of which are grouped on
    return facts.groupBy(*dimensions).agg(*_measures(metrics, orders, star.minor_digits))


def year_over_year(yearly: DataFrame, year: str, value: str, by: list[str]) -> DataFrame:
    """Adds the previous year's value and the change; runs on aggregated rows only."""
    order = W.partitionBy(*by).orderBy(year)
    before = F.when(F.lag(year).over(order) == F.col(year) - 1, F.lag(value).over(order))
    return yearly.withColumn("previous", before).withColumn(
        "growth", F.try_divide(F.col(value) - F.col("previous"), F.col("previous"))
    )


def metric_rollup(star: Star, metrics: list[str], dimensions: list[str]) -> DataFrame:
    """Subtotals from the most detailed level up to the grand total.

    The detailed level is aggregated first and its few rows are rolled up. Customer and date dimensions are the same for all of an order, so there one
    row is one order at every level. An order can span products: then a level counts the rows that are the first of their order among those with the
    same product attributes of that level, so no order is held in a set.
    """
    metrics, dimensions = [resolve_term(m) for m in metrics], [resolve_term(d) for d in dimensions]
    level = F.grouping_id().cast("bigint").alias("level")
    by_product = [d for d in dimensions if d in PRODUCT_DIMENSIONS]
    wide = "decimal(28,0)" if star.minor_digits else "decimal(38,6)"
    firsts = [F.sum(f"first{k}").alias(f"orders{k}") for k in range(len(by_product) + 1)]
    detail = (
        per_order(star, dimensions, firsts=True)
        .groupBy(*dimensions)
        .agg(
            F.sum(F.col("net").cast(wide)).alias("net"),
            F.sum(F.col("gross").cast(wide)).alias("gross"),
            F.sum("units").alias("units"),
            *firsts,
        )
    )
    orders = F.sum(f"orders{len(by_product)}")
    for kept in reversed(range(len(dimensions))):  # a level's id is that of its least detailed dimensions, all ones
        products = len(set(dimensions[:kept]) & set(by_product))
        orders = F.when(F.grouping_id() == (1 << len(dimensions) - kept) - 1, F.sum(f"orders{products}")).otherwise(orders)
    return detail.rollup(*dimensions).agg(level, *_measures(metrics, orders, star.minor_digits))


def _cell_sums(wide: str) -> list[Column]:
    return [F.sum(F.col(c).cast(wide)).alias(c) for c in ("net", "gross", "units")]


def metric_cells(star: Star, dimensions: list[str]) -> DataFrame:
    """Cells that can be merged: per combination of dimensions, and per 32,768 order numbers, the sums and one bitmap of the orders in it.

    Order ids are whole numbers, 0 or more. A line that comes late only adds to its cell: the order's bit may be set already.
    """
    dimensions = [resolve_term(d) for d in dimensions]
    wide = "decimal(28,0)" if star.minor_digits else "decimal(38,6)"
    facts = per_order(star, dimensions).withColumn("bucket", F.bitmap_bucket_number("order_id"))
    return facts.groupBy(*dimensions, "bucket").agg(*_cell_sums(wide), F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("orders"))


def merge_cells(cells: DataFrame, more: DataFrame) -> DataFrame:
    """Stored cells with those of further lines."""
    both = cells.unionByName(more)
    keys = [c for c in cells.columns if c not in ("net", "gross", "units", "orders")]
    return both.groupBy(*keys).agg(*_cell_sums("decimal(38,6)" if dict(cells.dtypes)["net"].endswith(",6)") else "decimal(28,0)"), F.bitmap_or_agg("orders").alias("orders"))


def rollup_cells(cells: DataFrame, metrics: list[str], dimensions: list[str], minor_digits: int = 0) -> DataFrame:
    """Subtotals as ``metric_rollup`` gives them, from cells alone.

    Each level is made from the one before by adding sums and uniting bitmaps, so an order that spans products is counted once at every level
    without meeting the facts, or a copy of them per level, again.
    """
    metrics, dimensions = [resolve_term(m) for m in metrics], [resolve_term(d) for d in dimensions]
    levels, types = [], dict(cells.dtypes)
    for kept in range(len(dimensions), -1, -1):
        names, gone = dimensions[:kept], dimensions[kept:]
        cells = cells.groupBy(*names, "bucket").agg(*_cell_sums("decimal(38,6)" if not minor_digits else "decimal(28,0)"), F.bitmap_or_agg("orders").alias("orders"))
        level = F.lit((1 << len(gone)) - 1).cast("bigint").alias("level")
        told = cells.groupBy(*names).agg(*_measures(metrics, F.sum(F.bitmap_count("orders")), minor_digits))
        levels.append(told.select(*names, *[F.lit(None).cast(types[c]).alias(c) for c in gone], level, *metrics))
    return reduce(DataFrame.unionByName, levels)
