import datetime as dt
import itertools
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators import catalog as C
from tidemark.operators import metrics as M
from tidemark.operators import search as R


@pytest.mark.parametrize("rows, asked, flags", [(5, 5, (5, False, True)), (6, 5, (5, True, True)), (4, 5, (4, False, False)), (3, 0, (1, True, True))])
def test_cap_and_truncation(spark, rows, asked, flags):
    first = C.bounded_query(spark.range(rows), [F.asc("id")], asked).first()
    assert (first["row_count"], first["truncated"], first["cap_reached"]) == flags


def test_hard_cap(spark):
    assert C.bounded_query(spark.range(3000), [F.asc("id")], 9999).count() == 1000


def test_lookup_returns_first_match(spark):
    table = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "k int, n int, v string")
    keys = spark.createDataFrame([(1,), (1,), (9,)], "key int")
    assert [tuple(r) for r in C.lookup_by_key(table, "k", keys, ["n"]).collect()] == [(1, 1, "a")]
    with pytest.raises(ValueError):
        C.lookup_by_key(table, "k; drop", keys, ["n"])


def test_candidate_keys_with_nulls(spark):
    table = spark.createDataFrame([(1, 1, None), (2, 1, 5)], "a int, b int, c int")
    got = {r["column"]: r["is_key"] for r in C.candidate_keys({"t": table}).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_distinct_values_are_compared_as_values(spark):
    """0.0 is -0.0, as SQL counts it; arrays differ by NULL elements and their places, texts by where one ends."""
    rows = [(0.0, [1, None], "a", "bc", 1), (-0.0, [None, 1], "ab", "c", 1), (2.0, [1], "a", "b", None)]
    table = spark.createDataFrame(rows, "x double, l array<int>, s string, t string, n int")
    got = {tuple(r) for r in C.candidate_keys({"t": table}).select("column", "distinct_values", "is_key").collect()}
    assert got == {("x", 2, False), ("l", 3, True), ("s", 2, False), ("t", 3, True), ("n", 1, False)}
    assert C.distinct_values(table, [("s", "t"), ("x", "n")]).where("repeated or has_null > 0").select("set").collect() == [(1,)]


def test_minimal_keys_by_trying_all_sets(spark, monkeypatch):
    monkeypatch.setattr(C, "REFUTING_ROWS", 5)
    rows = [(i % 4, i // 4 % 3, i // 12 % 5, i if i % 9 else None, f"{i % 7}|", f"{i // 7}") for i in range(60)]
    columns = ["a", "b", "c", "d", "e", "f"]
    table = spark.createDataFrame(rows, columns)

    def is_key(s):
        values = [tuple(r[columns.index(c)] for c in s) for r in rows]
        return not any(None in v for v in values) and len(set(values)) == len(values)

    keys = [s for n in (1, 2, 3) for s in itertools.combinations(columns, n) if is_key(s)]
    want = [s for s in keys if not any(set(k) < set(s) for k in keys)]
    assert C.minimal_keys(table) == want and ("a", "b", "c") in want and ("e", "f") in want
    assert C.minimal_keys(table.where("false")) == []


def test_repeats_are_found_in_the_slice_that_holds_them(spark, monkeypatch):
    """A pair that repeats once anywhere is refuted, a pair that never does is not; each row is looked at once for a set."""
    monkeypatch.setattr(C, "REFUTING_ROWS", 5)
    table = spark.range(3000).selectExpr("id % 1000 AS a", "IF(id = 2999, 0, id div 1000) AS b", "id div 1000 AS c", "id % 2 AS d")
    assert C.repeated_sets(table, [("a", "b"), ("a", "c"), ("a", "b", "d")], ["a", "a", "a"]) == {0, 2}
    assert C.minimal_keys(table) == [("a", "c")]
    looked = []
    monkeypatch.setattr(C, "_unpivoted", lambda df, sets, numbers=None, real=C._unpivoted: looked.append(df.count()) or real(df, sets, numbers))
    C.repeated_sets(table, [("a", "c")], ["a"])
    assert sum(looked) == 3000 and looked[0] < 100


def test_sketches_merge_as_if_taken_at_once(spark):
    table = spark.range(30_000).selectExpr("id % 5000 AS n", "id * 0.5 AS x", "concat('v', id % 300) AS s", "IF(id % 10 = 0, NULL, id) AS m", "array(id % 3) AS l")
    parts = [C.column_sketches("t", table.where(f"pmod(x, 3) {test} 1")) for test in ("<", ">=")]
    merged = {r["column"]: r for r in C.merge_sketches(parts[0].unionByName(parts[1])).select("*", F.hll_sketch_estimate("distinct_sketch").alias("d")).collect()}
    whole = {r["column"]: r for r in C.column_sketches("t", table).collect()}
    for c, distinct in {"n": 5000, "x": 30_000, "s": 300, "m": 27_000, "l": 3}.items():
        assert abs(merged[c]["d"] - distinct) <= 0.025 * distinct + 1
        for name in ("rows", "null_count", "min_value", "max_value", "type", "ordinal"):
            assert merged[c][name] == whole[c][name], (c, name)
    assert merged["m"]["null_count"] == 3000 and merged["l"]["min_value"] is None
    half = C.merge_sketches(parts[0].unionByName(parts[1])).where("column = 'x'").select(F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5))).first()[0]
    assert abs(half - 7500) < 0.015 * 15_000
    plan = C.column_sketches("t", table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_distinct_sketch_tells_close_doubles_apart(spark):
    """Values that agree in their first six decimals are values of their own."""
    table = spark.range(2000).selectExpr("id * 1e-9 AS x")
    assert abs(C.column_sketches("t", table).select(F.hll_sketch_estimate("distinct_sketch")).first()[0] - 2000) < 60


def test_cells_with_late_lines_equal_the_rollup(star):
    metrics, dimensions = ["net_revenue", "total_orders", "units_sold", "avg_order_value"], ["category", "region", "fiscal_year"]
    parts = [star.lines.where(c) for c in ("product_id = 0", "product_id = 1 AND order_id = 1", "order_id > 1 AND product_id = 1")]
    cells = None
    for lines in parts:
        more = M.metric_cells(replace(star, lines=lines), dimensions)
        cells = more if cells is None else M.merge_cells(cells, more)
    for kept in (dimensions, dimensions[:2], dimensions[:1], []):
        got = sorted(map(str, M.rollup_cells(cells, metrics, kept).collect()))
        assert got == sorted(map(str, M.metric_rollup(star, metrics, kept).collect())) if kept else len(got) == 1
    assert "Expand" not in M.rollup_cells(cells, metrics, dimensions)._jdf.queryExecution().executedPlan().toString()


def test_catalog_inventory(spark):
    spark.range(7).createOrReplaceTempView("seven_rows")
    got = C.catalog_inventory(spark, "default").where("name = 'seven_rows'").first()
    assert (got["type"], got["row_count"], got["ingest_rows"], got["comment"]) == ("TEMPORARY", 7, True, None)
    spark.catalog.dropTempView("seven_rows")


@pytest.fixture(scope="module")
def star(spark):
    """One order holds most lines."""
    money = "decimal(12,2)"
    lines = [(1, i % 2, Decimal(10), Decimal(1), 1) for i in range(90)] + [(2, 0, Decimal(5), None, 2), (3, 1, Decimal(8), Decimal(0), 3)]
    return M.Star(
        spark.createDataFrame(lines, f"order_id int, product_id int, gross_amount {money}, discount_amount {money}, quantity int"),
        spark.createDataFrame([(1, 1, dt.date(2024, 1, 5)), (2, 1, dt.date(2024, 2, 5)), (3, 2, dt.date(2024, 2, 6))], "order_id int, customer_id int, order_date date"),
        spark.createDataFrame([(1, "s1", "r1"), (2, "s2", "r1")], "customer_id int, segment string, region string"),
        spark.createDataFrame([(0, "c0", "k0"), (1, "c1", "k1")], "product_id int, category string, sku string"),
        spark.createDataFrame([(dt.date(2024, 1, 5), "q", 2024, "2024-01"), (dt.date(2024, 2, 5), "q", 2024, "2024-02"), (dt.date(2024, 2, 6), "q", 2024, "2024-02")],
                              "date_key date, fiscal_quarter string, fiscal_year int, calendar_month string"),
    )


def test_metrics(star):
    words = ["revenue", "order count", "volume", "AOV"]
    by_region = M.metrics_by_dimension(star, words, ["geo"]).collect()
    assert [tuple(r) for r in by_region] == [("r1", 818.0, 3, 95, 913 / 3)]
    by_category = {r["category"]: r["total_orders"] for r in M.metrics_by_dimension(star, ["total_orders"], ["category"]).collect()}
    assert by_category == {"c0": 2, "c1": 2}
    whole = M.metrics_by_dimension(star, words, []).first()
    assert tuple(whole) == (818.0, 3, 95, 913 / 3)


def test_rollup_levels(star):
    got = sorted((r["level"], r["segment"] or "", r["total_orders"]) for r in M.metric_rollup(star, ["order count"], ["segment", "region"]).collect())
    assert got == [(0, "s1", 2), (0, "s2", 1), (1, "s1", 2), (1, "s2", 1), (3, "", 3)]
    products = M.metric_rollup(star, ["order count", "units"], ["sku"])
    assert [tuple(r) for r in products.where("level = 1").select("total_orders", "units_sold").collect()] == [(3, 95)]


def test_rollup_counts_orders_without_sets_of_them(star):
    """Orders that span products, at every level of product, customer and date dimensions in any order; no copy of an order per level."""
    lost = star.lines.limit(1).withColumn("order_id", F.lit(None).cast("int"))
    star = replace(star, lines=star.lines.unionByName(lost))
    for dimensions in (["category", "region", "sku"], ["region", "sku", "category"], ["sku", "category"]):
        rollup = M.metric_rollup(star, ["order count"], dimensions)
        assert "order_id" not in "".join(line for line in rollup._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in line)
        facts = M.per_order(star, dimensions).collect()
        want = set()
        for kept in range(len(dimensions) + 1):
            orders = {}
            for r in facts:
                orders.setdefault(tuple(r[d] for d in dimensions[:kept]), set()).add(r["order_id"])
            gone = len(dimensions) - kept
            want |= {(*k, *[None] * gone, (1 << gone) - 1, len(v - {None})) for k, v in orders.items()}
        assert {(*(r[d] for d in dimensions), r["level"], r["total_orders"]) for r in rollup.collect()} == want


def test_lines_without_an_order_are_no_order(star):
    first = star.lines.schema["order_id"]
    lost = star.lines.limit(1).withColumn("order_id", F.lit(None).cast(first.dataType))
    more = replace(star, lines=star.lines.unionByName(lost))
    assert M.metrics_by_dimension(more, ["order count"], []).first()[0] == 3


def test_unknown_word():
    with pytest.raises(ValueError):
        M.resolve_term("profit")


def test_calendar_fiscal_year(spark):
    source = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),)], "d date")
    got = M.calendar(F.min("d"), F.max("d"), source, 4).orderBy("date_key").collect()
    assert [(r["fiscal_quarter"], r["fiscal_year"]) for r in got] == [("FY2024-Q4", 2024), ("FY2025-Q1", 2025)]


def test_growth_needs_the_year_before(spark):
    yearly = spark.createDataFrame([("r", 2020, 10.0), ("r", 2021, 15.0), ("r", 2023, 30.0)], "region string, y int, v double")
    got = [(r["y"], r["previous"], r["growth"]) for r in M.year_over_year(yearly, "y", "v", ["region"]).orderBy("y").collect()]
    assert got == [(2020, None, None), (2021, 10.0, 0.5), (2023, None, None)]


def test_keyword_matches_against_brute_force(spark):
    texts = ["the cat sat", "the dog", "THE cat; the dog sat!", "cat", "", "élan vital the", "the the the cat dog"]
    asked = ["the cat", "dog the", "absent word", "  ", "Élan", "the"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    split = {k: [r[0] for r in d.select(tokens(F.col("text"))).collect()] for k, d in (("d", documents), ("q", queries))}
    expected = sorted(
        (q, d, sum(w in words for w in found))
        for q, words in enumerate(split["q"]) if words
        for d, found in enumerate(split["d"]) if set(words) <= set(found)
    )
    assert sorted(tuple(r) for r in R.keyword_matches(documents, queries).collect()) == expected


def test_facets_count_documents_once(spark):
    documents = spark.createDataFrame([("en", ["a", "a", "b"]), ("en", ["a"])], "lang string, tags array<string>")
    got = sorted(tuple(r) for r in R.facet_counts(documents, ["lang"], ["tags"]).collect())
    assert got == [("lang", "en", 2), ("tags", "a", 2), ("tags", "b", 1)]
