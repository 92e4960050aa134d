"""Landed JSON feeds: one page object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE = "struct<id:bigint,title:string,body_html:string,url:string,author:string,status:string>"


def read_feed(spark: SparkSession, path: str, row: str = ARTICLE) -> DataFrame:
    """One row per record from pages that keep their records under ``articles``,
    ``items``, ``result`` or ``d.results``. ``row`` is the record type; it is given,
    so nothing is read twice to infer it, and fields outside it are not parsed. A broken page is an error, not fewer records."""
    schema = f"articles array<{row}>, items array<{row}>, result array<{row}>, d struct<results:array<{row}>>"
    pages = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return pages.select(F.explode(F.coalesce("articles", "items", "result", "d.results")).alias("a")).select("a.*")


#: Fields of an article record and their types. Fixed values.
ARTICLE_FIELDS = {
    "id": "bigint",
    "title": "string",
    "body_html": "string",
    "url": "string",
    "author": "string",
    "status": "string",
    "tags": "array<string>",
    "reader_users": "array<string>",
    "reader_groups": "array<string>",
    "updated_at": "string",
    "is_public": "boolean",
}
LISTS = ("articles", "items", "result", "d.results")


def read_records(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """One row per record of any shape, from pages as ``read_feed`` takes them: the stated fields, ``mistyped`` and ``rest``.

    A page is parsed once, into a variant, where scalars keep their type. A field of another type than stated is NULL and named in
    ``mistyped`` with the type it has (``name:TYPE``, comma-joined); fields that are not stated are in ``rest``, a JSON object. A broken page is an error.
    """
    pages = spark.read.text(path).select(F.parse_json("value").alias("page"))
    lists = [F.try_variant_get("page", f"$.{name}", "array<variant>") for name in LISTS]
    records = pages.select(F.explode(F.coalesce(*lists)).alias("record"))
    values, wrong = {}, []
    for name, kind in fields.items():
        found = F.try_variant_get("record", f"$.{name}", "variant")
        held = F.schema_of_variant(found)
        fits = found.isNull() | F.is_variant_null(found) | held.isin(kind.upper(), "ARRAY<VOID>" if kind.startswith("array") else kind.upper())
        values[name] = F.when(fits, F.try_variant_get("record", f"$.{name}", kind))
        wrong.append(F.when(~fits, F.concat(F.lit(f"{name}:"), held)))
    known = F.array(*[F.lit(f) for f in fields])
    every = F.try_variant_get("record", "$", "map<string,variant>")
    values["rest"] = F.to_json(F.map_filter(every, lambda k, v: ~F.array_contains(known, k)))
    return records.select(*[v.alias(k) for k, v in values.items()], F.concat_ws(",", *wrong).alias("mistyped"))
