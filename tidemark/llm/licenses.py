"""Licence scan: canonical digests of entire texts, looked up by a hash join.

A text is made canonical (case, copyright lines, equivalent spellings, punctuation and white space), digested, and joined to the digests
of known texts. The units are entire documents, and their lines, each as a text of its own.
``oracle`` is the older rule in DuckDB SQL: it takes lines that wrapping begins with "copyright notice" or "copyright holder" for statements,
and looks up only lines that name a licence. Both make letters lower-case for A-Z alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.license_texts import KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines that begin with a copyright mark, after any signs.
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright|[(]c[)]|©)[^\n]*"
#: Line ends before words that speak of copyright without stating whose it is; such lines are unwrapped before copyright lines go.
SPEAKS_OF = [(rf"\n[^a-z0-9\n]*copyright[^a-z0-9]+{word}", f" copyright {word}") for word in ("notice", "holder", "owner", "law", "statement", "license", "licence")]
#: ASCII signs and white space, and typographic spaces, dashes, quotes and marks.
PUNCTUATION = r"[\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{BF}\x{2000}-\x{206F}\x{3000}]+"
#: Spellings taken as one, after punctuation is gone; fixed values.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("organisation", "organization"), ("favour", "favor"), ("non commercial", "noncommercial"), ("https", "http"), ("per cent", "percent"), ("owner", "holder"), ("owners", "holders")]
NAMES_A_LICENSE = r"[Ll][Ii][Cc][Ee][Nn][CcSs]"


def canonical(text: Column) -> Column:
    """The canonical form of a text; NULL counts as empty."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for a, b in SPEAKS_OF:
        t = F.regexp_replace(t, a, b)
    t = F.regexp_replace(t, COPYRIGHT_LINE, " ")
    t = F.regexp_replace(t, PUNCTUATION, " ")
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.regexp_replace(t, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, license_id`` of known texts; one id, the first by name, for texts that are the same."""
    rows = spark.createDataFrame(KNOWN if known is None else known, "license_id string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``doc_id, line, digest, license_id``: a row with line 0 for every document as a whole (``license_id`` NULL if unknown), and a row
    for every line of a text of several lines, numbered from 1, that is a known text by itself.

    A NULL text counts as empty, whose digest is known for nothing; repeated rows give rows each; an empty table gives none.
    The known texts are a fixed list in this package, which bounds the side that is sent to all tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct((i + 1).alias("line"), line.alias("unit")))
    whole = F.array(F.struct(F.lit(0).alias("line"), text.alias("unit")))
    units = F.when(text.contains("\n"), F.concat(whole, lines)).otherwise(whole)
    rows = docs.select("doc_id", F.inline_outer(units)).select("doc_id", "line", digest(F.col("unit")).alias("digest"))
    return rows.join(F.broadcast(known_digests(docs.sparkSession, known)), "digest", "left").filter((F.col("line") == 0) | F.col("license_id").isNotNull()).select("doc_id", "line", "digest", "license_id")


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB SQL."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def form(column: str) -> str:
        t = f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"
        t = f"regexp_replace({t}, {quoted(COPYRIGHT_LINE)}, ' ', 'g')"
        t = f"' ' || regexp_replace({t}, {quoted(PUNCTUATION)}, ' ', 'g') || ' '"
        for a, b in SPELLINGS:
            t = f"replace({t}, ' {a} ', ' {b} ')"
        return f"sha256(trim(regexp_replace({t}, ' +', ' ', 'g'), ' '))"

    listed = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in KNOWN)
    return f"""
        WITH known AS (SELECT {form("body")} AS digest, min(license_id) AS license_id FROM (VALUES {listed}) AS k(license_id, body) GROUP BY 1),
        cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE contains(text, chr(10))),
        lines AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line, unnest(parts) AS unit FROM cut),
        units AS (SELECT doc_id, 0 AS line, text AS unit FROM documents
                  UNION ALL SELECT doc_id, line, unit FROM lines WHERE regexp_matches(unit, '{NAMES_A_LICENSE}')),
        digested AS (SELECT doc_id, CAST(line AS INTEGER) AS line, {form("unit")} AS digest FROM units)
        SELECT doc_id, line, digest, license_id FROM digested LEFT JOIN known USING (digest) WHERE line = 0 OR license_id IS NOT NULL"""
