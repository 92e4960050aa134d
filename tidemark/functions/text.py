"""Text, id and date expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import ID_MAX_CHARS

# Java's \s under (?U) lacks the four separators that the source systems' regex counts as space.
SPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"
TAG = r"<[^>]+>"

COMMON_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&middot;": "·",
    "&copy;": "©",
    "&nbsp;": " ",
}


@F.pandas_udf(T.StringType())
def _unescape_all(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


RARE_ENTITY = "&(?!(?:amp|" + "|".join(e[1:-1] for e in COMMON_ENTITIES) + ");)"


def _unescape_common(text: Column) -> Column:
    """Entities of the short table; ``&amp;`` last, so nothing is decoded twice."""
    decoded = text
    for entity, char in COMMON_ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(text.contains("&"), F.replace(decoded, F.lit("&amp;"), F.lit("&"))).otherwise(text)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE.removeprefix('(?U)')}$", "")


def strip_tags(html_text: Column) -> Column:
    return F.regexp_replace(F.coalesce(html_text, F.lit("")), TAG, " ")


def with_html_text(
    df: DataFrame, source: str, target: str, unescape: bool = True, space: str = "collapse"
) -> DataFrame:
    """Adds ``target``: tags become spaces, entities are decoded, and white space is
    collapsed (and trimmed), only trimmed (``strip``) or left alone (``keep``).

    Each step is a column of its own, so Spark computes it once per row. Only rows
    with an entity outside the short table go through Python; it gets NULL for the rest.
    """
    plain, rare, full = f"_{target}_plain", f"_{target}_rare", f"_{target}_full"
    df = df.withColumn(plain, strip_tags(F.col(source)))
    text = F.col(plain)
    if unescape:
        df = df.withColumn(rare, text.rlike(RARE_ENTITY))
        df = df.withColumn(full, _unescape_all(F.when(F.col(rare), text)))
        text = F.when(F.col(rare), F.col(full)).otherwise(_unescape_common(text))
    if space == "collapse":
        text = F.trim(F.regexp_replace(text, SPACE, " "))
    elif space == "strip":
        text = strip(text)
    return df.withColumn(target, text).drop(plain, rare, full)


def as_text(column: str, dtype: T.DataType) -> Column:
    """A value the way the source connectors print it: True/False, plain decimals
    for floats up to 1e16, and six fraction digits only when a time has any."""
    c = F.col(column)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _float_text(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _clock(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def _float_text(c: Column) -> Column:
    s = c.cast("string")
    plain = F.rtrim(s.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(s, "E", 1), r"\.0$", "")
    exponent = F.substring_index(s, "E", -1).try_cast("int")
    sign = F.when(exponent < 0, "-").otherwise("+")
    science = F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    science = F.when(F.abs(exponent) > 99, F.concat(mantissa, F.lit("e"), sign, F.abs(exponent).cast("string"))).otherwise(science)
    size = F.abs(c)
    special = (
        F.when(F.isnan(c), "nan")
        .when(c == float("inf"), "inf")
        .when(c == float("-inf"), "-inf")
    )
    written = F.when(
        s.contains("E"), F.when((size < 1e16) & (size >= 1e-4), plain).otherwise(science)
    ).otherwise(s)
    return F.coalesce(special, written)


def _clock(ts: Column, pattern: str) -> Column:
    whole = F.date_format(ts, pattern)
    return F.when(ts == F.date_trunc("second", ts), whole).otherwise(
        F.date_format(ts, pattern + ".SSSSSS")
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with a +00:00 offset; naive times are taken as UTC."""
    return F.concat(_clock(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def render_row_text(columns: list[str], schema: T.StructType) -> Column:
    """``"a: 1. b: x."`` over the non-null columns in the given order; ``"."`` when all are null."""
    parts = [F.concat(F.lit(f"{c}: "), as_text(c, schema[c].dataType)) for c in columns]
    return F.concat(F.concat_ws(". ", *parts), F.lit("."))


def first_filled(*values: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def file_document_id(scheme: str, path: Column) -> Column:
    """The path with ``/`` as ``_``. Where that is longer than an id may be, or the path holds ``_`` itself, the
    id ends with a hash of the whole path, so that different paths never share one."""
    plain = F.translate(F.concat(F.lit(scheme + ":"), path), "/", "_")
    hashed = F.concat(F.substring(plain, 1, ID_MAX_CHARS - 33), F.lit("_"), F.md5(path.cast("binary")))
    return F.when((F.length(plain) > ID_MAX_CHARS) | path.contains("_"), hashed).otherwise(plain)


def parse_mixed_date(value: Column) -> Column:
    """``/Date(millis)/`` or ISO-8601 to a UTC timestamp without zone; bad text is NULL.

    An offset after ``+`` inside ``/Date()/`` is ignored."""
    millis = F.regexp_extract(value, r"^/Date\((-?\d+)(?:\+\d*)?\)/$", 1).try_cast("decimal(20,0)")
    from_millis = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (millis / 1000).cast("decimal(18,6)")
    )
    iso = F.regexp_like(value, F.lit(r"^\d{4}-\d{2}-\d{2}"))
    with_zone = F.to_utc_timestamp(value.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    zoned = F.regexp_like(value, F.lit(r"(?:Z|[+-]\d{2}:?\d{2})$")) & value.contains("T")
    return (
        F.when(value.startswith("/Date("), from_millis)
        .when(iso & zoned, with_zone)
        .when(iso, value.try_cast("timestamp_ntz"))
    )


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")
