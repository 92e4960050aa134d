"""Binary payload helpers."""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def import_line(body: Column) -> Column:
    """One document as the JSON object an import file holds, from the columns id,
    metadata (a JSON object as text), mime_type and principals. ``body`` is text or bytes."""
    raw = F.replace(F.base64(body.cast("binary")), F.lit("\r\n"), F.lit(""))
    content = F.to_json(F.struct(F.col("mime_type").alias("mimeType"), raw.alias("rawBytes")))

    def reader(p: Column) -> Column:
        return F.struct(
            F.when(p["kind"] == "user", p["id"]).alias("userId"),
            F.when(p["kind"] == "group", p["id"]).alias("groupId"),
            F.when(p["kind"] == "entity", p["id"]).alias("externalEntityId"),
            F.when(p["kind"] == "idp_wide", True).alias("idpWide"),
        )

    listed = F.transform("principals", reader)
    access = F.to_json(F.struct(F.array(F.struct(listed.alias("principals"))).alias("readers")))
    parts = [
        F.lit('{"id":'),
        F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2),
        F.lit(',"structData":'),
        F.coalesce("metadata", F.lit("{}")),
        F.lit(',"content":'),
        content,
        F.lit(',"aclInfo":'),
        access,
        F.lit("}"),
    ]
    return F.concat(*parts)


IMPORT_SCHEMA = (
    "id string, structData string, content struct<mimeType:string,rawBytes:string>, "
    "aclInfo struct<readers:array<struct<principals:array<struct<userId:string,groupId:string,externalEntityId:string,idpWide:boolean>>>>>"
)


def read_principals(access: Column) -> Column:
    """The principals of an import line, back as STRUCT<kind, id>."""

    def one(p: Column) -> Column:
        kind = (
            F.when(p["userId"].isNotNull(), "user")
            .when(p["groupId"].isNotNull(), "group")
            .when(p["externalEntityId"].isNotNull(), "entity")
            .otherwise("idp_wide")
        )
        return F.struct(kind.alias("kind"), F.coalesce(p["userId"], p["groupId"], p["externalEntityId"]).alias("id"))

    return F.transform(F.flatten(F.transform(access["readers"], lambda r: r["principals"])), one)


def _gunzip(body: bytes) -> bytes:
    try:
        return gzip.decompress(body)
    except (OSError, EOFError, zlib.error):
        return body


@F.pandas_udf(T.BinaryType())
def _gunzip_all(bodies: pd.Series) -> pd.Series:
    return bodies.map(_gunzip, na_action="ignore")


def decode_attachment(encoded: Column) -> Column:
    """Base64, then gunzip when the bytes are gzip. Plain bodies (no gzip magic)
    never leave the JVM."""
    raw = F.unbase64(encoded)
    zipped = F.substring(raw, 1, 2) == F.lit(bytes([0x1F, 0x8B]))
    return F.when(zipped, _gunzip_all(F.when(zipped, raw))).otherwise(raw)
