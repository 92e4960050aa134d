"""Secrets: keyword prefilter, anchored expressions at hits, embedded checks.

One Aho-Corasick pass over the bytes of a text (ASCII letters lowered) finds where a secret could begin. Only there
is a regular expression tried, anchored at the hit. Hexadecimal runs have no keyword of their own: all strings of four
hexadecimal digits are keywords, so the first hit of a run is its beginning. Token formats that carry a check
(CRC-32 in base 62, or a JSON header) are kept only if it holds.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import json
import re
import zlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, span_list

#: Order of kinds where spans start together. The first three are the base.
KINDS = ["assign", "access", "hex", "github", "npm", "jwt", "pem"]
BASE = KINDS[:3]
HEX = "0123456789abcdef"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Fixed prefixes of token formats.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "eyj": "jwt",
    "-----begin": "pem",
}
ANCHORED = {
    "assign": re.compile(rb"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "pem": re.compile(rb"-----BEGIN ((?:[A-Z]+ ){0,3}PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----"),
}


def _checksum(body: bytes) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value, digits = zlib.crc32(body[:-6]), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits.encode() == body[-6:]


def _header(part: bytes) -> bool:
    """Base64 of a JSON object that names an algorithm."""
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, TypeError):
        return False


def _holds(kind: str, found: re.Match) -> bool:
    if kind == "assign":
        return len(found[1]) >= 12
    if kind == "access":
        return len(found[0]) >= 18
    if kind == "hex":
        return len(found[0]) >= 16
    if kind in ("github", "npm"):
        return _checksum(found[1])
    return kind == "pem" or _header(found[1])


def automaton() -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    words = KEYWORDS | {"".join(x): "hex" for x in itertools.product(HEX, repeat=4)}
    for word, kind in words.items():
        built.add_word(word, (len(word) - 1, kind))
    built.make_automaton()
    return built


def find_secrets(text: str, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points. Per kind leftmost matches that do not overlap; a match that fails
    its check is dropped, and the search goes on behind it."""
    raw = text.encode("utf-8", "surrogatepass")
    free = dict.fromkeys(KINDS, 0)
    found = []
    for last, (back, kind) in keywords.iter(raw.lower().decode("latin-1")):
        start = last - back
        if start < free[kind]:
            continue
        match = ANCHORED[kind].match(raw, start)
        if match:
            free[kind] = match.end()
            if _holds(kind, match):
                found.append((kind, start, match.end()))
    if len(raw) != len(text) and found:
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80  # bytes that begin a code point
        before = np.concatenate([[0], np.cumsum(lead)])
        found = [(k, int(before[a]), int(before[b])) for k, a, b in found]
    return found


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, ``base_sha256`` over the base spans and ``spans``, all spans as text.

    A NULL text counts as empty and has no spans; repeated rows are scanned each; an empty table gives no rows.
    """
    state: dict[str, ahocorasick.Automaton] = {}

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        keywords = state.setdefault("automaton", None) or automaton()
        state["automaton"] = keywords
        each = [find_secrets(t, keywords) for t in texts]
        base = [[s for s in spans if s[0] in BASE] for spans in each]
        out = {"doc_id": ids}
        for kind in BASE:
            out[f"n_{kind}"] = [sum(s[0] == kind for s in spans) for spans in base]
        out["base_sha256"] = [hashlib.sha256(span_list(KINDS, s).encode()).hexdigest() for s in base]
        out["spans"] = [span_list(KINDS, s) for s in each]
        return out

    return map_texts(docs, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
