"""Plain versions of the contracts, and small tables with odd rows."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key long, id long, n long, root long, spans string"


def prose(seed: int, n: int) -> str:
    """Words that depend on the seed alone."""
    parts = ["ther", "ing", "an", "lo", "mi", "re", "st", "ou", "ba", "ke", "du", "vi"]
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(parts[x % 12] + parts[x // 12 % 12] + parts[x // 144 % 12])
        if i % 12 == 11:
            out[-1] += ".\n" if i % 24 == 23 else "."
    return " ".join(out).replace("\n ", "\n")


def odd_rows() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        base,
        base,
        base.upper(),
        base.replace("ther", "thar", 1),
        base + " " + prose(2, 8),
        base + " " + prose(3, 60),
        None,
        "",
        " \n\t ",
        "one two three",
        "One  two\tthree",
        "çé ßü 漢字 𝒳𝒴 " + prose(4, 40),
        prose(5, 60) + "\n" + prose(5, 60),
        "word " * 400,
        prose(6, 20_000),
        "x" * 70_000,
        "1 2 3 4 5 6 7 8 9 0 " * 2000,
    ]
    rows = [(i, t, "en", "src0", len(t or ""), 0.5, 1, 2, 3, 4, "s") for i, t in enumerate(texts, 10)]
    rows.append(rows[3])  # the same row again
    rows.append((None, prose(8, 30), None, None, None, None, None, None, None, None, None))
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(texts: dict) -> dict:
    """Smallest id reachable by links, over all pairs."""
    sets, root = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in texts}


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered), failed


SECRETS = {
    "assign": re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def secret_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if {"assign": lambda: len(m[2]) >= 12, "access": lambda: len(m[0]) >= 18, "hex": lambda: len(m[0]) >= 16}[kind]():
                found.append((m.start(), place, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                found.append((m.start(), place, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def sha(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def best_occurrence(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def base62_checksum(body: str) -> str:
    """Six base-62 digits of the CRC-32, found from its value by hand."""
    import zlib

    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value = zlib.crc32(body.encode())
    return "".join(digits[value // 62**k % 62] for k in range(5, -1, -1))
