"""DuckDB SQL for the operators whose result SQL can say."""

from __future__ import annotations


def crc32(value: str) -> str:
    """SQL for the CRC-32 of a string's UTF-8 bytes. The query needs the table ``crc_table (t)``, see ``CRC_TABLE``."""
    code = "list_transform(range(1, octet_length(encode({0})) + 1), lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::UBIGINT)".format(value)
    step = "xor(t[(xor(c, b) & 255)::INT + 1], c >> 8)"
    return f"xor(list_reduce({code}, lambda c, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


#: The 256 remainders, worked out bit by bit.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, n::UBIGINT)) AS t)"""


def _edit(cost: str, letter: str, at: int, said: str | None = None) -> str:
    """The struct of an edit followed by the best from state ``at`` (1 to 4) on."""
    rest = f"list_prepend({said}, s[{at}].r)" if said else f"s[{at}].r"
    return f"{{c: s[{at}].c + {cost}, a: '{letter}' || s[{at}].a, r: {rest}}}"


def _row_choices(state: int) -> str:
    """All edits of the row in a state: delete, keep where the pattern allows, give the role that is missing."""
    kept = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}[state]
    missing, name = {1: 3, 2: 3, 3: 4, 4: 3}[state], {1: "user", 2: "user", 3: "assistant", 4: "user"}[state]
    cut, message = "(fault = 3)::BIGINT", "role || ':' || text"
    keep = "".join(f" WHEN initial = '{i}' THEN [{_edit(cut, 'K', to, message)}]" for i, to in kept.items())
    rerole = _edit(f"2 + {cut}", "R", missing, f"'{name}:' || text")
    return f"list_sort(list_concat([{_edit('3', 'D', state)}], CASE WHEN fault IN (1, 2) THEN [] ELSE list_concat([{rerole}], CASE{keep} ELSE [] END) END))[1]"


def _with_inserts(state: int) -> str:
    """The best of the row's edits with no, one or two rows inserted before; more never pay."""
    one = {1: (3, "user:"), 2: (3, "user:"), 3: (4, "assistant:"), 4: (3, "user:")}
    at, first = one[state]
    then, second = one[at]
    return (f"list_sort([s[{state}], {{c: s[{at}].c + 2, a: 'I' || s[{at}].a, r: list_prepend('{first}', s[{at}].r)}}, "
            f"{{c: s[{then}].c + 4, a: 'II' || s[{then}].a, r: list_concat(['{first}', '{second}'], s[{then}].r)}}])[1]")


def conversation_repair() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    none = "[]::VARCHAR[]"
    end = (f"[{{c: 0::BIGINT, a: '', r: {none}}}, {{c: 4::BIGINT, a: 'II', r: ['user:', 'assistant:']}}, "
           f"{{c: 2::BIGINT, a: 'I', r: ['assistant:']}}, {{c: 0::BIGINT, a: '', r: {none}}}]")
    return f"""
WITH RECURSIVE {CRC_TABLE},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (SELECT conv_id, turn, role, text, {crc32('name')} % 20 AS kind FROM named, crc_table),
changed AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds),
seen AS (SELECT *, rtrim(text, {blanks}) AS shown, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM changed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM seen),
judged AS (SELECT *, CASE WHEN shown = '' THEN 1 WHEN again THEN 2 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, left(role, 1) AS initial FROM placed),
ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
steps AS (SELECT c, n - place + 1 AS k, n, role, text, fault, initial FROM judged JOIN ids ON judged.conv_id IS NOT DISTINCT FROM ids.conv_id),
walk AS (
    SELECT c, 0::BIGINT AS k, {end} AS s FROM ids
    UNION ALL
    SELECT c, k, [{', '.join(map(_with_inserts, (1, 2, 3, 4)))}] FROM (
        SELECT walk.c, steps.k, [{', '.join(map(_row_choices, (1, 2, 3, 4)))}] AS s FROM walk JOIN steps ON steps.c = walk.c AND steps.k = walk.k + 1) AS chosen
),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (coalesce(before || initial, 'su') NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM judged) GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, s[1].c AS cost, s[1].a AS audit, sha256(array_to_string(s[1].r, chr(10))) AS repaired_sha256
FROM ids JOIN (SELECT c, arg_max(s, k) AS s FROM walk GROUP BY c) AS best ON best.c = ids.c LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def spelling_variants() -> str:
    """Near words by the text that is left when one character is taken out; no edit distance is used."""
    return f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
tallied AS (SELECT name, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, times, {crc32("name || ':' || run")} AS h FROM tallied, crc_table),
words AS (SELECT word, sum(times)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
near AS (
    SELECT x.word, y.word AS near, y.n AS near_n FROM cuts AS x JOIN cuts AS y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM cuts AS x JOIN words AS y ON x.rest = y.word
    UNION SELECT y.word, x.word, x.n FROM cuts AS x JOIN words AS y ON x.rest = y.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS reached, form AS next, 0 AS steps FROM formed UNION ALL SELECT chain.word, formed.word, formed.form, steps + 1 FROM chain JOIN formed ON chain.next = formed.word)
SELECT formed.word, form, reached AS root, n, n_near, form_n FROM formed JOIN chain ON chain.word = formed.word WHERE chain.next IS NULL
"""
