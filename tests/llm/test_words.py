"""Spelling variants, the language model and conversation repair against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations, language_model, oracles, spelling

MESSAGES = "conv_id long, turn long, role string, text string, score double, code int, place string, gone string"


def near(a, b):
    return brute.edit_distance(a, b) == 1


def plain_variants(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(brute.ASCII_LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    partners = {w: [x for x in n if abs(len(w) - len(x)) < 2 and near(w, x)] for w in n}
    form = {}
    for w, found in partners.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(partners[w]), n[form[w]] if form[w] else None)
    return out


def spelled():
    """Families of words one edit apart, with edits at every place, and words of the shortest length."""
    pick, rows = random.Random(5), []
    for family in range(12):
        word = "".join(pick.choice("abcdeé") for _ in range(pick.randint(5, 9)))
        texts = [word] * pick.randint(6, 40)
        for _ in range(8):
            cut = list(word)
            at = pick.randrange(len(cut))
            kind = pick.randrange(3)
            if kind == 0:
                del cut[at]
            elif kind == 1:
                cut[at] = pick.choice("abcdeÉ")
            else:
                cut.insert(pick.choice([at, len(cut)]), pick.choice("abcde"))
            texts += ["".join(cut).upper() if pick.random() < 0.2 else "".join(cut)] * pick.randint(2, 7)
        pick.shuffle(texts)
        rows += [(100 * family + k, ", ".join(texts[k::3])) for k in range(3)]
    return [*rows, (5000, "fourfold " * 40 + "fourfolt " * 18 + "fourfort " * 6)]  # a form of a form


def test_variants_are_those_of_all_pairs(spark):
    rows = spelled() + [(r[0], r[1]) for r in brute.odd_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs, spelling.DAMAGE).collect()}
    want = plain_variants(rows)
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[1] != v[0] and v[0] for v in want.values())


def test_near_pairs_meet_once(spark):
    pick = random.Random(3)
    words = sorted({"".join(pick.choice("ab") for _ in range(pick.randint(5, 8))) for _ in range(150)})
    pairs = [(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()]
    want = {frozenset(p) for p in itertools.combinations(words, 2) if near(*p)}
    assert len(pairs) == len(want) > 100 and {frozenset(p) for p in pairs} == want


def test_roots_of_a_long_chain(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 40 else None) for i in range(41)]
    got = spelling.with_roots(spark.createDataFrame(rows, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {w: "w40" for w, _ in rows}


def test_variants_of_odd_and_empty_tables(spark):
    assert spelling.spelling_variants(brute.odd(spark)).count() > 0
    assert spelling.spelling_variants(brute.empty(spark), spelling.DAMAGE).count() == 0


def test_scores_sum_over_tokens(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 12)  # most words take the way over the join
    rows = [(r[0], r[1]) for r in brute.odd_rows()] + [(100 + i, brute.prose(i, 50) + " Rare" + str(i % 7)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    monkeypatch.setattr(language_model, "FREQUENT", 9)
    monkeypatch.setattr(language_model, "CLASSES", 1 + 9 + language_model.ENDINGS)
    model, counts = language_model.fit_model(docs.filter(~held))
    split = lambda t: [*brute.WORD.findall((t or "").translate(brute.ASCII_LOWER)), "\n"]
    seen = collections.Counter(w for i, t in rows if i is None or i % 3 != 1 for w in split(t))
    total, distinct = sum(seen.values()), len(seen)
    assert (model.n_tokens, model.n_distinct) == (total, distinct)
    frequent = [w for w, _ in sorted(((w, n) for w, n in seen.items() if w != "\n"), key=lambda x: (-x[1], x[0].encode()))[:9]]
    of = lambda w: 0 if w == "\n" else 1 + frequent.index(w) if w in frequent else language_model.ending_class(w.encode())
    sizes = collections.Counter({c: 1 for c in range(language_model.CLASSES)})
    for w, n in seen.items():
        sizes[of(w)] += n + 1
    table = model.log_probabilities()
    assert np.allclose((10.0**table).sum(axis=1), 1)

    def plain(text):
        score, before = 0.0, 0
        for w in split(text):
            score += table[before, of(w)] + (math.log10((seen[w] + 1) / sizes[of(w)]) if of(w) > 9 else 0)
            before = of(w)
        return len(split(text)), sum(seen[w] > 0 for w in split(text)), total, sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in split(text)), score

    want = collections.defaultdict(list)
    for i, t in rows:
        want[i].append(plain(t))
    got = language_model.score_texts(docs, model, counts).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(np.allclose([r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score], w, rtol=1e-9) for w in want[r.doc_id])


def test_pair_counts_and_words_cover_all_texts(spark):
    rows = [(i, brute.prose(i % 5, 30 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pairs = language_model.pair_counts(docs, [])
    assert pairs.sum() == sum(len(t.split()) + 1 for _, t in rows) and pairs[:, 0].sum() == pairs[0].sum() == 40
    counts = {r.word: r.n for r in language_model.word_counts(docs).collect()}
    assert counts == collections.Counter(w for _, t in rows for w in t.lower().split())


def test_vectors_follow_the_pairs():
    pick = np.random.default_rng(2)
    chain = pick.dirichlet(np.full(12, 0.3), 12)
    pairs = np.round(chain * 20_000)
    contexts, targets, bias = language_model.fit_vectors(pairs, dimensions=12)
    scores = contexts @ targets.T + bias
    fitted = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.abs(fitted - pairs / pairs.sum(axis=1, keepdims=True)).max() < 0.03
    assert not any(v.any() for v in language_model.fit_vectors(np.zeros((5, 5))))


def test_model_beats_single_words_on_held_out_texts(spark):
    pick, rows = random.Random(1), []
    after = {w: pick.sample(range(60), 3) for w in range(60)}
    for i in range(200):
        w, out = i % 60, []
        for _ in range(80):
            w = pick.choice(after[w])
            out.append(f"word{w}")
        rows.append((i, " ".join(out)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = language_model.score_texts(docs.filter("doc_id >= 150"), *language_model.fit_model(docs.filter("doc_id < 150")))
    total = scored.agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert total[1] > 0.45 * total[0] and total[1] / total[2] > -0.7  # a third of the next words is log10(3) = 0.48


def test_language_model_of_odd_and_empty_tables(spark):
    odd, empty = brute.odd(spark), brute.empty(spark)
    fitted = language_model.fit_model(odd)
    assert language_model.score_texts(empty, *fitted).count() == 0
    rows = language_model.score_texts(odd, *language_model.fit_model(empty)).collect()
    assert len(rows) == odd.count() and all(r.base_score == 0 and r.n_known == 0 and r.score < 0 for r in rows)


def plain_repair(rows):
    """Cheapest edits over the lattice, from the end, with whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append(1 if not shown else 2 if (role, text) in seen else 0 if shown[-1] in ".!?" else 3)
        seen.add((role, text))
    after = {"0u": 2, "su": 2, "ua": 3, "au": 2, "0s": 1}
    keep = lambda q, c: after.get("0sua"[q] + c)
    miss, name = [2, 2, 3, 2], {2: "user", 3: "assistant"}
    best = {0: (0, "", ()), 3: (0, "", ())}

    def inserts(best):
        for _ in range(4):
            for q in range(4):
                if miss[q] in best:
                    c, a, r = best[miss[q]]
                    best[q] = min(best.get(q, (1e9,)), (c + 2, "I" + a, (f"{name[miss[q]]}:", *r)))
        return best

    inserts(best)
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        now = {}
        for q in range(4):
            c, a, r = best[q]
            options = [(c + 3, "D" + a, r)]
            if fault not in (1, 2):
                more = fault == 3
                to = keep(q, role[:1])
                if to is not None:
                    c, a, r = best[to]
                    options.append((c + more, "K" + a, (f"{role}:{text}", *r)))
                c, a, r = best[miss[q]]
                options.append((c + 2 + more, "R" + a, (f"{name[miss[q]]}:{text}", *r)))
            now[q] = min(options)
        best = inserts(now)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, said = best[0]
    return gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, brute.sha("\n".join(said)), said


def talks():
    pick, rows = random.Random(6), []
    for conv in range(60):
        for turn in range(pick.choice([1, 2, 4, 7, 150 if conv % 20 == 0 else 3])):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]) if pick.random() < 0.5 else ["user", "assistant"][turn % 2]
            text = pick.choice(["Yes.", "No!", "Cut off", " \n", "", "Why? ", "so. ", "x" * (turn % 3) + "."])
            rows.append((conv, pick.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("block", [3, 64])
def test_repairs_are_the_cheapest(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = talks()
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.summarize_repairs(docs).collect()}
    by_conv = collections.defaultdict(list)
    for conv, *row in rows:
        by_conv[conv].append(row)
    want = {conv: plain_repair(r) for conv, r in by_conv.items()}
    assert got == {conv: w[:-1] for conv, w in want.items()}
    said = collections.defaultdict(dict)
    for r in conversations.repair_conversations(docs).collect():
        said[r.conv_id][r.place] = f"{r.role}:{r.text}"
    assert {c: tuple(said[c][k] for k in sorted(said[c])) for c in want} == {c: w[-1] for c, w in want.items()}
    assert {"I", "R", "D", "K"} <= set("".join(w[6] for w in want.values()))


def test_prices_meet_every_least_cost():
    pick = random.Random(8)
    for _ in range(200):
        codes = bytes(pick.choice([0, 1, 2, 3, 5, 6, 9, 10]) for _ in range(pick.randint(0, 6)))
        arcs = conversations.arcs_of(codes, conversations.AT_END)
        prices = [0] * (len(arcs) + 1)
        for q in range(4):
            conversations.auction(arcs, prices, q)
        least = [math.inf] * len(arcs) + [0]
        for _ in range(len(arcs)):
            least = [min((c + least[to] for to, c, _ in here), default=math.inf) for here in arcs] + [0]
        assert prices[:4] == least[:4]
        assert all(prices[n] <= c + prices[to] for n, here in enumerate(arcs) for to, c, _ in here)


def odd_talks():
    rows = [(1, None, None, None), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 0, "assistant", "Yes"), (None, 5, "user", "A."), (None, 5, "user", "A."), (2, 1, "system", "x" * 50_000), (2, 9, "user", "ü? \t"), (3, 0, "user", "a."), (3, None, "user", None)]
    rows += [(4, t, "uasu"[t % 4], None if t % 3 else "Same.") for t in range(90)]
    return [(*r, 0.5, 7, "p", "g") for r in rows]


def test_repair_of_odd_and_empty_tables(spark):
    docs = spark.createDataFrame(odd_talks(), MESSAGES)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.summarize_repairs(docs).collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text, *_ in odd_talks():
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {c: plain_repair(r)[:-1] for c, r in by_conv.items()}
    assert conversations.summarize_repairs(spark.createDataFrame([], MESSAGES)).count() == 0
    assert conversations.repair_conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_damage_and_repair_equal_sql(spark, tmp_path):
    """On rows with NULLs, repeated turns and conversations of which nothing is left."""
    rows = [r[:4] for r in odd_talks()] + talks() + [(c, 1, "user", "Only.") for c in range(1000, 1100)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conversations.summarize_repairs(conversations.damaged(docs), gone=F.col("gone"))
    docs.write.parquet(str(tmp_path / "t"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/t/*.parquet'")
    cursor = db.execute(oracles.conversation_repair())
    names = [d[0] for d in cursor.description]
    want = [dict(zip(names, r)) for r in cursor.fetchall()]
    key = lambda r: str(r["conv_id"])
    assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(want, key=key)
    empty = [r for r in want if r["audit"] == "" and r["cost"] == 0]
    assert empty and all(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
