"""Line dedup, Jaccard join, packing, the two fields and the pipeline on small tables."""

import collections
import itertools
import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import crf, jaccard, line_dedup, linking, packing, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def near_copies():
    """Families of copies at many distances, and unrelated texts that share a passage."""
    pick, rows = random.Random(11), []
    shared = brute.prose(900, 60)
    for family in range(6):
        words = brute.prose(100 + family, 90).split()
        for copy in range(14):
            changed = list(words)
            for _ in range(copy // 2):
                changed[pick.randrange(len(changed))] = f"w{pick.random()}"
            rows.append(" ".join(changed))
    rows += [brute.prose(300 + i, 40) + " " + shared for i in range(30)]
    rows += [f"{a} {b}" for a in ("red", "Blue") for b in ("one", "two")] * 2
    return [(1000 - i, t) for i, t in enumerate(rows)]


def test_components_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 4)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    rows = near_copies() + [(r[0], r[1]) for r in brute.odd_rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.jaccard_components(docs).collect()}
    want = brute.components(dict(rows))
    assert got == {i: (want[i], len(brute.shingle_set(t))) for i, t in rows}
    assert len(set(want.values())) < len(want) - 40


def test_frequent_shingles_change_no_link(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "frequent", lambda docs: np.zeros(0, np.uint64))
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == brute.components(dict(rows))


def test_tree_finds_every_pair_within_the_bound():
    pick = np.random.default_rng(4)
    p = pick.poisson(3, (200, 12))
    got = {tuple(x) for x in jaccard.tree_pairs(p, p, lambda i, j: i != j)}
    low = np.minimum(p[:, None], p[None]).sum(axis=2)
    both = p.sum(axis=1)[:, None] + p.sum(axis=1)[None]
    assert got == {(i, j) for i, j in itertools.product(range(200), repeat=2) if i != j and 175 * low[i, j] >= 75 * both[i, j]}


def test_linked_sets_share_that_many_first_shingles():
    pick = random.Random(9)
    for _ in range(3000):
        n, m = pick.randint(1, 60), pick.randint(1, 60)
        both = pick.randint(0, min(n, m))
        order = pick.sample(range(500), n + m - both)
        x, y = sorted(order[:n]), sorted(order[n - both :])
        if 100 * both >= 75 * (n + m - both):
            first = [set(s[: len(s) - jaccard.needed(len(s)) + 1]) for s in (x, y)]
            assert len(first[0] & first[1]) >= jaccard.least_shared(np.array([n]), np.array([m]))[0]


def test_jaccard_on_odd_and_empty_tables(spark):
    odd = brute.odd(spark)
    assert jaccard.jaccard_components(odd).count() == odd.count()
    kept = jaccard.keep_one_each(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and len(ids) == len(set(ids)) and None in ids and 10 in ids and 11 not in ids
    assert jaccard.jaccard_components(brute.empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)]
    random.Random(2).shuffle(edges)
    got = {r.id: r.root for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100}


def line_groups(rows):
    """Removed lines by the edit similarity of every pair of lines of five words; shorter lines go by their normal form. ASCII texts only."""
    where = collections.defaultdict(list)
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            w = line_dedup.normal_words(line)
            if i is not None and w:
                where[" ".join(w)].append((i, k))
    keys = list(where)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    db = duckdb.connect()
    long = [(k, key) for k, key in enumerate(keys) if key.count(" ") >= line_dedup.MIN_WORDS - 1]
    db.execute("CREATE TABLE t AS SELECT unnest(?) AS k, unnest(?) AS body", [[k for k, _ in long], [b for _, b in long]])
    alike = f"levenshtein(a.body, b.body) <= floor(greatest(length(a.body), length(b.body)) * {1 - line_dedup.SIMILARITY} + 1e-9)"
    for a, b in db.execute(f"SELECT a.k, b.k FROM t AS a JOIN t AS b ON a.k < b.k WHERE {alike}").fetchall():
        root[find(a)] = find(b)
    groups = collections.defaultdict(set)
    for k, key in enumerate(keys):
        groups[find(k)].update(where[key])
    return {place for g in groups.values() for place in sorted(g)[1:]}


def test_removed_lines(spark):
    pick, rows = random.Random(7), []
    for i in range(60):
        base = brute.prose(400 + i % 9, 40).replace("\n", " ").split()
        for _ in range(i % 4):
            base[pick.randrange(len(base))] = "changed"
        rows.append((i, f"A short one\n{' '.join(base)}\n\nLine number {i} of the very same kind here\n{brute.prose(600 + i, 20)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()}
    assert got == line_groups(rows) and len(got) > 60
    cut = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs).collect()}
    for i, t in rows:
        lines = t.split("\n")
        gone = sorted(k for d, k in got if d == i)
        assert cut[i] == ("\n".join(line for k, line in enumerate(lines) if k not in gone), gone)


def test_lines_of_odd_and_empty_tables(spark):
    odd = brute.odd(spark)
    cut = line_dedup.dedup_lines(odd)
    assert cut.columns == [*odd.columns, "lines_removed"] and cut.count() == odd.count()
    text = {r.doc_id: r.text for r in cut.collect()}
    assert text[16] is None and text[17] == "" and text[18] == " \n\t "
    assert line_dedup.dedup_lines(brute.empty(spark)).count() == 0


def test_edit_similarity_is_levenshtein():
    pick = random.Random(1)
    for _ in range(400):
        a = "".join(pick.choice("abc ") for _ in range(pick.randint(0, 25)))
        b = list(a)
        for _ in range(pick.randint(0, 5)):
            b.insert(pick.randint(0, len(b)), "x") if pick.random() < 0.5 else b and b.pop(pick.randrange(len(b)))
        b = "".join(b)
        assert line_dedup.edit_similarity(a, b, 0.85) == (brute.edit_distance(a, b) <= int(max(len(a), len(b)) * 0.15 + 1e-9))


ODD_SPACES = ["a  b", "a   b", " a", "a ", "a  ", "a\n b", "a \nb", "a\n \nb", "\n\n", "  \n x", " ", "", "x  y", " \t y", "<|endoftext|> hi", "don't  'S", "a\x1cb \x1f c", "é ²³ Ⅷ", " 12 34,5", "a\r\n b  \n", "  a  ", "  b"]


def reference_ids(text):
    if not hasattr(reference_ids, "found"):
        reference_ids.found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        reference_ids.found.encode_special_tokens = True
    return [*reference_ids.found.encode(text, add_special_tokens=False).ids, 0]


def test_pieces_and_sequences(spark):
    docs = brute.odd(spark).unionByName(spark.createDataFrame(list(enumerate(ODD_SPACES, 200)), "doc_id long, text string"), allowMissingColumns=True)
    packed = packing.pack(docs)
    rows = packed.collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc in docs.collect():
        ids = reference_ids(doc.text or "")
        mine = sorted(by_doc[doc.doc_id], key=lambda r: r.piece)[:: 2 if doc.doc_id == 13 else 1]  # this row is there twice
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert np.frombuffer(b"".join(bytes(r.ids) for r in mine), "<u4").tolist() == ids
        assert [r.length for r in mine[1:]] == [packing.CAPACITY] * (len(mine) - 1)
        assert [r.start for r in mine] == list(itertools.accumulate([0] + [r.length for r in mine[:-1]]))
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(itertools.accumulate([0] + [r.length for r in parts[:-1]]))
        assert sum(r.length for r in parts) <= packing.CAPACITY
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert joined == {i: b"".join(bytes(r.ids) for r in parts) for i, parts in by_sequence.items()}
    assert packing.pack(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_in_few_sequences(seed):
    pick = random.Random(seed)
    counts = {pick.randint(1, 2048): pick.randint(1, 10 ** (seed % 4)) for _ in range(60 * (seed + 1))}
    plan = packing.plan_sequences(counts)
    assert not any(plan.left.values())
    filled = collections.Counter()
    for size, rank, per, base, offset, n in plan.rows:
        for i in range(n):
            assert filled[base + i] == offset
            filled[base + i] += size * per
    assert max(filled.values()) <= 2048 and len(filled) == plan.total
    least = max(-(-sum(s * n for s, n in counts.items()) // 2048), sum(n for s, n in counts.items() if s > 1024))
    assert plan.total <= 1.06 * least + 1


def test_marginals_by_enumeration():
    pick = np.random.default_rng(0)
    first = np.array([1, 0, 0, 1, 1, 0, 0, 0, 1], bool)
    emit, chain = pick.normal(size=9), crf.Chain(pick.normal(size=(2, 2)), pick.normal(size=2))
    p, moved, begun = crf.marginals(emit, first, chain, pairs=True)
    total, on, pairs, starts = 0.0, np.zeros(9), np.zeros((2, 2)), np.zeros(2)
    for y in itertools.product((0, 1), repeat=9):
        w = np.exp(sum(emit[i] * y[i] + (chain.start[y[i]] if first[i] else chain.trans[y[i - 1], y[i]]) for i in range(9)))
        total += w
        on += w * np.array(y)
        for i in range(9):
            if first[i]:
                starts[y[i]] += w
            else:
                pairs[y[i - 1], y[i]] += w
    assert np.allclose(p, on / total) and np.allclose(moved, pairs / total) and np.allclose(begun, starts / total)


def test_marginals_of_a_long_stream_equal_those_of_its_sequences():
    pick = np.random.default_rng(1)
    sizes = [1, 700, 3, 129, 64]
    emit, chain = pick.normal(size=sum(sizes)) * 5, crf.Chain(pick.normal(size=(2, 2)), pick.normal(size=2))
    first = np.zeros(sum(sizes), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    each = [crf.marginals(e, np.arange(len(e)) == 0, chain) for e in np.split(emit, np.cumsum(sizes)[:-1])]
    assert np.allclose(crf.marginals(emit, first, chain), np.concatenate(each))


def labelled(spark):
    rows, labels = [], []
    for i in range(240):
        bad, toxic = i % 4 == 0, i % 5 == 0
        words = brute.prose(2000 + i, 40)
        if toxic:
            words = words.replace(".", " you vile gronk.")
        rows.append((i, "\n".join(" | ".join(line.upper().split()) + " ###" for line in words.split("\n")) if bad else words))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def accuracy(scored, labels, column, folds, held_out):
    rows = scored.join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out).collect()
    return sum((r.score >= 0.5) == bool(r[column]) for r in rows) / len(rows)


def test_quality_field_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    model = quality.fit_quality(docs, labels)
    assert accuracy(quality.score_quality(docs, model), labels, "quality", quality.FOLDS, quality.HELD_OUT) > 0.95
    odd = brute.odd(spark)
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality.fit_quality(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}
    assert quality.score_quality(brute.empty(spark), model).count() == 0


def test_toxicity_field_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels.unionByName(spark.createDataFrame([(5000, None, None)], LABELS)))
    scored = toxicity.score_toxicity(docs, model)
    assert accuracy(scored, labels, "toxic", toxicity.FOLDS, toxicity.HELD_OUT) > 0.95
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = [texts[r.doc_id][s.start : s.stop].lower() for r in scored.collect() for s in r.spans]
    assert spans and all("vile" in s or "gronk" in s for s in spans)
    odd = brute.odd(spark)
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.drop_toxic(docs, model, 0.5)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.collect() if r.score < 0.5}
    assert toxicity.drop_toxic(odd, model, 0.5).columns == odd.columns
    none = toxicity.fit_toxicity(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.score_toxicity(odd, none).collect()} == {0.5}
    assert toxicity.score_toxicity(brute.empty(spark), model).count() == 0


def test_spans_where_lower_case_is_longer():
    hit = np.array([False, False, True])  # "i" with a dot apart, twice
    assert toxicity._spans("İİ Vile", hit) == [{"start": 3, "stop": 7}]


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input, held against a plain version of its decision."""
    docs, labels = labelled(spark)
    item = brute.prose(7000, 30)
    more = [(900, brute.prose(7001, 80)), (901, brute.prose(7001, 80) + " more"), (902, item + "\n" + brute.prose(7002, 50)), (903, None), (904, "")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string")).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in now.collect()}
        now = linking.cut_lineage(stage(spark, now, str(tmp_path)))
        if name != "best_fit_packing":
            assert now.columns == docs.columns
        seen[name] = (before, now.collect())
    before, after = seen["toxicity"]
    assert sum("gronk" in (t or "").lower() for t in before.values()) == 48 and not any("gronk" in (r.text or "").lower() for r in after)
    before, after = seen["line_dedup"]
    gone = line_groups(sorted(before.items()))
    for r in after:
        lines = (before[r.doc_id] or "").split("\n")
        left = "\n".join(line for k, line in enumerate(lines) if (r.doc_id, k) not in gone)
        assert (r.text or "") == left and (r.text is None or r.n_chars == len(left))
    assert 903 in {r.doc_id for r in after} and 904 in {r.doc_id for r in after}
    before, after = seen["jaccard_join"]
    assert {r.doc_id for r in after} == {i for i, root in brute.components(before).items() if i == root}
    before, after = seen["decontamination"]
    assert {r.doc_id for r in after} == set(before) - {902}
    before, after = seen["best_fit_packing"]
    assert {r.doc_id for r in after} == set(before)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(after)


def test_lines_with_replaced_words_meet_whatever_their_length(spark):
    """Copies against edit similarity alone, over all pairs; most are more than 3 bits of a SimHash apart."""
    pick, rows = random.Random(21), []
    for i in range(60):
        words = brute.prose(3000 + i, (6, 10, 20, 26, 40, 100)[i % 6]).replace("\n", " ").split()
        rows.append((2 * i, " ".join(words)))
        for _ in range(max(1, len(words) // 20)):
            words[pick.randrange(len(words))] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    plain = {i: " ".join(line_dedup.normal_words(t)) for i, t in rows}
    alike = [(a, b) for a, b in itertools.combinations(plain, 2) if abs(len(plain[a]) - len(plain[b])) < 20 and a // 2 == b // 2]
    want = {(b, 0) for a, b in alike if brute.edit_distance(plain[a], plain[b]) <= int(max(len(plain[a]), len(plain[b])) * 0.15 + 1e-9)}
    bits = line_dedup.simhashes([plain[i].split() for i in plain], line_dedup.WordBits())
    assert len(want) > 40 and sum(int(bits[b] ^ bits[b - 1]).bit_count() > 3 for b, _ in want) > 25
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()} == want


def test_short_lines_go_when_their_form_is_the_same(spark):
    rows = [(1, "Read more\nPage 1 of 20\n---\non the moon"), (2, "read  MORE!\nPage 3 of 41\n---\non the noon"), (3, "Read more\nall of it\non the moon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()} == {(2, 0), (2, 1), (3, 0), (3, 2)}


def test_letter_counts_keep_every_similar_pair(spark):
    pick, pairs = random.Random(8), []
    for i in range(300):
        a = " ".join(line_dedup.normal_words(brute.prose(5000 + i % 40, pick.randint(5, 200)))) + "é漢" * (i % 3) + "a" * (i % 5 * 60)
        b = list(a)
        for _ in range(pick.randint(0, int(len(a) * 0.2))):
            b[pick.randrange(len(b))] = pick.choice("abc é")
        pairs.append((a, "".join(b) if i % 4 else brute.prose(i, 40)))
    sides = [np.concatenate([np.array([[len(x) for x in side]]).T, line_dedup.letter_counts(list(side))], axis=1) for side in zip(*pairs)]
    rows = [(i, *map(int, x), *map(int, y)) for i, (x, y) in enumerate(zip(*sides))]
    names = ["i", *(f"{c}_{s}" for s in "ab" for c in ["size", *line_dedup.COUNTS])]
    kept = {r.i for r in spark.createDataFrame(rows, names).filter(line_dedup.close_counts("a", "b")).collect()}
    alike = {i for i, (a, b) in enumerate(pairs) if line_dedup.edit_similarity(a, b, 0.85)}
    classes = [[collections.Counter(c if c in "abcdefghijklmnopqrstuvwxyz " else "?" for c in x) for x in p] for p in pairs]
    capped = [[{k: min(n, 127) for k, n in c.items()} for c in p] for p in classes]
    more = lambda x, y: sum(max(n - y.get(k, 0), 0) for k, n in x.items())
    want = {i for i, ((a, b), (x, y)) in enumerate(zip(pairs, capped)) if max(more(x, y), more(y, x)) <= max(len(a), len(b)) * (1 - 0.85) + 1e-9}
    assert kept == want and alike <= kept and len(alike) > 100 and len(kept) < 290


def test_a_pair_of_several_shared_kinds_is_found_once():
    counts = np.zeros((2, jaccard.GROUPS), np.int32)
    counts[:, :20] = 1

    def rows(carried):
        cells = [(key, side, i) for key in (5, 9) for side, i in ((0, 0), (0, 1), (1, 0), (1, 1))]
        columns = {"key": [c[0] for c in cells], "side": [c[1] for c in cells], "id": [c[2] for c in cells], "root": [c[2] for c in cells], "apart": [True] * 8, "weight": [2] * 8}
        lists = {"counts": [counts[c[2]].tolist() for c in cells], "keys": [carried] * 8, "weights": [[2] * len(carried)] * 8}
        return pa.table(columns | lists)

    need = int(jaccard.least_shared(np.array([20]), np.array([20]))[0])
    found = lambda carried: jaccard._search_cells(rows(carried), np.array([0, 4, 8]), 75).to_pylist()
    assert found([5, 9, 11]) == [{"a": 0, "b": 1, "least": need, "weight": 6}]
    assert need > 2 and found([5]) == []
    assert found([]) == [{"a": 0, "b": 1, "least": need, "weight": 2}] * 2


def test_shared_kinds():
    pick = random.Random(3)
    lists = [sorted(pick.sample(range(-9, 9), pick.randint(1, 9))) for _ in range(12)]
    weight = {k: pick.randint(1, 4) for k in range(-9, 9)}
    left, right = np.array([(i, j) for i in range(12) for j in range(12)]).T
    total, least = jaccard.shared_kinds(left, right, np.concatenate(lists), np.array([weight[k] for x in lists for k in x]), np.array([len(x) for x in lists]))
    for i, j, t, k in zip(left, right, total, least):
        both = set(lists[i]) & set(lists[j])
        assert t == sum(weight[b] for b in both) and (not both or k == min(both))


def test_words_are_hashed_the_same_in_any_block():
    texts = ["", " \t", "One two\x0bTWO  three", "é" * 40 + "a " + "é" * 40 + "b", "x", "ünï x\x1cy one", "a" * 64 + "bc", "a" * 64 + "cb"]
    alone = [jaccard.word_hashes([t])[0].tolist() for t in texts]
    assert [w.tolist() for w in jaccard.word_hashes(texts)] == alone
    known = {}
    for t, hashes in zip(texts, alone):
        words = t.encode().lower().split()
        assert len(words) == len(hashes)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes))
    assert len(set(known.values())) == len(known)


def test_further_hubs_and_none_give_the_same_components(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.components(dict(rows))
    for few, carried in ((1, 0), (1000, 2)):
        monkeypatch.setattr(linking, "FEW_GROUPS", few)
        monkeypatch.setattr(jaccard, "CARRIED", carried)
        assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == want


def test_unlike_lines_are_told_apart_by_pairs_of_characters(monkeypatch):
    pick = random.Random(12)
    for i in range(300):
        a = brute.prose(7000 + i, 12)
        b = list(a) if i % 3 else list(brute.prose(8000 + i, 12))
        for _ in range(pick.randint(0, 16)):
            b[pick.randrange(len(b))] = pick.choice("abé漢 ")
        b, distance = "".join(b), brute.edit_distance(a, "".join(b))
        assert line_dedup.pairs_allow(a, b, distance)
        assert line_dedup.edit_similarity(a, b, 0.85) == (distance <= int(max(len(a), len(b)) * 0.15 + 1e-9))
    assert not line_dedup.pairs_allow(brute.prose(1, 40), brute.prose(2, 40), 10)


def test_normal_words_of_any_script():
    pick = random.Random(13)
    letters = "aBcÉÿß_09²µ\xa0\x85\x1c\t\r.-  漢Σςİ٣ĞΑ"
    for _ in range(400):
        text = "\n".join("".join(pick.choices(letters[: pick.choice([18, len(letters)])], k=pick.randint(0, 12))) for _ in range(4))
        assert line_dedup.normal_lines(text) == [line_dedup.normal_words(line) for line in text.split("\n")]


def test_a_wanted_line_is_taken_from_its_place_alone(monkeypatch):
    looked = []
    monkeypatch.setattr(line_dedup, "normal_lines", lambda text, real=line_dedup.normal_lines: looked.append(text) or real(text))
    keys = [int(np.uint64(line_dedup.key_of(w)).view(np.int64)) for w in (["one", "two"], ["six"])]
    batch = pa.RecordBatch.from_arrays([pa.array([[1, 2], [1]]), pa.array([keys, keys[:1]]), pa.array(["zero\nOne two\nsix\nend", "other row"])], names=["line", "id", "text"])
    assert [r for out in line_dedup._pick([batch]) for r in out.to_pylist()] == [{"id": keys[0], "body": "one two"}, {"id": keys[1], "body": "six"}]
    assert looked == ["One two\nsix", ""]


def test_linked_sets_share_more_with_extra_first_shingles():
    pick = random.Random(10)
    for _ in range(2000):
        n, m = pick.randint(60, 300), pick.randint(60, 300)
        both = min(n, m) - pick.randint(0, min(n, m) // 4)
        order = pick.sample(range(2000), n + m - both)
        x, y = sorted(order[:n]), sorted(order[n - both :])
        if 100 * both >= 75 * (n + m - both):
            first = [set(s[: len(s) - int(jaccard.behind(len(s))) + 1]) for s in (x, y)]
            least = jaccard.least_shared(np.array([n]), np.array([m]), tail=jaccard.behind)[0]
            assert len(first[0] & first[1]) >= least > n // jaccard.EXTRA or m < n


def test_sets_that_share_little_by_chance_reach_no_pairing(spark, monkeypatch):
    """Every text shares five words in a row with each of a few others, which no link can come from."""
    passage = [brute.prose(9000 + i, 8) for i in range(40)]
    rows = [(i, f"{brute.prose(9100 + i, 200)} {passage[i % 40]} {brute.prose(9400 + i, 200)}") for i in range(200)] + [(200, brute.prose(9050, 200))] * 2
    rows += [(300 + i, brute.prose(9900, 300) + " " + brute.prose(9901 + i, 10)) for i in range(3)]
    seen, real = [], linking._kinds
    monkeypatch.setattr(linking, "_kinds", lambda r: seen.append(r.select("id").distinct().collect()) or real(r))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute.components(dict(rows))
    assert {r.id for r in seen[0]} <= {200, 300, 301, 302}


def test_lines_with_other_letters_are_not_even_paired(spark, monkeypatch):
    """Lines of one length that begin with the same words: their letters tell them apart before a pair is formed."""
    rows = [(i, " ".join(["alpha beta gamma", *(chr(97 + (i + k) % 26) * 8 for k in range(3))])) for i in range(0, 24, 3)]
    rows.append((100, rows[0][1][:-1] + "x"))
    seen, real = [], line_dedup.verifier
    monkeypatch.setattr(line_dedup, "verifier", lambda docs, lines: lambda pairs: seen.append(pairs.count()) or real(docs, lines)(pairs))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()} == {(100, 0)}
    assert sum(seen) == 1
