"""N-gram Jaccard self-join over count-vector R-trees.

A document's set holds its distinct 5-word shingles, hashed to 64 bits. The hashes fall into ``GROUPS`` groups; the counts per group are the document's
point. The overlap of two sets is at most the sum of the coordinate-wise minima of their points, and for an R-tree node at most that of the
point and the node's upper corner, so nodes and points that cannot reach the overlap a link needs are passed over.

One tree over everything prunes nothing between unrelated texts (their points lie close together), so there is a forest: documents meet in a tree only if they share
a shingle among the first ``n - ceil(0.75 n) + 1`` of a fixed order, which no linked pair can avoid. A few more are taken, so that linked sets share several, and sets
that share fewer with all others together are left out early. The order puts shingles
that many documents have last; which those are is estimated from local counts, and only changes how much work there is, not what is linked.
Equal sets are one item. Large groups are joined through hubs first (see ``linking``), and trees are cut into cells of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts
from tidemark.llm.linking import find_components, meeting
from tidemark.session import cut_lineage, discard, settle

WIDTH = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75
GROUPS = 64
#: A shingle counts as frequent from so many sightings on, in blocks of COUNTED_CHARS that have it SEEN_LOCALLY times; the list is cut at
#: HOT_SHINGLES, the most frequent first. Links do not depend on it.
SEEN_OFTEN, SEEN_LOCALLY, COUNTED_CHARS = 16, 3, 12_000_000
HOT_SHINGLES = 250_000
#: Points per leaf, and per cell of a key.
LEAF = 32
CELL = 2048
#: Hubs tried per key before trees are searched.
HUBS = 5
#: Kinds of keys that a row carries at most.
CARRIED = 64
#: One in so many shingles is taken on top of the first ones that a link needs.
EXTRA = 40
MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


#: Hashes of words are sums of a number for each byte times a number for its place, so that all words of a block are hashed side by side; a word of more
#: than PLACES bytes is hashed by itself.
PLACES = 64
BYTES = np.array([xxhash.xxh64_intdigest(b"byte %d" % i) for i in range(256)], np.uint64)
PLACE = np.array([xxhash.xxh64_intdigest(b"place %d" % i) | 1 for i in range(PLACES)], np.uint64)
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Characters whose words are hashed at once.
HASHED_CHARS = 250_000


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """64-bit hashes of the words of every text. Words are split at ASCII white space, and only A-Z become lower-case."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    whole = b" ".join(parts).lower()
    solid = ~IS_SPACE[np.frombuffer(whole, np.uint8)]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    begin, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(begin):
        return [np.zeros(0, np.uint64) for _ in texts]
    first = np.cumsum(sizes) - sizes
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    words = np.add.reduceat(BYTES[np.frombuffer(whole, np.uint8)[solid]] * PLACE[np.minimum(place, PLACES - 1)], first)
    for k in np.flatnonzero(sizes > PLACES):
        words[k] = xxhash.xxh64_intdigest(whole[begin[k] : begin[k] + sizes[k]])
    words ^= words >> np.uint64(32)
    words *= np.uint64(MIX[2])
    ends = np.cumsum([len(p) + 1 for p in parts])
    return np.split(words, np.searchsorted(begin, ends[:-1]))


def shingles(w: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, from the hashes of its words."""
    if not len(w):
        return np.zeros(0, np.uint64)
    k = min(width, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out += w[i : len(w) - k + 1 + i] * np.uint64(MIX[i])
    out ^= out >> np.uint64(31)
    out *= np.uint64(MIX[1])
    out ^= out >> np.uint64(29)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """``shingles`` of every text, ``HASHED_CHARS`` at once or one text that has more."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > HASHED_CHARS:
            yield from map(shingles, word_hashes(texts[begin:i]))
            begin, size = i, 0
        size += len(t)
    if texts:
        yield from map(shingles, word_hashes(texts[begin:]))


def needed(n: int, percent: int = PERCENT) -> int:
    """The least overlap that a set of ``n`` has with any linked set."""
    return -(-n * percent // 100)


def behind(n, percent: int = PERCENT):
    """How many shingles of a set of ``n`` are behind its first ones, and one more: ``needed`` less the extra ones, for numbers, arrays or columns."""
    if isinstance(n, Column):
        return F.greatest(F.lit(1), F.ceil(percent * n / 100) - F.floor(n / EXTRA))
    return np.maximum(1, -(-n * percent // 100) - n // EXTRA)


def frequent(docs: DataFrame) -> np.ndarray:
    """Shingles that many documents have, as far as blocks of texts show it: those seen several times in a block are added up."""

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        found, times = np.unique(np.concatenate(list(shingle_sets(texts))), return_counts=True)
        often = times >= SEEN_LOCALLY
        return {"shingle": found[often].view(np.int64), "times": times[often]}

    seen = map_texts(docs, run, "shingle long, times long", COUNTED_CHARS).groupBy("shingle").agg(F.sum("times").alias("times"))
    rows = seen.filter(F.col("times") >= SEEN_OFTEN).orderBy(F.desc("times"), "shingle").limit(HOT_SHINGLES).select("shingle").collect()
    return np.sort(np.array([r.shingle for r in rows], np.int64).view(np.uint64))


def points(docs: DataFrame, hot: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles``, ``digest`` (of the set), ``counts`` (the point) and ``first`` (the shingles to meet by)."""

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        out = {"doc_id": ids, "n_shingles": [], "digest": [], "counts": [], "first": []}
        for s in shingle_sets(texts):
            at = np.minimum(np.searchsorted(hot, s), max(len(hot) - 1, 0))
            common = hot[at] == s if len(hot) else np.zeros(len(s), bool)
            ordered = np.concatenate([s[~common], s[common]])
            out["n_shingles"].append(len(s))
            out["digest"].append(xxhash.xxh3_128_digest(s.tobytes()))
            out["counts"].append(np.bincount((s & np.uint64(GROUPS - 1)).astype(int), minlength=GROUPS))
            out["first"].append(ordered[: len(s) - behind(len(s), percent) + 1].view(np.int64) if len(s) else [])
        return out

    return map_texts(docs, run, "doc_id long, n_shingles long, digest binary, counts array<int>, first array<long>")


def overlap_bound(a: Column, b: Column) -> Column:
    """Sum of the coordinate-wise minima of two points."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda done, x: done + x)


def may_link(percent: int):
    """overlap >= percent / (100 + percent) of both sizes together is the same as the link's condition on the union."""

    def test(left: str, right: str) -> Column:
        n, m = f"n_shingles_{left}", f"n_shingles_{right}"
        sizes = (100 * F.least(n, m)) >= percent * F.greatest(n, m)
        return sizes & ((100 + percent) * overlap_bound(F.col(f"counts_{left}"), F.col(f"counts_{right}")) >= percent * (F.col(n) + F.col(m)))

    return test


def tree_pairs(q: np.ndarray, p: np.ndarray, wanted, percent: int = PERCENT) -> np.ndarray:
    """(query, point) places that may link: leaves packed along the size, searched by the bound of their upper corner, then their points.

    ``wanted(queries, points)`` says which places to compare at all, as a mask.
    """
    order = np.lexsort((p[:, 0], p.sum(axis=1)))
    p = p[order]
    size_q, size_p = q.sum(axis=1), p.sum(axis=1)
    found = []
    for begin in range(0, len(p), LEAF):
        leaf, small = p[begin : begin + LEAF], size_p[begin]
        reach = np.minimum(q, leaf.max(axis=0)).sum(axis=1)
        fit = (100 + percent) * reach >= percent * (size_q + small)
        fit &= (100 * size_q >= percent * small) & (100 * size_p[min(begin + LEAF, len(p)) - 1] >= percent * size_q)
        hit = np.flatnonzero(fit)
        if len(hit):
            low = np.minimum(q[hit, None, :], leaf[None]).sum(axis=2)
            near = (100 + percent) * low >= percent * (size_q[hit, None] + size_p[None, begin : begin + LEAF])
            near &= wanted(hit[:, None], order[None, begin : begin + LEAF])
            i, j = np.nonzero(near)
            found.append(np.stack([hit[i], order[begin + j]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), int)


def least_shared(n: np.ndarray, m: np.ndarray, percent: int = PERCENT, tail: Callable = needed) -> np.ndarray:
    """How many of their first shingles two linked sets of these sizes share at least, if ``n - tail(n) + 1`` of ``n`` are first ones.

    Of the two, take the set whose first shingles end earlier in the order. Up to there the sets share only first shingles, and behind it that
    set has fewer than the overlap that it needs with any set.
    """
    overlap = -(-percent * (n + m) // (100 + percent))
    return np.maximum(1, overlap - np.maximum(tail(n, percent), tail(m, percent)) + 1)


def share_enough(percent: int):
    """``least_shared`` as a condition on the number ``shared`` of first shingles that two items have in common."""

    def test(left: str, right: str) -> Column:
        n, m = F.col(f"n_shingles_{left}"), F.col(f"n_shingles_{right}")
        overlap = F.ceil(percent * (n + m) / (100 + percent))
        return F.col("shared") >= overlap - F.greatest(behind(n, percent), behind(m, percent)) + 1

    return test


def forest_search(rows: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (``a``, ``b``) of different groups that share a key and may link.

    Items apart from their key's hub are queries; all items of the key are points. Both are dealt into cells by hash, ``CELL`` of each, so
    that no task holds more than one cell's points however many documents share a key. A pair shares one kind of key or more, and stays only if
    the keys that these stand for are as many as a link needs. Rows carry their item's kinds, so a pair is found once, with the smallest kind that both have, and not
    at all if they share too few; an item of more than ``CARRIED`` kinds carries none, and its pairs are found once for every kind and added up.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(F.col("root") != F.col("hub_root"), 1)).alias("m"))
    sizes = sizes.select("key", F.ceil(F.col("n") / CELL).cast("int").alias("right"), F.ceil(F.col("m") / CELL).cast("int").alias("left"))
    dealt = rows.join(sizes, "key").withColumns({"h": F.xxhash64("id"), "apart": F.col("root") != F.col("hub_root")})
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.pmod(F.col("h"), F.col(n).cast("long")).cast("int")
    kinds = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("key", "weight"))).alias("kinds"))
    few = F.size("kinds") <= CARRIED
    kinds = kinds.select("id", *(F.when(few, F.col(f"kinds.{c}")).otherwise(F.array().cast("array<long>")).alias(f"{c}s") for c in ("key", "weight")))
    told = items.select("id", "counts").join(kinds, "id")
    columns = ("key", "i", "j", "side", "id", "root", "apart", "weight")
    query = dealt.filter("apart").select("*", own("left").alias("i"), F.explode(upto("right")).alias("j"), F.lit(0).alias("side"))
    point = dealt.select("*", F.explode(upto("left")).alias("i"), own("right").alias("j"), F.lit(1).alias("side"))
    cells = query.select(*columns).unionByName(point.select(*columns)).join(told, "id")
    cells = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        for batch in batches:
            whole = pa.concat_tables([*kept, pa.table(batch)]).combine_chunks()
            cell = np.stack([whole.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            if len(cuts):
                yield _search_cells(whole.slice(0, cuts[-1]), np.concatenate([[0], cuts]), percent)
                kept = [whole.slice(cuts[-1])]
            else:
                kept = [whole]
        if kept:
            yield _search_cells(kept[0], np.array([0, kept[0].num_rows]), percent)

    pairs = cells.select(*columns, "counts", "keys", "weights").mapInArrow(task, "a long, b long, least long, weight long")
    return pairs.groupBy("a", "b").agg(F.sum("weight").alias("shared"), F.max("least").alias("least")).filter("shared >= least").select("a", "b")


def _lists(rows: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists one after the other, and how many each row has."""
    chunk = rows.column(column).combine_chunks()
    chunk = chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk
    return chunk.flatten().to_numpy(zero_copy_only=False), np.diff(chunk.offsets.to_numpy())


def shared_kinds(left: np.ndarray, right: np.ndarray, keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows: the weight of the kinds that both carry, and the smallest of these. ``keys`` has each row's kinds, ``sizes`` of them, in order."""
    names, rank = np.unique(keys, return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    codes = np.repeat(np.arange(len(sizes)), sizes) * len(names) + rank
    total, least = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for a in range(0, len(left), 100_000):
        x, y = left[a : a + 100_000], right[a : a + 100_000]
        many = sizes[x]
        pair = np.repeat(np.arange(len(x)), many)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + begin[x][pair]
        code = y[pair] * len(names) + rank[place]
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        both = codes[at] == code
        pair, place = pair[both], place[both]
        np.add.at(total, a + pair, weights[place])
        with_any, first = np.unique(pair, return_index=True)
        least[a + with_any] = keys[place[first]]
    return total, least


def _search_cells(rows: pa.Table, bounds: np.ndarray, percent: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    side, ids, roots, own, weight = (rows.column(c).to_numpy() for c in ("side", "id", "root", "key", "weight"))
    apart = rows.column("apart").to_numpy(zero_copy_only=False)
    counts = _lists(rows, "counts")[0].reshape(-1, GROUPS)
    (keys, carried), (weights, _) = _lists(rows, "keys"), _lists(rows, "weights")
    size, begins = counts.sum(axis=1), np.cumsum(carried) - carried
    out = []
    for begin, end in zip(bounds, bounds[1:]):
        turn = begin + int(np.searchsorted(side[begin:end], 1))

        def wanted(i, j, begin=begin, turn=turn):
            """Other groups; two queries meet twice, and count once."""
            return (roots[begin + i] != roots[turn + j]) & (~apart[turn + j] | (ids[begin + i] < ids[turn + j]))

        if not begin < turn < end:
            continue
        left, right = (tree_pairs(counts[begin:turn], counts[turn:end], wanted, percent) + [begin, turn]).T
        least, shared = least_shared(size[left], size[right], percent, behind), weight[left]
        told = (carried[left] > 0) & (carried[right] > 0)
        if told.any():
            here = slice(begins[begin], begins[end - 1] + carried[end - 1])
            total, smallest = shared_kinds(left[told] - begin, right[told] - begin, keys[here], weights[here], carried[begin:end])
            shared = shared.copy()
            shared[told] = total
            once = ~told
            once[told] = (total >= least[told]) & (smallest == own[left[told]])
            left, right, least, shared = left[once], right[once], least[once], shared[once]
        out.append(np.stack([np.minimum(ids[left], ids[right]), np.maximum(ids[left], ids[right]), least, shared]))
    done = np.concatenate([*out, np.zeros((4, 0), np.int64)], axis=1).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in done], names=["a", "b", "least", "weight"])


def verifier(docs: DataFrame, percent: int = PERCENT):
    """Exact check of pairs of documents on their sets."""

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        return {"doc_id": ids, "shingles": [s.tobytes() for s in shingle_sets(texts)]}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = cut_lineage(pairs)
        named = cut_lineage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        one_each = docs.select("doc_id", "text").join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        sets = cut_lineage(map_texts(one_each, run, "doc_id long, shingles binary"))
        side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")

    return verify


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of documents: ``doc_id, n_shingles, component_id`` (the smallest id it reaches by links) and ``n_copies``, how many documents have its very set.

    A NULL, empty or blank text has an empty set and no links. Rows that repeat a doc_id should have the same text; each row is returned, with a NULL
    component_id where doc_id is NULL. An empty table gives no rows. The result is a written table.
    """
    return settle(_components, docs, percent)


def _components(docs: DataFrame, percent: int) -> DataFrame:
    stored = cut_lineage(points(docs, frequent(docs), percent))
    one = F.min("doc_id").alias("id")
    classes = stored.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest", "n_shingles").agg(one, F.count("*").alias("n_copies"))
    classes = cut_lineage(classes)
    copies = stored.select("doc_id", "digest", "n_shingles").join(classes, ["digest", "n_shingles"]).filter("doc_id <> id").select("doc_id").distinct()
    firsts = stored.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(cut_lineage(copies), "doc_id", "left_anti")
    rows = cut_lineage(meeting(firsts.select(F.explode("first").alias("key"), F.col("doc_id").alias("id"))))
    items = cut_lineage(firsts.select(F.col("doc_id").alias("id"), "n_shingles", "counts").dropDuplicates(["id"]))
    sets = cut_lineage(stored.select("doc_id", "n_shingles", "digest"))
    discard(stored)  # the first shingles are most of it
    n = F.col("n_shingles")
    least = items.select("id", (F.ceil(percent * n / 100) - behind(n, percent) + 1).alias("least"))
    search = lambda left: forest_search(left, items, percent)
    _, roots = find_components(rows, items, may_link(percent), verifier(docs, percent), search, rounds=HUBS, least=least, enough=share_enough(percent))
    named = classes.join(roots, "id", "left").select("digest", "n_shingles", "n_copies", F.coalesce("root", "id").alias("component_id"))
    joined = sets.join(named, ["digest", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def keep_one_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their component, one row per id, with all their columns. Rows with a NULL doc_id stay."""
    found = jaccard_components(docs, percent)
    gone = cut_lineage(found.filter("component_id <> doc_id").select("doc_id").distinct())
    twice = cut_lineage(found.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"))
    discard(found)
    rest = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    once = rest.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return rest.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(once)
