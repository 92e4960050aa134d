"""Connected groups from blocks of possible partners, without all pairs of a block.

``find_edges`` takes rows of (key, id): items that share a key may be linked. A first step compares every item of a key with the key's smallest
id only, which joins large groups of copies through a few hubs at a cost that grows with the rows. Then only items that are still apart from
their key's hub are compared with the key's other items, skipping those in the same group. Pairs never leave a key
unless the cheap test lets them, and are verified once however many keys they share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, discard, settle

#: Groups that a key holds at most when no further hub is tried in it: its pairs are then few for each of its items.
FEW_GROUPS = 16

#: Pairs (a, b) with what each side carries -> verified pairs (a, b).
Verify = Callable[[DataFrame], DataFrame]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm: neighbours are handed to the smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    seen = both.join(least, "u")
    if large:
        out = seen.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = seen.filter("v < u").select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every id in an edge (``a, b``): the smallest id that it reaches. Steps are written tables."""
    now, state = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        told = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if told == state or not told[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        state, before = told, now
        now = cut_lineage(_star(_star(now, large=True), large=False))
        discard(before)


def _rooted(rows: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    named = roots.select(F.col("id").alias(column), F.col("root").alias(name))
    return rows.join(named, column, "left").withColumn(name, F.coalesce(name, column))


def _sided(items: DataFrame, side: str) -> DataFrame:
    """``items`` with the id as ``side`` and every other column named after the side."""
    return items.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in items.columns if c != "id"))


def meeting(rows: DataFrame, told: str | None = None) -> DataFrame:
    """The rows (``key``, ``id``) whose key has other rows, too, and in a column ``told`` how many it has. What is shuffled is the rows alone, once; most keys have one row."""
    met = rows.withColumn(told or "n", F.count("*").over(Window.partitionBy("key"))).filter(F.col(told or "n") > 1)
    return met if told else met.drop("n")


def _able(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``meeting`` of the rows of items that have as many of the keys as ``least`` (``id, least``) says they share with any partner."""
    able = cut_lineage(rows.groupBy("id").agg(F.count("*").alias("n")).join(least, "id").filter("n >= least").select("id"))
    return meeting(rows.join(able, "id", "left_semi"))


def _kinds(rows: DataFrame) -> DataFrame:
    """``key, hub, weight``: one key for all keys that the very same items have, two at least, and how many these are.

    Most keys are like others: what two texts share is many keys with the same two items. Items are told apart by how many they are, the smallest, and
    two sums over a 64-bit hash of their ids.
    """
    h = F.xxhash64("id")
    parts = {"low": h.bitwiseAND(F.lit(0x7FFFFFFF)), "high": F.shiftrightunsigned(h, 33)}
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("hub"), *(F.sum(x).alias(c) for c, x in parts.items())).filter("n > 1")
    return keys.groupBy("n", "hub", *parts).agg(F.min("key").alias("key"), F.count("*").alias("weight")).select("key", "hub", "weight")


def once_each(rows: DataFrame) -> DataFrame:
    """The rows (``key``, ``id``) of one key for all keys that the very same items have."""
    return rows.join(_kinds(rows).select("key"), "key", "left_semi")


def find_components(
    rows: DataFrame,
    items: DataFrame,
    test: Callable[[str, str], Column],
    verify: Verify,
    search: Callable[[DataFrame], DataFrame] | None = None,
    rounds: int = 1,
    least: DataFrame | None = None,
    enough: Callable[[str, str], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(verified pairs used, ``id, root``) over all links between items that share a key.

    ``rows``: distinct (``key``, ``id``). ``items``: ``id`` and what the cheap necessary condition ``test("a", "b")`` needs, its columns named ``*_a`` and
    ``*_b`` there. ``verify`` gets distinct pairs (``a``, ``b``) and returns the linked ones. ``search`` may replace the pairing of the
    second step: it gets ``key, id, root, hub_root, weight`` for keys that still hold several groups; a key with ``weight`` n stands for n keys of the same items.
    ``rounds``: hubs that are tried in each key before its other items are paired; from the second on the hub is
    the smallest id that is apart from those before, so groups that drift away from the first hub are joined at a cost that follows their rows, too. Keys of
    ``FEW_GROUPS`` groups or fewer get no further hub.
    ``least`` (``id, least``) says how many keys an item shares with any partner at least; items that have fewer shared keys are left out with their rows. ``enough``
    is a condition like ``test`` that also has ``shared``, the number of keys in which one of a pair is the other's hub; a pair that does not meet it is no spoke
    and left to the second step.
    """

    def spokes_of(hubs: DataFrame) -> DataFrame:
        pairs = hubs.filter("id <> hub").groupBy(F.col("hub").alias("a"), F.col("id").alias("b")).agg(F.sum("weight").alias("shared"))
        passes = test("a", "b") & enough("a", "b") if enough else test("a", "b")
        return pairs.join(_sided(items, "b"), "b").join(_sided(items, "a"), "a").filter(passes).select("a", "b")

    rows = cut_lineage(_able(rows, least) if least is not None else meeting(rows))
    shared = cut_lineage(rows.join(_kinds(rows), "key"))
    discard(rows)
    items = cut_lineage(items.join(shared.select("id").distinct(), "id", "left_semi"))  # most items share no key
    edges = settle(verify, spokes_of(shared))
    roots = settle(components, edges)
    placed = cut_lineage(_rooted(_rooted(shared, roots, "id", "root"), roots, "hub", "hub_root").drop("hub"))
    discard(shared)
    left, linked_later = placed.filter("root <> hub_root").select("key", "id", "root", "weight"), False
    step = None  # what ``left`` reads, from the second hub on
    for _ in range(rounds - 1):
        hubs = left.groupBy("key").agg(F.min(F.struct("id", "root")).alias("h"), F.count_distinct("root").alias("n")).filter(F.col("n") > FEW_GROUPS)
        tried = cut_lineage(left.join(hubs.select("key", F.col("h.id").alias("hub"), F.col("h.root").alias("hub_root")), "key").filter("root <> hub_root"))
        if step is not None:
            discard(step)
        left = step = tried
        if tried.isEmpty():
            break
        more = settle(verify, spokes_of(left))
        if not more.isEmpty():
            edges, linked_later = edges.unionByName(more), True
            # groups found so far are joined by their roots, so a round's graph is as small as what it adds
            joined = _rooted(_rooted(more, roots, "a", "root_a"), roots, "b", "root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            upper = settle(components, joined)
            known = _rooted(roots, upper, "root", "top").select("id", F.col("top").alias("root"))
            roots = cut_lineage(known.unionByName(upper.join(known.select("id"), "id", "left_anti")))
            left = _rooted(_rooted(left, upper, "root", "top"), upper, "hub_root", "hub_top").select("key", "id", "weight", F.col("top").alias("root"), F.col("hub_top").alias("hub_root"))
        left = left.filter("root <> hub_root").select("key", "id", "root", "weight")
    if step is not None:
        discard(step)
    if linked_later:
        first = placed
        # the roots found first are ids of the later ones
        moved = _rooted(_rooted(first, roots, "root", "top"), roots, "hub_root", "hub_top")
        placed = cut_lineage(moved.select("key", "id", F.col("top").alias("root"), F.col("hub_top").alias("hub_root"), "weight"))
        discard(first)
    mixed = placed.filter("root <> hub_root").select("key").distinct()
    apart = cut_lineage(placed.join(mixed, "key", "left_semi"))
    discard(placed)
    if search:
        pairs = search(apart)
    else:
        apart = apart.join(items, "id")
        one = _sided(apart.filter("root <> hub_root"), "a")
        two = _sided(apart.drop("hub_root", "weight"), "b").withColumnRenamed("key_b", "key_a")
        # a pair of two items that are both apart from the hub is met from both sides: keep one of them
        once = (F.col("a") < F.col("b")) | (F.col("root_b") == F.col("hub_root_a"))
        pairs = one.join(two, "key_a").filter((F.col("root_a") != F.col("root_b")) & once & test("a", "b")).select("a", "b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    late = settle(verify, pairs)
    # the groups found first stand for their pairs
    joined = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).union(late)
    return edges.union(late).distinct(), settle(components, joined)
