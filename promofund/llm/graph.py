"""Groups of linked items, found without ever making all pairs of a group.

``components`` is a distributed union-find. ``linked_groups`` takes candidate
keys (two items with a common key may be linked), verifies set similarity
exactly and returns the connected groups of all links between items that
share a key:

1. Leaders. In each key the item with the most shared keys leads, and every
   other item of the key is compared with its leader only. Items whose
   distance from the leader is above ``NEAR`` stay in the key for a second
   round with another leader.
2. Clumps. Leader pairs up to the distance ``NEAR + (1 - t)`` connect items to
   clumps. Jaccard distance is a metric, so two linked items of one key meet in
   one clump: let x be the first of them that a round takes out, at most
   ``NEAR`` from its leader; the other is then at most ``NEAR + (1 - t)`` from
   the same leader. Where no round takes out either, both are left in their
   key, and what is left of a key forms one more clump.
3. The rest. A clump whose leader pairs already link all of it is done. In the
   other clumps, blocks of bounded volume are compared block by block: parity
   sketches give a lower bound of the symmetric difference, and pairs of
   different components within the bound are verified on the exact sets. Only
   pairs that join two components leave a task.

So a group of G near copies costs about G comparisons where they are linked
through leaders, and bounded blocks, never one task, where they are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import BATCH, save, tidy

#: Distance up to which an item counts as settled with its leader.
NEAR = 0.4
#: Edges that a task joins at once.
EDGES = 200_000
#: Rounds of leaders.
ROUNDS = 2
#: Most items and set elements of a block, as an average.
BLOCK_ITEMS, BLOCK_ELEMENTS = 512, 250_000
#: Items of a clump up to which sketches take longer than the sets themselves.
FEW = 4


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (long columns a, b): one row (id,
    root) for each id of an edge, root being the smallest id reachable.

    Tasks of at most EDGES edges first shrink these to a forest (union-find).
    Then large-star and small-star steps alternate: every item connects
    its larger (then its smaller) neighbours to its smallest one, until nothing
    changes. Minima combine map-side and the neighbours come by joins that
    adaptive execution splits, so an item with very many neighbours is no hot
    task.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = save(pairs, "edges")
    pairs = save(pairs.coalesce(-(-pairs.count() // EDGES) or 1).mapInPandas(_forests, "u long, v long"), "forests")
    state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        pairs = save(small, "stars")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return ends.unionByName(ends.select(F.col("root").alias("id")).distinct().withColumn("root", F.col("id")))


def _forests(batches):
    """A forest of stars that connects the same items as a task's edges (u, v)."""
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for rows in batches:
        for u, v in zip(rows["u"].tolist(), rows["v"].tolist(), strict=True):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    stars = [(x, root(x)) for x in list(parent)]
    yield pd.DataFrame([(x, r) for x, r in stars if x != r], columns=["u", "v"], dtype="int64")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sets (sorted, distinct)."""
    both = np.concatenate((a, b))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _similar(pairs: DataFrame, sets: DataFrame, decode: Callable[[list[bytes]], Iterable[np.ndarray]]) -> DataFrame:
    """Pairs (a, b) with their set sizes and the size ``i`` of the intersection."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("data").alias("da"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("data").alias("db"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for k in range(0, batch.num_rows, 256):  # sets are large: not all of a batch at once
                part = batch.slice(k, 256)
                own, other = part.column(4).to_pylist(), part.column(5).to_pylist()
                # a leader's pairs mostly come one after the other
                turns = [not j or other[j] != other[j - 1] for j in range(len(other))]
                leaders = iter(decode([x for x, turn in zip(other, turns, strict=True) if turn]))
                for x, turn in zip(decode(own), turns, strict=True):
                    if turn:
                        leader = next(leaders)
                    common.append(_common(x, leader))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(common, pa.int64())], ["a", "b", "na", "nb", "i"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "da", "db")
    return both.mapInArrow(tidy(run), "a long, b long, na long, nb long, i long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=1, dtype=np.int64)


def parity_sketches(sets: list[np.ndarray], n_bits: int) -> np.ndarray:
    """Row i: the parity of how many elements of set i fall on each of
    ``n_bits`` bits (a power of two), packed into 64-bit words. The Hamming
    distance of two rows is at most the sets' symmetric difference."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bits = np.concatenate(sets).astype(np.uint64) & np.uint64(n_bits - 1)
    counts = np.bincount(rows * n_bits + bits.astype(np.int64), minlength=len(sets) * n_bits)
    return np.packbits((counts & 1).astype(np.uint8).reshape(len(sets), n_bits), axis=1).view(np.uint64)


def _links_between(comp: list[int], side: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of components that the sets' exact similarities link. Items of side
    0 are compared with each other, or with side 1 where there is one."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    parent = {c: c for c in comp}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    few = len(sets) <= FEW
    sketch = None if few else parity_sketches(sets, max(64, 1 << int(4 * size.max() - 1).bit_length()))
    last = int((side == 0).sum())
    found = []
    for i in range(last):
        lo = last if last < len(sets) else i + 1
        if lo >= len(sets):
            break
        fits = (size[lo:] * den >= size[i] * num) & (size[i] * den >= size[lo:] * num)
        if not few:
            most = (size[lo:] + size[i]) * (den - num) // (den + num)
            fits &= _popcount(sketch[lo:] ^ sketch[i]) <= most
        for j in (np.flatnonzero(fits) + lo).tolist():
            a, b = root(comp[i]), root(comp[j])
            if a == b:
                continue
            common = _common(sets[i], sets[j])
            if common * den >= num * (int(size[i]) + int(size[j]) - common):
                parent[max(a, b)] = min(a, b)
                found.append((max(a, b), min(a, b)))
    return found


def _compare(decode: Callable[[list[bytes]], Iterable[np.ndarray]], num: int, den: int):
    """A function of pandas rows (clump, comp, side, data) that compares the
    items of each clump among them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        rows = rows.sort_values(["clump", "side", "id"], kind="stable")
        clump, side = rows["clump"].to_numpy(), rows["side"].to_numpy()
        comp, sets = rows["comp"].tolist(), list(decode(rows["data"].tolist()))
        cuts = np.flatnonzero(clump[1:] != clump[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)], strict=True):
            found += _links_between(comp[a:b], side[a:b], sets[a:b], num, den)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _rest(items: DataFrame, sets: DataFrame, decode: Callable[[list[bytes]], Iterable[np.ndarray]], num: int, den: int) -> DataFrame:
    """Edges between components of unsettled clumps. items: id, clump, comp."""
    sized = items.join(sets.select("id", "n"), "id")
    sized = save(sized, "clump-items")
    run = _compare(decode, num, den)
    whole = sized.groupBy("clump").agg(F.count("*").alias("items"), F.sum("n").alias("mass"))
    whole = save(whole.withColumn("small", (F.col("items") <= BLOCK_ITEMS) & (F.col("mass") <= BLOCK_ELEMENTS)), "clump-sizes")
    # small clumps: as many together as make up a block
    mass = whole.where("small").agg(F.sum("mass")).first()[0] or 0
    small = sized.join(whole.where("small").select("clump"), "clump").join(sets.select("id", "data"), "id")
    small = small.withColumn("deal", F.pmod(F.xxhash64("clump"), F.lit(1 + mass // BLOCK_ELEMENTS))).withColumn("side", F.lit(0))
    found = small.select("deal", "clump", "id", "comp", "side", "data").groupBy("deal").applyInPandas(lambda rows: run(rows), "a long, b long")
    # large ones: sizes of linked sets differ by the factor t at most, so an
    # item meets its own and the neighbouring classes of sizes, block by block
    sized = sized.join(whole.where("not small").select("clump"), "clump")
    sized = sized.withColumn("cls", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9))
    mass = sized.groupBy("clump", "cls").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    mass = mass.select("clump", "cls", F.greatest(F.ceil(F.col("c") / BLOCK_ITEMS),
                                                  F.ceil(F.col("s") / BLOCK_ELEMENTS)).cast("long").alias("parts"))
    by_class = W.partitionBy("clump").orderBy("cls")  # a clump has few classes
    near = lambda turn, gap: F.when(turn("cls").over(by_class) == F.col("cls") + gap, turn("parts").over(by_class))
    mass = mass.withColumn("above", near(F.lead, 1)).withColumn("below", near(F.lag, -1))
    sized = sized.join(mass, ["clump", "cls"])
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    none = F.expr("cast(array() as array<struct<lc:bigint,lp:bigint,hc:bigint,hp:bigint,side:int>>)")

    def target(lc, lp, hc, hp, side):
        return F.struct(lc.cast("long").alias("lc"), lp.cast("long").alias("lp"), hc.cast("long").alias("hc"),
                        hp.cast("long").alias("hp"), F.lit(side).alias("side"))

    cls, own = F.col("cls"), F.col("part")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    same = F.transform(upto(F.col("parts")), lambda j: F.when(j >= own, target(cls, own, cls, j, 0))
                       .otherwise(target(cls, j, cls, own, 1)))
    up = F.when(F.col("above").isNotNull(), F.transform(upto(F.col("above")), lambda j: target(cls, own, cls + 1, j, 0)))
    down = F.when(F.col("below").isNotNull(), F.transform(upto(F.col("below")), lambda j: target(cls - 1, j, cls, own, 1)))
    dealt = (sized.withColumn("part", part)
             .select("id", "clump", "comp", F.explode(F.concat(same, F.coalesce(up, none), F.coalesce(down, none))).alias("to"))
             .select("id", "clump", "comp", "to.*"))
    dealt = dealt.join(sets.select("id", "data"), "id")
    return found.unionByName(dealt.groupBy("clump", "lc", "lp", "hc", "hp").applyInPandas(lambda rows: run(rows), "a long, b long"))


def linked_groups(shared: DataFrame, sets: DataFrame, decode: Callable[[list[bytes]], Iterable[np.ndarray]], num: int, den: int) -> DataFrame:
    """Connected groups of items whose sets have a Jaccard similarity of at
    least num / den, among the items that share a key.

    ``shared``: (key long, id long), distinct, every key with two ids or more;
    ``sets``: (id long, n long, data binary), one row for every id of ``shared``
    at least; ``decode`` turns a list of data into the sets, each its n elements,
    sorted 64-bit integers. Returns (id, root) for ids with a link.
    """
    score = shared.groupBy("id").agg(F.count("*").alias("score"))
    left = shared.join(score, "id")
    loose = (100 - round(100 * NEAR)) * den - (den - num) * 100  # similarity of the loose bound, over 100 * den
    tight = 100 - round(100 * NEAR)
    known = None
    for _ in range(ROUNDS):
        lead = left.groupBy("key").agg(F.max(F.struct("score", "id")).alias("top"), F.count("*").alias("c"))
        led = left.join(lead.where("c > 1").select("key", F.col("top.id").alias("leader")), "key")
        led = save(led.where(F.col("id") != F.col("leader")), "led")
        pairs = led.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
        if known is None:
            known = save(_similar(pairs, sets, decode), "leader-pairs", BATCH)
        else:
            fresh = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
            known = save(known.unionByName(_similar(fresh, sets, decode)), "leader-pairs", BATCH)
        near = known.where(F.col("i") * 100 >= tight * (F.col("na") + F.col("nb") - F.col("i")))
        near = near.select(F.col("a").alias("id"), F.col("b").alias("leader"))
        left = led.join(near, ["id", "leader"], "left_anti").select("key", "id", "score")
    union = F.col("na") + F.col("nb") - F.col("i")
    links = known.where(F.col("i") * den >= num * union).select("a", "b")
    clumps = components(known.where(F.col("i") * (100 * den) >= loose * union).select("a", "b"))
    roots = components(links)
    places = clumps.select("id", F.col("root").alias("clump")).unionByName(
        left.select("id", F.xxhash64("key", F.lit("key")).alias("clump")))
    items = places.join(roots, "id", "left").select("id", "clump", F.coalesce("root", "id").alias("comp"))
    open_clumps = items.groupBy("clump").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    more = save(_rest(items.join(open_clumps.select("clump"), "clump"), sets, decode, num, den), "rest-links")
    if more.isEmpty():
        return roots
    merged = components(more).select(F.col("id").alias("root"), F.col("root").alias("top"))
    every = roots.unionByName(more.select(F.explode(F.array("a", "b")).alias("id")).distinct()
                              .join(roots.select("id"), "id", "left_anti").withColumn("root", F.col("id")))
    return every.join(merged, "root", "left").select("id", F.coalesce("top", "root").alias("root"))


def local_repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch's key rows (an item has a key once): which go on to the
    shuffle (the first of each key) and which are known to be shared inside the
    batch (all rows of keys with several). A key that very many items have thus
    sends one row a batch."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.ones(len(k), dtype=bool)
    first[1:] = k[1:] != k[:-1]
    send = np.zeros(len(k), dtype=bool)
    send[order] = first
    repeated = np.zeros(len(k), dtype=bool)
    more = ~first
    more[:-1] |= more[1:]
    repeated[order] = more
    return send, repeated


def once(sets: DataFrame) -> DataFrame:
    """``sets`` (written) with each id once. Tasks already leave out what they
    have sent, so mostly there is nothing to do."""
    n = sets.agg(F.count("id").alias("rows"), F.countDistinct("id").alias("ids")).first()
    return sets if n.rows == n.ids else save(sets.dropDuplicates(["id"]), "sets-once")


def shared_keys(signatures: DataFrame) -> DataFrame:
    """(key, id) of all keys that two different ids have. signatures: id,
    ``keys`` (those sent) and ``repeated`` (those known to be shared)."""
    w = W.partitionBy("key")
    sent = signatures.select("id", F.explode("keys").alias("key"))
    across = (sent.withColumn("lo", F.min("id").over(w)).withColumn("hi", F.max("id").over(w))
              .where("lo < hi").select("key", "id"))
    inside = signatures.select(F.explode("repeated").alias("key"), "id")
    return across.unionByName(inside).distinct()
