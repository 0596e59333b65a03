"""Exact top-k inner products by block-at-a-time pruning.

Components are integer terms. Vectors, ordered by their nearest pivot (k-means
on a bounded sample) and along a Hilbert curve within it so that neighbours are
alike, form document-range blocks with the least and largest value of every
term, their centre and radius. A query's bound in a block is the
lower of two: each term's weight times the extreme that helps it, summed; and
the product with the centre plus the query's length times the radius (Cauchy and
Schwarz). The bounds order the blocks; the best of each chunk of blocks are
scored through their forward index (the block's matrix) first, which gives a
lower bound of the k-th score, the bar; more blocks raise it (WAVES). At last
every block whose bound reaches the bar is scored too, the others cannot hold a
result, and of their rows only those at or above the bar leave a task. Queries go in groups, blocks in chunks, so that
every task sees a bounded piece of each. Matrices travel in the narrowest
integers that hold them.

How many blocks are skipped depends on the vectors: clusters let most of them
be skipped, vectors without any structure none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import ranks, save, scan
from promofund.llm.hilbert import hilbert_keys
from promofund.llm.vectors import BITS, SAMPLE, answers, items, projections, valid_rows

BLOCK, CHUNK, GROUP = 256, 512, 512
#: Best blocks of a chunk that are scored before the bar is raised, and raised again.
WAVES = (2, 16)
SCALE = 64
#: Pivots of the blocks' order, and steps of their k-means.
PIVOTS, LLOYD = 256, 8


def _ints(raw: bytes, width: int, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(raw, dtype=kind).reshape(-1, width).astype("i8", copy=False)


def _narrow(x: np.ndarray) -> str:
    """The narrowest integers that hold ``x``."""
    return next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through doubles where these are exact."""
    largest = float(max(1, np.abs(q).max(initial=0))) * float(max(1, np.abs(x).max(initial=0))) * q.shape[1]
    if largest < 2.0**53:
        return np.rint(q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


def _pivots(table: DataFrame, seed: int) -> np.ndarray:
    """Centres of at most PIVOTS clusters of SAMPLE vectors chosen by hash, in a
    greedy tour, so that centres of one cluster follow each other."""
    got = table.select("ints").orderBy(F.xxhash64("ints")).limit(SAMPLE).collect()
    x = np.array([r[0] for r in got], dtype=float)
    if not len(x):
        return x
    rng = np.random.default_rng(seed)
    centre = x[rng.permutation(len(x))[: max(1, min(PIVOTS, len(x) // 8))]]
    for _ in range(LLOYD):
        near = _nearest(x, centre)
        count = np.bincount(near, minlength=len(centre))[:, None]
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(count > 0, total / np.maximum(count, 1), centre)
    way, left = [0], set(range(1, len(centre)))  # from each centre to the nearest one left
    while left:
        rest = np.array(sorted(left))
        way.append(int(rest[_nearest(centre[way[-1:]], centre[rest])[0]]))
        left.remove(way[-1])
    return centre[way]


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(axis=1) - 2 * (x @ centre.T), axis=1)


def _placed(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, item, ints, pivot, key): the pivot next to each vector and its place
    on a Hilbert curve; written, since it is sorted by them."""
    curves = projections(table, "ints", 1, seed=3)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
            m, shift, spread = curves[0]
            with np.errstate(over="ignore", invalid="ignore"):
                z = np.nan_to_num((x @ m - shift) / spread + 0.5)
                near = _nearest(x, pivots)
            cell = np.clip(z * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(near, pa.int32()), pa.array(hilbert_keys(cell, BITS), pa.int64())],
                                             names=["id", "item", "ints", "pivot", "key"])

    return save(table.select("id", "item", "ints").mapInArrow(place, "id long, item long, ints array<long>, pivot int, key long"), "topk-placed")


def _pack(name: str):
    """A group's rows (key, id, item, ints) as one row: key, ids, items, and as
    bytes the matrix, its least and its largest row, its centre; its radius."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        x = np.array(rows["ints"].tolist(), dtype="<i8")
        kind, centre = _narrow(x), x.mean(axis=0, dtype=float)
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
        return pd.DataFrame({name: [rows[name].iloc[0]], "ids": [rows["id"].tolist()], "items": [rows["item"].tolist()], "width": [x.shape[1]],
                             "kind": [kind], "matrix": [x.astype(kind).tobytes()], "least": [x.min(axis=0).tobytes()], "most": [x.max(axis=0).tobytes()],
                             "centre": [centre.astype("<f8").tobytes()], "radius": [radius]})

    return run


def _bounds(c) -> np.ndarray:
    """Upper bounds of the score of each query (row) of a cell in each of its blocks (column)."""
    q, least, most = _ints(c.matrix, c.width, c.kind), _ints(c.least, c.width), _ints(c.most, c.width)
    bound = _products(np.maximum(q, 0), most) + _products(np.minimum(q, 0), least)
    centre, radius = np.frombuffer(c.centre, dtype="<f8").reshape(-1, c.width), np.asarray(c.radius, dtype=float)
    with np.errstate(over="ignore", invalid="ignore"):
        x = q.astype(float)
        size = np.sqrt((x**2).sum(axis=1))[:, None]
        ball = x @ centre.T + size * radius
        # the error of sums of doubles is far below this part of their terms' size
        ball += 1e-9 * size * (np.sqrt((centre**2).sum(axis=1)) + radius) + 1
        tighter = ball < np.minimum(bound.astype(float), 2.0**62)
        return np.where(tighter, np.where(tighter, ball, 0).astype(np.int64), bound)


def _pick(lo: int, hi: int | None):
    """Cells (group, queries, their bars or none, chunk of block bounds) to the
    blocks that stand at places ``lo`` to ``hi`` of each query's order by bound
    and whose bound reaches its bar: (block, group, the queries' places)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in batches:
            for c in cells.itertuples():
                bound = _bounds(c)
                best = np.argsort(-bound, axis=1, kind="stable")[:, lo:hi]
                query, block = np.arange(len(best)).repeat(best.shape[1]), best.reshape(-1)
                if c.bar is not None:
                    reach = bound[query, block] >= np.asarray(c.bar)[query]
                    query, block = query[reach], block[reach]
                yield _by_block(c.grp, np.asarray(c.blocks), query, block)

    return run


def _by_block(group: int, blocks: np.ndarray, query: np.ndarray, block: np.ndarray) -> pd.DataFrame:
    order = np.argsort(block, kind="stable")
    query, block = query[order], block[order]
    use, first = np.unique(block, return_index=True)
    parts = np.split(query, first[1:]) if len(use) else []
    return pd.DataFrame({"block": blocks[use].astype("int64"), "grp": np.full(len(use), group, dtype="int64"),
                         "places": pd.Series([p.astype("int32") for p in parts], dtype=object)})


def _score(k: int):
    """Cells (queries' places, group matrix, their bars or none, block matrix) to
    (id, item, cand, score): each query's k best of the block at or above its
    bar, ties to the smaller id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in batches:
            for c in cells.itertuples():
                places, ids, cand = np.asarray(c.places), np.asarray(c.ids), np.asarray(c.b_ids)
                score = _products(_ints(c.matrix, c.width, c.kind)[places], _ints(c.b_matrix, c.width, c.b_kind))
                n = min(k, len(cand))
                # candidates stand by id, so a stable order breaks ties
                best = np.argsort(-score, axis=1, kind="stable")[:, :n]
                value = np.take_along_axis(score, best, axis=1)
                keep = np.ones(value.shape, dtype=bool) if c.bar is None else value >= np.asarray(c.bar)[places][:, None]
                yield pd.DataFrame({"id": np.broadcast_to(ids[places][:, None], value.shape)[keep], "item": np.asarray(c.b_items)[best][keep],
                                    "cand": cand[best][keep], "score": value[keep]})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("id").orderBy(F.desc("score"), "cand")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def top_products(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, scale: int = SCALE,
                 stats: dict | None = None) -> DataFrame:
    """The k highest inner products of floor(scale * x) of every row whose id is
    divisible by ``every`` with all other rows: query_id, rank (int, from 1),
    vec_id, score (long).

    Exact. Rows with a null id, a null vector or one with null or non-finite
    components take no part, nor do vectors of another than the table's most
    frequent dimension; zero vectors do. Rows may repeat; a row with the query's
    id is no candidate. Ties go to the smaller id. Scores beyond 64 bits are not
    defined. Other columns are not read; an empty table gives an empty result.

    ``stats`` takes the numbers of (query, block) pairs: ``scored`` and ``all``.
    """
    rows = valid_rows(table, vec_id, vector, zero_ok=True)
    rows = rows.select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("ints"))
    every_item, queries = items(rows, "ints", k + 1, F.col("vec_id") % every == 0)
    placed = ranks(_placed(every_item, _pivots(every_item, seed=3)), [], ["pivot", "key", "id", "item"], "topk-order")
    placed = placed.withColumn("block", F.floor(F.col("rank") / BLOCK))
    shape = "ids array<long>, items array<long>, width int, kind string, matrix binary, least binary, most binary, centre binary, radius double"
    blocks = placed.select("block", "id", "item", "ints").groupBy("block").applyInPandas(lambda r: _pack("block")(r), f"block long, {shape}")
    blocks = save(blocks, "topk-blocks")
    asked = every_item.where("asked")
    n_groups = max(1, -(-asked.count() // GROUP))
    groups = (asked.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(n_groups))).select("grp", "id", "item", "ints")
              .groupBy("grp").applyInPandas(lambda r: _pack("grp")(r), f"grp long, {shape}").drop("least", "most", "centre", "radius"))
    groups = save(groups, "topk-queries")
    # a chunk: the bounds of CHUNK blocks, side by side
    chunk = F.floor(F.col("block") / CHUNK)
    part = F.sort_array(F.collect_list(F.struct("block", "least", "most", "centre", "radius")))  # CHUNK of them at most
    joined = lambda name: F.aggregate(f"part.{name}", F.lit(b""), lambda a, x: F.concat(a, x))
    bounds = save(blocks.groupBy(chunk.alias("chunk")).agg(part.alias("part"))
                  .select("chunk", F.col("part.block").alias("blocks"), F.col("part.radius").alias("radius"),
                          *[joined(c).alias(c) for c in ("least", "most", "centre")]), "topk-bounds")
    n_chunks = max(1, bounds.count())
    cells = (groups.select("grp", "ids", "width", "kind", "matrix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))).alias("chunk"))
             .join(bounds, "chunk"))
    of_block = blocks.select("block", F.col("ids").alias("b_ids"), F.col("items").alias("b_items"), F.col("kind").alias("b_kind"), F.col("matrix").alias("b_matrix"))
    pairs = "block long, grp long, places array<int>"
    result = "id long, item long, cand long, score long"

    no_bar = F.lit(None).cast("array<long>").alias("bar")
    place = groups.select("grp", F.posexplode("ids").alias("at", "id"))
    found = None
    for lo, hi in zip((0, *WAVES), (*WAVES, None), strict=True):
        if found is None:
            bars = groups.select("grp", no_bar)
        else:
            # k + 1 items have k rows besides the query's own at least
            bar = found.where(F.col("n") == k + 1).select("id", F.col("score").alias("bar"))
            bars = (place.join(bar, "id", "left").groupBy("grp")
                    .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("bar", F.lit(-(2**63))).alias("bar")))).alias("b"))  # GROUP about
                    .select("grp", F.transform("b", lambda x: x["bar"]).alias("bar")))
            bars = save(bars, "topk-bars")
        wanted = save(cells.join(bars, "grp").mapInPandas(_pick(lo, hi), pairs), "topk-wanted")
        if stats is not None:
            stats["scored"] = stats.get("scored", 0) + (wanted.agg(F.sum(F.size("places"))).first()[0] or 0)
        asking = groups.select("grp", "ids", "width", "kind", "matrix").join(bars, "grp")
        new = wanted.join(of_block, "block").join(asking, "grp").mapInPandas(_score(k + 1), result)
        found = save(_best(new if found is None else found.drop("n").unionByName(new), k + 1), "topk-found")
    if stats is not None:
        stats["all"] = asked.count() * blocks.count()
    found = found.drop("n", "cand")
    return answers(found, every_item, queries, k, F.desc("score"))


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """All embeddings; every 20th asks for its 20 highest."""
    return top_products(scan(spark, sf_dir, "embeddings"))
