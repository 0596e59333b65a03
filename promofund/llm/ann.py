"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected at random to a few dimensions, shifted, and ordered along
a Hilbert curve; CURVES such orders are range-partitioned by Spark and cut into
blocks. A query meets its own block and the neighbouring ones in every order;
what the windows bring is merged and reranked by the exact distance.

The windows are as wide as the table asks for: PROBES of the asking items,
chosen by hash, are compared with all items, and the places of their true
neighbours along the curves tell the recall of any window. Blocks grow from
BLOCK items until RECALL is reached, and from WIDEST on a query meets more of
them instead, so that a task's piece stays bounded.

Equal vectors are one item with its smallest ids, so that copies fill no window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import beside, save, scan
from promofund.llm.vectors import answers, curve_ranks, items, projections, valid_rows

CURVES, BLOCK, WIDEST = 16, 2048, 16384
#: Asking items that recall is measured on, and the least recall that their
#: mean less two standard errors has to reach.
PROBES, RECALL = 128, 0.9
GROWTH = 1.25


def _nearest(k: int):
    """A function of one block (rows asks, id, item, vector) that returns each
    asking item's k nearest of the block, by distance and then id."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy()
        x = np.array(rows["vector"].tolist(), dtype=float)
        ids, item = rows["id"].to_numpy(), rows["item"].to_numpy()
        here, there = np.flatnonzero(~asks), np.flatnonzero(asks)
        out = []
        square = (x * x).sum(axis=1)
        for a in range(0, len(there) if len(here) else 0, 256):
            q = there[a : a + 256]
            rough = square[q, None] + square[here] - 2 * (x[q] @ x[here].T)
            few = min(k, len(here))
            bar = np.partition(rough, few - 1, axis=1)[:, few - 1]
            slack = 1e-9 * (square[q] + square[here].max())  # of the rough distances' rounding
            for i, row in enumerate(q.tolist()):
                may = here[rough[i] <= bar[i] + slack[i]]
                exact = np.sqrt(((x[may] - x[row]) ** 2).sum(axis=1))
                for j in np.lexsort((ids[may], exact))[:k].tolist():
                    out.append((ids[row], item[may[j]], ids[may[j]], exact[j]))
        return pd.DataFrame(out, columns=["id", "item", "cand", "score"]).astype({"id": "int64", "item": "int64", "cand": "int64", "score": "float64"})

    return run


def _true_nearest(every_item: DataFrame, k: int) -> DataFrame:
    """(probe, item): the k nearest of all items to each probe, PROBES asking
    items chosen by hash."""
    got = every_item.where("asked").select("item", "vector").orderBy(F.xxhash64("item"), "item").limit(PROBES).collect()
    probe, at = np.array([r.item for r in got], dtype=np.int64), np.array([r.vector for r in got], dtype=float)
    kind = "probe long, id long, item long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the k nearest so far of each probe: (score, id, item)
        best = [(np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)) for _ in probe]
        for batch in batches if len(probe) else ():
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            ids, item = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for p, y in enumerate(at):
                here = np.flatnonzero(item != probe[p])
                score = np.concatenate([best[p][0], np.sqrt(((x[here] - y) ** 2).sum(axis=1))])
                of_id, of_item = np.concatenate([best[p][1], ids[here]]), np.concatenate([best[p][2], item[here]])
                first = np.lexsort((of_id, score))[:k]
                best[p] = score[first], of_id[first], of_item[first]
        for p, (score, of_id, of_item) in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), probe[p])), pa.array(of_id), pa.array(of_item), pa.array(score)],
                                             ["probe", "id", "item", "score"])

    near = every_item.select("id", "item", "vector").mapInArrow(run, kind)
    order = W.partitionBy("probe").orderBy("score", "id", "item")
    return save(near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("probe", "item"), "ann-probes")


def window_size(of: np.ndarray, near: np.ndarray, probe: np.ndarray, least: int) -> tuple[int, int]:
    """(block, reach): the smallest windows, from blocks of ``least`` items on,
    that reach RECALL. of and near: places of a probe and of a true neighbour of
    it, a row a pair and a column a curve; probe: the probe of each row."""
    n = np.bincount(probe) if len(probe) else np.empty(0)
    block, reach, width = least, 1, float(least)
    while len(n):
        met = (np.abs(of // block - near // block) <= reach).any(axis=1)
        share = np.bincount(probe, weights=met)[n > 0] / n[n > 0]
        if share.mean() - 2 * share.std() / np.sqrt(len(share)) >= RECALL:
            break
        width *= GROWTH
        block = max(least, min(int(np.ceil(width)), WIDEST))
        reach = max(1, int(np.ceil(width / block)))
    return block, reach


def _measured(every_item: DataFrame, ranked: DataFrame, k: int, least: int) -> tuple[int, int]:
    """``window_size`` from the places of the probes and of their true neighbours."""
    pairs = _true_nearest(every_item, k)
    wanted = pairs.select("item").union(pairs.select("probe")).distinct()
    places = ranked.join(beside(save(wanted, "ann-wanted")), "item").select("item", "curve", "rank").collect()  # PROBES * (k + 1) items at most
    at: dict[int, dict[int, int]] = {}
    for r in places:
        at.setdefault(r.item, {})[r.curve] = r["rank"]
    place = {i: [c[j] for j in sorted(c)] for i, c in at.items()}
    rows = pairs.collect()
    probe = np.unique([r.probe for r in rows], return_inverse=True)[1] if rows else np.empty(0, np.int64)
    return window_size(np.array([place[r.probe] for r in rows]), np.array([place[r.item] for r in rows]), probe, least)


def nearest(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, curves: int = CURVES,
            block: int = BLOCK, seed: int = 7) -> DataFrame:
    """The k nearest found of every row whose id is divisible by ``every``:
    query_id, rank (int, from 1), vec_id, score (Euclidean distance).

    Rows with a null id, a null or zero vector or one with null or non-finite
    components take no part, nor do vectors of another than the table's most
    frequent dimension. Rows may repeat; a row with the query's id is no
    candidate. Ties go to the smaller id. Other columns are not read; an empty
    table gives an empty result. ``block`` is the least size of the blocks.
    """
    rows = valid_rows(table, vec_id, vector, zero_ok=False)
    every_item, queries = items(rows, "vector", k + 1, F.col("vec_id") % every == 0)
    ranked = curve_ranks(every_item, "vector", projections(every_item, "vector", curves, seed))
    block, reach = _measured(every_item, ranked, k, block)
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block))
    full = ranked.join(every_item.select("item", "asked", "vector"), "item").select("curve", "block", "id", "item", "asked", "vector")
    near = F.sequence(F.col("block") - reach, F.col("block") + reach)
    asking = full.where("asked").withColumn("block", F.explode(near)).withColumn("asks", F.lit(True))
    both = full.withColumn("asks", F.lit(False)).unionByName(asking).drop("asked")
    run = _nearest(k + 1)
    found = (both.groupBy("curve", "block").applyInPandas(lambda rows: run(rows), "id long, item long, cand long, score double")
             .dropDuplicates(["id", "item"]))
    order = W.partitionBy("id").orderBy("score", "cand")
    found = save(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n", "cand"), "ann-found")
    return answers(found, every_item, queries, k, F.asc("score"))


def op7_approximate_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """All embeddings; every 100th asks for its 10 nearest."""
    return nearest(scan(spark, sf_dir, "embeddings"))
