"""Vector tables: valid rows, equal vectors as one item, ranks along curves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import beside, save
from promofund.llm.hilbert import hilbert_keys

#: Vectors that projections are fitted on.
SAMPLE = 4096
DIMS, BITS = 8, 7


def valid_rows(table: DataFrame, vec_id: str, vector: str, zero_ok: bool) -> DataFrame:
    """(vec_id long, vector array<double>) of the rows that take part: with an
    id and a vector without null and non-finite components, not all zero unless
    ``zero_ok``, and of the table's most frequent dimension (the larger, if tied)."""
    x = F.transform(F.col(vector), lambda c: c.cast("double") + 0.0)  # no negative zeros
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vector")).where("vec_id is not null and size(vector) > 0")
    rows = rows.where(F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    if not zero_ok:
        rows = rows.where(F.exists("vector", lambda c: c != 0.0))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0].d if sizes else 0))


def items(rows: DataFrame, value: str, keep: int, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """(items, queries). Rows with equal ``value`` are one item: id (its smallest
    vec_id), ``value``, ids (its ``keep`` smallest vec_ids) and asked (whether a
    query has it). queries: query_id, id of its item.

    Only the smallest ids of a value leave a task, so very common vectors stay
    small; queries are few."""
    ids = rows.select("vec_id", value).distinct()
    order = W.partitionBy(value).orderBy("vec_id")
    least = (ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
             .groupBy(value).agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))  # at most ``keep``
    least = least.select(F.col("ids")[0].alias("id"), value, "ids")
    asked = rows.where(is_query).select("vec_id", value).distinct()
    of_query = save(asked.join(least.select("id", value), value).select(F.col("vec_id").alias("query_id"), "id"), "vector-queries")
    marked = least.join(beside(save(of_query.select(F.col("id").alias("q")).distinct(), "vector-asked")), F.col("id") == F.col("q"), "left")
    # an id with several vectors is the smallest of each: the value tells them apart
    item = F.xxhash64(value)
    return (save(marked.select("id", value, "ids", F.col("q").isNotNull().alias("asked"), item.alias("item")), "vector-items"), of_query)


def projections(table: DataFrame, value: str, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(matrix, shift, scale) of each curve: a random orthogonal projection to
    DIMS dimensions, shifted at random, fitted to SAMPLE vectors chosen by hash."""
    got = table.select(value).orderBy(F.xxhash64(value)).limit(SAMPLE).collect()
    x = np.array([r[0] for r in got], dtype=float)
    rng, out = np.random.default_rng(seed), []
    for _ in range(curves):
        if not len(x):
            break
        m = np.linalg.qr(rng.normal(size=(x.shape[1], min(DIMS, x.shape[1]))))[0]
        y = x @ m
        spread = y.std(axis=0)
        out.append((m, y.mean(axis=0) + rng.uniform(-0.5, 0.5, m.shape[1]) * spread, np.where(spread > 0, spread, 1.0) * 8))
    return out


def curve_ranks(table: DataFrame, value: str, curves: list) -> DataFrame:
    """(curve, id, item, rank): each item's place along each curve, from 0.

    Spark range-partitions and sorts by (curve, key); the numbers of rows that
    each partition has of each curve give the offsets."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat = batch.column(2)
            x = flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
            for c, (m, shift, scale) in enumerate(curves):
                with np.errstate(over="ignore", invalid="ignore"):
                    z = np.nan_to_num((x @ m - shift) / scale + 0.5)
                cell = np.clip(z * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c, np.int32)), pa.array(hilbert_keys(cell, BITS)), batch.column(0), batch.column(1)],
                                                 ["curve", "key", "id", "item"])

    keyed = table.select("id", "item", value).mapInArrow(keys, "curve int, key long, id long, item long")
    dealt = keyed.repartitionByRange("curve", "key", "id", "item").sortWithinPartitions("curve", "key", "id", "item")
    row = F.monotonically_increasing_id()
    dealt = save(dealt.withColumn("part", F.shiftright(row, 33)).withColumn("at", row.bitwiseAND(F.lit((1 << 33) - 1))), "curve-order")
    runs = dealt.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = save(runs.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).drop("n"), "curve-runs")
    return dealt.join(beside(runs), ["curve", "part"]).select("curve", "id", "item", (F.col("start") + F.col("at") - F.col("first")).alias("rank"))


def answers(found: DataFrame, table: DataFrame, queries: DataFrame, k: int, best_first: Column) -> DataFrame:
    """(query_id, rank, vec_id, score) from ``found`` (id of a query's item, item
    of a candidate, score): candidates' ids, without the query's own, the k
    first by ``best_first`` and then vec_id. found: k + 1 items a query at most."""
    ids = found.join(table.select("item", "ids"), "item").select("id", "score", F.explode("ids").alias("vec_id"))
    rows = queries.join(ids, "id").where("vec_id != query_id").dropDuplicates(["query_id", "vec_id"])
    order = W.partitionBy("query_id").orderBy(best_first, "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
