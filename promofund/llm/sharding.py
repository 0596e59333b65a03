"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has RING places. Every shard owns VNODES places chosen by hash; a row
belongs at the place of its key's hash and goes to the next virtual node
clockwise. No shard takes more than its bound: what overflows a full shard goes
on clockwise to the next virtual node with room. Rows of one ring place have
the same way round, so the overflow is settled on row counts by place (a table
bounded by the ring, however many rows there are): each place's rows are split,
in a hashed order, into runs that go to one shard each. Spark counts the
places, ranks the rows of each place and looks the runs up; all of it is
DataFrame operations.
"""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promofund.llm.common import beside, rank_buckets, running_totals, save, scan

RING, VNODES = 1 << 14, 64


def virtual_nodes(n_shards: int, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise. A shard's nodes do not
    depend on how many other shards there are."""
    return sorted((xxhash.xxh64_intdigest(f"{shard}:{v}") % ring, shard) for shard in range(n_shards) for v in range(vnodes))


def bounds(n_rows: int, n_shards: int, slack: float) -> list[int]:
    """The most rows of each shard: with no slack, counts at most one apart;
    else (1 + slack) times the mean, rounded up."""
    if slack > 0:
        return [math.ceil((1 + slack) * n_rows / n_shards)] * n_shards
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def runs(counts: dict[int, int], n_shards: int, slack: float, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int, int, int, int]]:
    """(place, first rank, rank after the last, shard, shard's rows before) for
    all rows of ``counts`` (rows by place)."""
    nodes = virtual_nodes(n_shards, vnodes, ring)
    room = bounds(sum(counts.values()), n_shards, slack)
    used, out, at = [0] * n_shards, [], 0
    for place in sorted(counts):
        while at < len(nodes) and nodes[at][0] < place:
            at += 1
        left, rank, node = counts[place], 0, at
        while left:
            shard = nodes[node % len(nodes)][1]
            take = min(left, room[shard] - used[shard])
            if take > 0:
                out.append((place, rank, rank + take, shard, used[shard]))
                used[shard] += take
                rank += take
                left -= take
            node += 1
    return out


def shard(docs: DataFrame, n_shards: int, doc_id: str = "doc_id", text: str = "text", slack: float = 0.0) -> DataFrame:
    """Per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 8),
    text_crc32, shard (int) and slot (long, gapless from 0 in each shard).

    A null text has no bytes and the checksum of an empty one; null doc_ids
    share a ring place; rows may repeat. The order of rows at one ring place is
    by the hash of all of a row that is returned, so only equal rows are
    interchangeable. Other columns are not read. An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
                       F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    rows = save(rows.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(RING)))
                .withColumn("salt", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 1)), "ring-rows")
    counts = {r.place: r["count"] for r in rows.groupBy("place").count().collect()}  # at most RING rows
    table = spark.createDataFrame(runs(counts, n_shards, slack), "at long, lo long, hi long, shard int, base long")
    ways = beside(save(table, "ring-runs"))
    ranked = running_totals(rows, ["place"], "salt", F.lit(1), rank_buckets(sum(counts.values())), out="rank")
    return (ranked.join(ways, (F.col("place") == F.col("at")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot")))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents, 24 shards, no slack."""
    out = shard(scan(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
