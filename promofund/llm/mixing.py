"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to). The flow network over patterns and sources is small, whatever the number
of documents: a pattern supplies its words once at cost 1 and again at cost 2
(a convex cost of repetition, up to MAX_PASSES passes), and each source takes
words from the patterns that contain it, up to its quota. Spark then takes each
pattern's documents in a seeded order: the running total of words in that order
says which are taken, and how often. At most one document a pattern and pass is
cut, so that every pattern gives exactly its flow.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import beside, rank_buckets, save, scan

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_PASSES = 2
#: The driver's tables go to Spark as Arrow: lists would start a second set of
#: Python workers, which stay on the executors beside the others.
AMOUNTS = pa.schema([("__key", pa.string()), ("turn", pa.int32()), ("amount", pa.int64())])
PLAN = pa.schema([
    ("__key", pa.string()),
    ("sources", pa.list_(pa.struct([("source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64())]))),
    ("__buckets", pa.int64()),
    ("__turns", pa.list_(pa.struct([("bucket", pa.int64()), ("salt", pa.int64()), ("cut", pa.int64()), ("whole", pa.bool_())])))])


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words for each source: ``share`` of all ``sizes`` by weight, none above
    ``most`` times its size; what a source can't take goes to the others by
    weight, again and again."""
    out = [0.0] * len(sizes)
    rest, free = share * sum(sizes), set(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in sorted(free))
        over = {i for i in free if rest * weights[i] / total > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = rest * weights[i] / total
            break
        for i in sorted(over):
            out[i] = most * sizes[i]
            rest -= out[i]
        free -= over
    return out


def routes(supply: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], passes: int) -> dict[tuple[int, int], int]:
    """Min-cost flow from patterns to sources: {(pattern, source): words}.

    Successive shortest paths; pattern p can give ``supply[p]`` words in each
    pass, pass k at cost k a word, to the sources ``members[p]``.
    """
    n_p, n_s = len(supply), len(quota)
    source, sink = n_p + n_s, n_p + n_s + 1
    to, room, cost, back = [], [], [], [[] for _ in range(n_p + n_s + 2)]

    def arc(a, b, cap, c):
        for x, y, r, k in ((a, b, cap, c), (b, a, 0, -c)):
            back[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(k)

    for p in range(n_p):
        for k in range(1, passes + 1):
            arc(source, p, supply[p], k)
    first = len(to)
    for p in range(n_p):
        for s in members[p]:
            arc(p, n_p + s, passes * supply[p], 0)
    last = len(to)
    for s in range(n_s):
        arc(n_p + s, sink, quota[s], 0)
    while True:
        far = [float("inf")] * len(back)
        far[source], via, queue, queued = 0, [-1] * len(back), deque([source]), {source}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in back[x]:
                if room[e] > 0 and far[x] + cost[e] < far[to[e]]:
                    far[to[e]], via[to[e]] = far[x] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if via[sink] < 0:
            break
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    return {(to[e ^ 1], to[e] - n_p): room[e ^ 1] for e in range(first, last, 2) if room[e ^ 1]}


def words_of(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D (null: 0)."""
    bare = F.btrim(text, F.lit("\x20\x09\x0A\x0B\x0C\x0D"))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def _keyed(docs: DataFrame, members: Column, doc_id: str, text: str, seed: int) -> DataFrame:
    """``docs`` with __members (sorted, distinct), __key (the pattern), __size
    and __salt, the document's place in its pattern's seeded order."""
    sorted_members = F.array_sort(F.array_distinct(F.coalesce(members.cast("array<string>"), F.array().cast("array<string>"))))
    return (docs.withColumn("__members", sorted_members).withColumn("__key", F.to_json("__members"))
            .withColumn("__size", words_of(F.col(text)))
            .withColumn("__salt", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id).cast("long"), F.col(text)), 1)))


def _plan(slim: DataFrame, weights: Sequence[float], share: float, passes: int) -> DataFrame:
    """For each pattern what it gives: for each pass the place (bucket, salt)
    of the last document taken and the words it gives. slim: __members, __key,
    __size, __salt."""
    spark = slim.sparkSession
    found = slim.groupBy("__key").agg(F.first("__members").alias("m"), F.sum("__size").alias("words"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: [(m is None, m or "") for m in r.m])
    names = sorted({m for r in found for m in r.m}, key=lambda m: (m is None, m or ""))
    place = {m: i for i, m in enumerate(names)}
    size_of = [sum(r.words for r in found if m in r.m) for m in names]
    # a document of several sources counts once in what is shared out
    pool = sum(r.words for r in found if r.m) / max(1, sum(size_of))
    goal = targets(size_of, [weights[i % len(weights)] for i in range(len(names))], share * pool, passes)
    flow = routes([r.words for r in found], [[place[m] for m in r.m] for r in found], [round(x) for x in goal], passes)
    wanted = {}
    for i, r in enumerate(found):
        total = sum(f for (p, _), f in flow.items() if p == i)
        wanted[r["__key"]] = [min(r.words, max(0, total - k * r.words)) for k in range(passes)]
    n_buckets = rank_buckets(sum(r.n for r in found))
    asked = save(spark.createDataFrame(pa.Table.from_pylist(
        [{"__key": key, "turn": k, "amount": amount} for key, by in wanted.items() for k, amount in enumerate(by)], AMOUNTS)), "mix-amounts")
    bucketed = slim.withColumn("__bucket", F.pmod("__salt", F.lit(n_buckets)))
    sums = bucketed.groupBy("__key", "__bucket").agg(F.sum("__size").alias("s"))
    whole = W.partitionBy("__key").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("s").over(whole), F.lit(0).cast("long")))
    # the one bucket of each pattern and pass in which the amount is reached
    edge = sums.join(beside(asked), "__key").where("amount > start and amount <= start + s").select("__key", "__bucket", "turn", "amount", "start")
    inside = W.partitionBy("__key", "turn").orderBy("__salt").rowsBetween(W.unboundedPreceding, -1)
    rows = (bucketed.join(F.broadcast(edge), ["__key", "__bucket"])  # a row a pattern and pass
            .withColumn("at", F.col("start") + F.coalesce(F.sum("__size").over(inside), F.lit(0).cast("long")))
            .where("amount > at and amount <= at + __size").select("__key", "turn", "__bucket", "__salt", (F.col("amount") - F.col("at")).alias("cut")))
    last = {(r["__key"], r.turn): (r["__bucket"], r["__salt"], r.cut) for r in rows.collect()}
    none = (-1, -1, 0)
    return save(spark.createDataFrame(pa.Table.from_pylist(
        [{"__key": r["__key"], "__buckets": n_buckets,
          "sources": [{"source": m, "source_size": size_of[place[m]], "target": float(goal[place[m]])} for m in r.m],
          "__turns": [dict(zip(("bucket", "salt", "cut", "whole"), (*last.get((r["__key"], k), none), amount >= r.words), strict=True))
                      for k, amount in enumerate(wanted[r["__key"]])]} for r in found], PLAN)), "mix-plan")


def mix_sources(docs: DataFrame, members: Column, doc_id: str = "doc_id", text: str = "text", weights: Sequence[float] = WEIGHTS,
                share: float = SHARE, passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """``docs`` with size (long), takes (array<long>, the words that each pass
    takes) and sources (an array of (source, source_size long, target double)).

    ``members``: the sources of a document, an array of strings. Sources in
    code-point order, null last, take ``weights`` in turn. Size is the number of
    words (runs of characters other than space and \\x09-\\x0D; null text: 0).
    All targets together are ``share`` of all sizes; none exceeds ``passes``
    times its source's size. Each pass takes a document once at most; the one at
    the end of a pattern's amount gives its first words only. The order within a
    pattern depends on the seed, doc_id and text alone, so reruns agree. Rows
    equal in doc_id and text share a place and are taken alike. Documents without
    members give nothing. Columns named size, takes or sources are replaced. An
    empty table gives an empty result. Patterns and sources pass through the
    driver: they are the mix's configuration, not its data.
    """
    keyed = _keyed(docs, members, doc_id, text, seed)
    slim = save(keyed.select("__members", "__key", "__size", "__salt"), "mix-sizes")
    plan = _plan(slim, weights, share, passes)
    here = F.struct(F.pmod("__salt", "__buckets").alias("bucket"), F.col("__salt").alias("salt"))
    # a size of 0 is taken by no pass; a cut is never more than the size
    take = F.transform("__turns", lambda t: F.when(t["whole"] | (here < F.struct(t["bucket"].alias("bucket"), t["salt"].alias("salt"))), F.col("__size"))
                       .when((here["bucket"] == t["bucket"]) & (here["salt"] == t["salt"]), F.least("__size", t["cut"]))
                       .otherwise(F.lit(0).cast("long")))
    out = keyed.drop("size", "takes", "sources").join(F.broadcast(plan), "__key")  # a row a pattern
    return (out.withColumn("size", F.col("__size")).withColumn("takes", take)
            .drop("__key", "__members", "__size", "__salt", "__buckets", "__turns"))


def op4_mixing_to_target_weights(spark, sf_dir: str) -> DataFrame:
    """All documents, each a member of its one source."""
    docs = scan(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_sources(docs, F.array("source"))
    own = F.col("sources")[0]
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x)
    return mixed.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), taken.alias("taken"))


def apply_mix(docs: DataFrame, members: Column, text: str = "text") -> DataFrame:
    """``docs`` as the mix takes them, in the same columns: a document that is
    not taken goes, one that is taken twice comes twice, and a cut one keeps its
    first words."""
    columns = docs.columns
    mixed = mix_sources(docs.withColumn("__text", F.col(text)), members, text="__text")
    mixed = mixed.withColumn("__take", F.explode("takes")).where("__take > 0")
    bare = F.btrim("__text", F.lit("\x20\x09\x0A\x0B\x0C\x0D"))
    words = F.split(bare, "[\\x20\\x09-\\x0D]+")
    cut = F.array_join(F.slice(words, 1, F.col("__take").cast("int")), " ")
    return mixed.withColumn(text, F.when(F.col("__take") < F.col("size"), cut).otherwise(F.col("__text"))).select(*columns)
