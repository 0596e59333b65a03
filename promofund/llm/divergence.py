"""Source divergence audit: which sources of a language differ, and by which terms.

Per language, terms of enough documents are kept. The sorted kept terms are cut
into shards of SHARD terms, and each shard becomes a minimal acyclic transducer
whose outputs, plus the shard's first place, are the terms' lexicographic
ordinals in the language. The texts are then read again: a task counts its
terms, routes them to their shards by the shards' first terms, and each shard
streams what reaches it through its transducer. From there on terms are
ordinals, also where ties are broken; only reported ones are spelled again.

No task holds a vocabulary: it holds one shard's transducer and cells (terms x
sources), or a partial count of about FLUSH entries. The driver holds one term in
SHARD.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promofund.llm.common import beside, ranks, save, scan
from promofund.llm.transducer import Transducer, build

SHARD = 2048
FLUSH = 300_000
CELLS = 1 << 16

#: Bytes of terms stay, A-Z lowered; all others part terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and non-ASCII characters, A-Z lowered."""
    return text.translate(_TERM_BYTES).split() if text else []


def _rows(batch, *names):
    """(lang, names, text) of a batch, a few rows at a time."""
    for k in range(0, batch.num_rows, 256):
        part = batch.slice(k, 256)
        yield from zip(*(part.column(c).to_pylist() for c in ("lang", *names, "text")), strict=True)


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(lang, term binary, n_docs) of ``texts`` (lang, text binary, and others)."""
    def emit(counts):
        for lang, found in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()),
                                              pa.array(list(found.values()), pa.int64())], names=["lang", "term", "n_docs"])

    def count(batches):
        counts = defaultdict(Counter)
        for batch in batches:
            for lang, text in _rows(batch):
                counts[lang].update(set(terms(text)))
                if sum(map(len, counts.values())) >= FLUSH:
                    yield from emit(counts)
                    counts.clear()
        yield from emit(counts)

    parts = texts.select("lang", "text").mapInArrow(count, "lang string, term binary, n_docs long")
    return parts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))


def vocabulary(texts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term binary, ordinal, size) of the kept terms, written."""
    kept = save(document_frequencies(texts).where(F.col("n_docs") >= min_docs).select("lang", "term"), "audit-kept")
    return save(ranks(kept, ["lang"], ["term"], "audit-sorted").withColumnRenamed("rank", "ordinal"), "audit-vocabulary")


def transducers(vocab: DataFrame) -> DataFrame:
    """(lang, shard, first term, packed transducer), written."""
    shards = (vocab.groupBy("lang", F.floor(F.col("ordinal") / SHARD).cast("long").alias("shard"))
              .agg(F.sort_array(F.collect_list("term")).alias("terms")))

    def make(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1)
                found = row.column("terms").to_pylist()[0]
                yield pa.RecordBatch.from_arrays([row.column("lang"), row.column("shard"), pa.array([found[0]], pa.binary()),
                                                  pa.array([build(found)], pa.binary())], names=["lang", "shard", "first", "packed"])

    return save(shards.mapInArrow(make, "lang string, shard long, first binary, packed binary"), "audit-transducers")


def recount(texts: DataFrame, machines: DataFrame) -> DataFrame:
    """Occurrences of the accepted terms, written: per (lang, shard) the sources
    met there (``sids``), their occurrences (``totals``), and the cells n > 0 as
    arrays: t (place in the shard), s (place in ``sids``), n.

    ``texts`` (lang, sid, text binary)."""
    bounds: dict[str, list[bytes]] = defaultdict(list)
    for r in machines.select("lang", "shard", "first").orderBy("lang", "shard").collect():  # one term in SHARD
        bounds[r.lang].append(bytes(r["first"]))
    routes = texts.sparkSession.sparkContext.broadcast(dict(bounds))
    names = ["lang", "shard", "term", "sids", "ns", "packed"]

    def emit(lang, counts):
        """A row per term: the sources that have it, and how often."""
        firsts = routes.value.get(lang)
        if not firsts:
            return
        keys = pa.array([t for found in counts.values() for t in found], pa.binary()).dictionary_encode()
        if not len(keys):
            return
        sids = np.repeat(np.array(list(counts), dtype=np.int64), [len(found) for found in counts.values()])
        ns = np.array([n for found in counts.values() for n in found.values()], dtype=np.int64)
        code = keys.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(code))]), pa.int32())
        words = keys.dictionary
        shards = pa.array([bisect_right(firsts, t) - 1 for t in words.to_pylist()], pa.int64())
        rows = pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words), pa.string()), shards, words, pa.ListArray.from_arrays(offsets, pa.array(sids[order])),
             pa.ListArray.from_arrays(offsets, pa.array(ns[order])), pa.nulls(len(words), pa.binary())], names=names)
        yield rows.filter(pa.array(shards.to_numpy() >= 0))

    def count(batches):
        counts, held = defaultdict(lambda: defaultdict(Counter)), 0
        for batch in batches:
            for lang, sid, text in _rows(batch, "sid"):
                found = counts[lang][sid]
                held -= len(found)
                found.update(terms(text))
                held += len(found)
                if held >= FLUSH:
                    for key, group in counts.items():
                        yield from emit(key, group)
                    counts.clear()
                    held = 0
        for key, group in counts.items():
            yield from emit(key, group)

    def cells(lang, shard, held):
        """One row of a shard's cells; held: (t, sid, n) arrays."""
        t, sid, n = held
        sids, s = np.unique(sid, return_inverse=True)
        totals = np.zeros(len(sids), dtype=np.int64)
        np.add.at(totals, s, n)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([shard], pa.int64())]
            + [pa.array([x.tolist()], pa.list_(kind)) for x, kind in ((sids, pa.int64()), (totals, pa.int64()), (t, pa.int32()), (s, pa.int32()), (n, pa.int64()))],
            names=["lang", "shard", "sids", "totals", "t", "s", "n"])

    def merged(parts):
        """Equal (t, sid) added up: at most SHARD x sources cells."""
        t, sid, n = (np.concatenate([p[k] for p in parts]) for k in range(3))
        if not len(t):
            return t, sid, n
        order = np.lexsort((sid, t))
        t, sid, n = t[order], sid[order], n[order]
        first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (sid[1:] != sid[:-1])])
        return t[first], sid[first], np.add.reduceat(n, first)

    def stream(batches):
        at, machine, parts, held = None, None, [], 0
        for b in batches:
            packed, words = b.column("packed"), b.column("term").to_pylist()
            loads = np.flatnonzero(~np.asarray(packed.is_null()))
            edges = sorted({0, *loads.tolist(), b.num_rows})
            sizes = np.diff(b.column("sids").offsets.to_numpy())
            sids, ns = b.column("sids").flatten().to_numpy(), b.column("ns").flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo in loads:  # a shard's transducer comes before its terms
                    if parts:
                        yield cells(*at, merged(parts))
                    at, machine, parts, held = (b.column("lang")[lo].as_py(), b.column("shard")[lo].as_py()), Transducer(packed[lo].as_py()), [], 0
                    lo += 1
                if lo == hi:
                    continue
                place = np.array([machine.ordinal(w) for w in words[lo:hi]], dtype=np.int64)
                t = np.repeat(place, sizes[lo:hi])
                known = t >= 0
                parts.append((t[known], sids[ends[lo] : ends[hi]][known], ns[ends[lo] : ends[hi]][known]))
                held += len(parts[-1][0])
                if held >= FLUSH:
                    parts = [merged(parts)]
                    held = len(parts[0][0]) // 2
        if parts:
            yield cells(*at, merged(parts))

    schema = "lang string, shard long, term binary, sids array<long>, ns array<long>, packed binary"
    none = F.array().cast("array<long>")
    loaded = machines.select("lang", "shard", F.lit(b"").alias("term"), none.alias("sids"), none.alias("ns"), "packed")
    rows = texts.mapInArrow(count, schema).unionByName(loaded)
    rows = rows.repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.col("packed").isNull())
    return save(rows.mapInArrow(stream, "lang string, shard long, sids array<long>, totals array<long>, t array<int>, s array<int>, n array<long>"),
                "audit-cells")


def share(n: np.ndarray, total, size: int, scale: int, add: int) -> np.ndarray:
    """1 + floor(scale * (n + add) / (total + add * size)), exactly."""
    if n.size and int(n.max()) >= (2**63 - 1) // scale - add:
        n = n.astype(object)
    return (1 + scale * (n + add) // (total + add * size)).astype(np.int64)


def _scores(cells: DataFrame, langs: DataFrame, scale: int, add: int, top: int) -> DataFrame:
    """(lang, a, part, b, value), written: per shard of terms and pair of sources
    the sum of distances (part ``pair``, b the other source), and per source its
    ``top`` terms above the language (part ``term``, b the ordinal)."""
    def rows(lang, a, part, b, value):
        n = len(value)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(np.full(n, a), pa.int64()), pa.array([part] * n, pa.string()),
                                           pa.array(b, pa.int64()), pa.array(value, pa.int64())], names=["lang", "a", "part", "b", "value"])

    def score(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                lang, shard, size = (row.column(c)[0].as_py() for c in ("lang", "shard", "size"))
                sids, sources, totals, t, s, n = (np.asarray(row.column(c)[0].values) for c in ("sids", "sources", "source_totals", "t", "s", "n"))
                by_sid = np.argsort(sources)
                s = by_sid[np.searchsorted(sources, sids, sorter=by_sid)][s]  # places of the sources in the language
                absent = share(np.zeros(len(sources), dtype=np.int64), totals, size, scale, add)
                width = max(1, CELLS // len(sources))  # terms at once; cells are in order of t
                last = min(SHARD, size - shard * SHARD)
                for lo in range(0, last, width):
                    hi = min(lo + width, last)
                    part = slice(*np.searchsorted(t, (lo, hi)))
                    tt, ss, nn = t[part] - lo, s[part], n[part]
                    p = np.repeat(absent[None, :], hi - lo, axis=0)
                    p[tt, ss] = share(nn, totals[ss], size, scale, add)
                    whole = np.zeros(hi - lo, dtype=np.int64)
                    np.add.at(whole, tt, nn)
                    q = share(whole, int(totals.sum()), size, scale, add)
                    above = p[tt, ss] > q[tt]
                    tt, ss = tt[above], ss[above]
                    value = (p[tt, ss] - q[tt]) ** 2 // q[tt]
                    order = np.lexsort((tt, -value, ss))
                    first = np.searchsorted(ss[order], np.arange(len(sources) + 1))
                    for source in range(len(sources)):
                        best = order[first[source] : first[source + 1]][:top]
                        yield rows(lang, source, "term", shard * SHARD + lo + tt[best], value[best])
                        at = p[:, source : source + 1]
                        yield rows(lang, source, "pair", np.arange(len(sources)), ((at - p) ** 2 // p).sum(axis=0))

    joined = cells.join(beside(langs), "lang")
    return save(joined.mapInArrow(score, "lang string, a long, part string, b long, value long"), "audit-scores")


def audit(docs: DataFrame, min_docs: int = 3, scale: int = 10**9, add: int = 1, top: int = 200) -> DataFrame:
    """Per (lang, source): every other source of the language by the distance to
    it (part ``pair``), and the ``top`` terms that the source has more of than
    the language (part ``term``).

    Null texts, languages and sources are empty strings; repeated rows count as
    documents. A group without terms has pairs; a language without kept terms
    has pairs of value 0; an empty table gives no rows. Only lang, source and
    text are read. The distance of a term is floor((p - q)^2 / q) on shares in
    units of 1 / ``scale``, smoothed by ``add``; ties go by ordinal, that is by
    bytes. Pairs take terms x sources^2 steps, shared out by shards of terms.
    """
    texts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                        F.col("text").cast("binary").alias("text"))
    occurring = save(texts.groupBy("lang", "source").agg(F.lit(1).alias("one")), "audit-occurring")
    seed = 0  # sources travel as hashes that differ within each language
    while occurring.groupBy("lang", F.xxhash64("source", F.lit(seed))).count().where("count > 1").take(1):
        seed += 1
    sid = F.xxhash64("source", F.lit(seed))
    vocab = vocabulary(texts, min_docs)
    cells = recount(texts.select("lang", sid.alias("sid"), "text"), transducers(vocab))

    sizes = vocab.groupBy("lang").agg(F.max("size").alias("size"))
    totals = cells.select("lang", F.inline(F.arrays_zip("sids", "totals"))).groupBy("lang", F.col("sids").alias("sid")).agg(F.sum("totals").alias("total"))
    groups = ranks(occurring, ["lang"], ["source"], "audit-sources").select("lang", "source", F.col("rank").alias("idx"), sid.alias("sid"))
    groups = save(groups.join(totals, ["lang", "sid"], "left").withColumn("total", F.coalesce("total", F.lit(0))), "audit-groups")
    ordered = F.sort_array(F.collect_list(F.struct("idx", "sid", "total")))
    langs = (groups.groupBy("lang").agg(ordered.alias("all"))
             .select("lang", F.col("all.sid").alias("sources"), F.col("all.total").alias("source_totals")).join(sizes, "lang"))
    scores = _scores(cells, save(langs, "audit-languages"), scale, add, top)

    sums = scores.where("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one, other = groups.select("lang", "source", F.col("idx").alias("a")), groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("b"))
    value = F.coalesce("value", F.lit(0).cast("long"))
    pairs = (one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"),
                     F.row_number().over(W.partitionBy("lang", "source").orderBy(value.desc(), "b")).alias("rank")))
    by_value = W.partitionBy("lang", "a").orderBy(F.desc("value"), "b")
    best = scores.where("part = 'term'").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    told = (best.join(one, ["lang", "a"]).join(vocab.select("lang", F.col("ordinal").alias("b"), "term"), ["lang", "b"])
            .select("lang", "source", "part", F.col("term").cast("string").alias("item"), "value", "rank"))
    return pairs.unionByName(told)


def op13_source_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """All documents: terms of at least 3 documents of their language."""
    return audit(scan(spark, sf_dir, "documents"))
