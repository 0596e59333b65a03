"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct word n-grams. Its
hash space is cut into K ranges; the parity sketch of a range XORs the hashes
that fall into it, so that two sketches differ in at most as many ranges as
the sets have different elements. Two sets with Jaccard similarity >= t differ
in at most d = (|A| + |B|) (1 - t) / (1 + t) elements, which bounds the
sketches' distance; with K = d + 1 + e ranges at least e + 1 are equal
(pigeonhole), and the one with the most elements among these is sent by both
sides if each leaves out only its e weakest ranges. K depends on the size
band: bands grow by BAND, and a document whose partners may lie in the next
band also sends that band's ranges. Equal ranges are the candidate keys; all
candidates are verified on the exact sets (``graph.linked_groups``).

A range without elements says nothing, and its key would be that of all sets
alike, so it isn't sent. That can only lose a pair all of whose >= e + 1 equal
ranges are empty; then each of the two has more than e empty ranges itself. Such
sets send the ranges of another cut of the hash space too, and so on up to CUTS
cuts, in the last of which empty ranges are sent: sets of at least twice as many
elements as ranges, which thresholds of 0.8 and more give, hardly ever come that far.

No link is lost: every pair at or above the threshold shares a key, and equal
sets are one item throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promofund.llm import graph
from promofund.llm.common import BATCH, beside, save, scan, tidy
from promofund.llm.textgrams import chunks, list_array, mix, set_ids, shingle_sets

BAND = 1.5
#: Part of d by which K exceeds d + 1; so many weakest ranges are not sent.
SPARE = 0.2
#: Cuts of the hash space tried for sets with too many empty ranges.
CUTS = 16
#: Ids of sets that a task remembers as sent.
MEMORY = 500_000

_S32 = np.uint64(32)


def range_keys(h: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The candidate keys of non-empty sets (sorted, one after the other) for
    the threshold num / den: (set number, key), by set number."""
    band = np.floor(np.log(sizes) / np.log(BAND) + 1e-9).astype(np.int64)
    # a partner has at most size / t elements
    reaches = sizes * den / num + 1e-9 >= BAND ** (band + 1)
    begins = np.cumsum(sizes) - sizes
    owners, keys = [], []
    for up in (0, 1):
        own = np.flatnonzero(reaches) if up else np.arange(len(sizes))
        for cut in range(CUTS):
            if not len(own):
                break
            n, b = sizes[own], band[own] + up
            most = np.ceil(BAND ** (b + 1)).astype(np.int64)
            d = 2 * most * (den - num) // (den + num)
            spare = (SPARE * d).astype(np.int64)
            k = d + 1 + spare
            row = np.repeat(np.arange(len(own)), n)
            v = h[np.arange(len(row)) + np.repeat(begins[own] - (np.cumsum(n) - n), n)]
            base = np.cumsum(k) - k
            if cut:
                v = mix(v + np.uint64(cut * 0x9E3779B97F4A7C15 % 2**64))
            place = (((v >> _S32) * k[row].astype(np.uint64)) >> _S32).astype(np.int64) + base[row]
            if cut:  # else the hashes ascend
                order = np.argsort(place, kind="stable")
                v, place = v[order], place[order]
            counts = np.bincount(place, minlength=int(k.sum()))
            value = np.zeros(len(counts), dtype=np.uint64)
            filled = np.flatnonzero(counts)
            value[filled] = np.bitwise_xor.reduceat(mix(v ^ np.uint64(0x5851F42D4C957F2D)), np.cumsum(counts[filled]) - counts[filled])
            owner = np.repeat(np.arange(len(own)), k)
            index = np.arange(len(counts)) - base[owner]
            sparse = np.bincount(owner[counts == 0], minlength=len(own)) > spare
            order = np.lexsort((index, counts, owner))  # weakest first
            sent = order[index >= spare[owner]]
            if cut < CUTS - 1:
                sent = sent[counts[sent] > 0]
            tag = mix((np.uint64(cut) << np.uint64(58)) | (b[owner[sent]] + 1).astype(np.uint64) << np.uint64(40) | index[sent].astype(np.uint64))
            owners.append(own[owner[sent]])
            keys.append(mix(value[sent] ^ tag))
            own = own[sparse]
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order]


def _signatures(n_words: int, num: int, den: int):
    """Arrow batches (doc_id, text, tkey) to (doc_id, tkey, n, id, keys, repeated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                h, sizes = shingle_sets(data, offsets, n_words)
                ids = set_ids(h, sizes)
                new = np.zeros(len(ids), dtype=bool)  # sets whose keys this task hasn't sent
                for i, x in enumerate(ids.tolist()):
                    if x and x not in seen:
                        if len(seen) >= MEMORY:
                            seen.clear()
                        seen.add(x)
                        new[i] = True
                full = np.flatnonzero(new)
                if len(full):
                    owner, key = range_keys(h[np.repeat(new, sizes)], sizes[full], num, den)
                    owner = full[owner]
                else:
                    owner, key = np.empty(0, np.int64), np.empty(0, np.uint64)
                send, repeated = graph.local_repeats(key)
                lists = [list_array(key[m], np.bincount(owner[m], minlength=len(ids))) for m in (send, repeated)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(sizes, pa.int64()),
                                                  pa.array(ids, pa.int64()), *lists], ["doc_id", "tkey", "n", "id", "keys", "repeated"])

    return run


def _sets(n_words: int):
    """Arrow batches (text) to (id, n, data), each set once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                h, sizes = shingle_sets(data, offsets, n_words)
                ids = set_ids(h, sizes)
                new = np.zeros(len(ids), dtype=bool)
                for i, x in enumerate(ids.tolist()):
                    if x and x not in seen:
                        if len(seen) >= MEMORY:
                            seen.clear()
                        seen.add(x)
                        new[i] = True
                ends = np.cumsum(sizes)
                raw = [h[e - n : e].tobytes() for e, n in zip(ends[new].tolist(), sizes[new].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[new], pa.int64()), pa.array(sizes[new], pa.int64()), pa.array(raw, pa.binary())], ["id", "n", "data"])

    return run


def ngram_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = 3,
                 num: int = 90, den: int = 100) -> DataFrame:
    """Per document of ``docs``: doc_id, n_shingles (long, its set's size),
    component_id, the smallest doc_id reachable by links, itself included, and
    tkey (the text's xxhash64) and root (an id of the group; null for an empty
    set). Two documents link when den * |intersection| >= num * |union|.

    Null and empty texts and texts without words have an empty set, 0 shingles
    and their own component. Equal sets are linked. Rows may repeat: each gives
    a row. A null doc_id is no smallest one; a group with no other id has null.
    Only the two named columns are read, whatever else ``docs`` has. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tkey"))
    sig = save(rows.mapInArrow(tidy(_signatures(n_words, num, den)),
                               "doc_id long, tkey long, n long, id long, keys array<long>, repeated array<long>"), "ngram-signatures", BATCH)
    classes = sig.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("first"))
    shared = save(graph.shared_keys(sig), "ngram-shared")
    # the texts of the items that have candidates: of their smallest doc_id, or of rows without one
    readers = save(classes.join(shared.select("id").distinct(), "id").select(F.col("first").alias("reader")).distinct(), "ngram-readers")
    found = rows.join(beside(readers), F.col("doc_id").eqNullSafe(F.col("reader")), "left_semi").select("text")
    sets = graph.once(save(found.mapInArrow(tidy(_sets(n_words)), "id long, n long, data binary"), "ngram-sets", BATCH))
    groups = graph.linked_groups(shared, sets, lambda raws: (np.frombuffer(raw, dtype=np.uint64) for raw in raws), num, den)
    firsts = classes.join(groups, "id", "left").select("id", "first", F.coalesce("root", "id").alias("root"))
    low = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    label = firsts.join(low, "root").select("id", "root", "component_id")
    slim = sig.select("doc_id", "tkey", F.col("n").alias("n_shingles"), "id")
    alone = slim.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "tkey", F.lit(None).cast("long").alias("root"))
    return slim.where("n_shingles > 0").join(label, "id").select(*alone.columns).unionByName(alone)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group of ``ngram_groups``: the one of
    the smallest doc_id (null last), then of the smallest hash of its text, and
    one only of rows equal in both. Documents without words all stay, as do null
    and empty texts; a null doc_id is no reason to go by itself; an empty table
    stays empty. All columns are kept, whatever their names."""
    groups = save(ngram_groups(docs, doc_id, text, n_words, num, den).where("root is not null").select("root", "doc_id", "tkey"), "ngram-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")
    first = groups.groupBy("root").agg(F.min(rank).alias("first"), F.count("*").alias("c")).where("c > 1")
    gone = groups.join(first, "root").where(rank != F.col("first")).select(F.col("doc_id").alias("gone_id"), F.col("tkey").alias("gone_key")).distinct()
    # whole rows beside their keys: no column of ``docs`` can clash with these
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), F.struct(*docs.columns).alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("tkey") == F.col("gone_key"))
    out = keyed.join(beside(save(gone, "ngram-gone")), same, "left_anti")
    again = groups.groupBy("doc_id", "tkey").count().where("count > 1").select(F.col("doc_id").alias("gone_id"), F.col("tkey").alias("gone_key"))
    again = save(again, "ngram-again")
    if not again.isEmpty():
        again = beside(again)
        once = out.join(again, same, "left_semi").dropDuplicates(["doc_id", "tkey"])
        out = out.join(again, same, "left_anti").unionByName(once)
    return out.select("row.*")


def op5_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents; word 3-grams, similarity 0.9."""
    return ngram_groups(scan(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
