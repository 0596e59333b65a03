"""Line deduplication: equal and nearly equal lines, one line of each group kept.

A line's set holds the hashes of its distinct runs of 8 characters. A one
permutation MinHash signature of the set gives BANDS keys of ROWS values each
(a pair at similarity 0.8 is missed with probability (1 - 0.8**4)**12 < 0.2 %);
lines that share a key are verified by their exact Jaccard similarity and
grouped by a distributed union-find (``graph.linked_groups``). Equal lines are
one item throughout. Of each group the first line stays, by doc_id, then text,
then line number.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promofund.llm import graph
from promofund.llm.common import BATCH, beside, save, scan, tidy
from promofund.llm.textgrams import chunks, list_array, mix

CHARS, ROWS, BANDS = 8, 4, 12
BINS = ROWS * BANDS
#: Lines whose signatures a task remembers as sent.
MEMORY = 500_000
#: Bytes of text that a task works on at once.
SLICE = 1 << 19
#: Bytes of lines whose shingles are hashed at once.
PIECE = 1 << 16

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_S32 = np.uint64(32)


def line_id(line: bytes) -> int:
    """A positive 63-bit id of a line (0: a blank one)."""
    if not line or line.isspace():
        return 0
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little") >> 1 or 1


def runs_of(chars: np.ndarray) -> np.ndarray:
    """A hash of every run of CHARS consecutive characters (of all, at its start)."""
    two = chars[:-1] << np.uint64(21)
    two |= chars[1:]
    four = two[:-2] * np.uint64(0x9E3779B97F4A7C15)
    four += two[2:]
    eight = four[:-4] * np.uint64(0xC2B2AE3D27D4EB4F)
    eight += four[4:]
    return mix(eight)


def pieces(lines: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of lines of about PIECE bytes together: arrays that stay in a core's cache."""
    part, size = [], 0
    for line in lines:
        if part and size + len(line) > PIECE:
            yield part
            part, size = [], 0
        part.append(line)
        size += len(line) + 1
    if part:
        yield part


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of CHARS characters of the given lines, one line after
    the other, and how many each line has."""
    joined = b"\n".join(lines)
    chars = np.frombuffer(joined, np.uint8) if joined.isascii() else np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    cuts = np.flatnonzero(chars == 10)
    n = np.maximum(np.diff(cuts, prepend=-1, append=len(chars)) - CHARS, 0)
    h = runs_of(chars.astype(np.uint64))
    across = (cuts[:, None] - np.arange(CHARS)).reshape(-1)
    inside = np.ones(len(h), dtype=bool)
    inside[across[(across >= 0) & (across < len(h))]] = False
    return h[inside], n


def decode(lines: list[bytes]) -> Iterator[np.ndarray]:
    """The set of each line: the sorted distinct hashes of its runs of CHARS."""
    for part in pieces(lines):
        h, n = shingles(part)
        ends = np.cumsum(n)
        for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True):
            h[a:b].sort()
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = h[1:] != h[:-1]
        keep[(ends - n)[n > 0]] = True
        at = np.append(0, np.cumsum(keep))[np.append(0, ends)].tolist()
        h = h[keep]
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield h[a:b]


def band_keys(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The BANDS keys of n lines from the hashes of their shingles; each line
    must have one at least."""
    sig = np.full(n * BINS, _EMPTY)
    place = values >> _S32
    place *= np.uint64(BINS)
    place >>= _S32
    place += (owner * BINS).astype(np.uint64)
    np.minimum.at(sig, place.astype(np.int64), values)
    # an empty bin copies another bin of its line, chosen by hash
    known = sig != _EMPTY
    open_bins = np.flatnonzero(~known)
    for turn in range(1, 4 * BINS):
        if not len(open_bins):
            break
        col = open_bins % BINS
        choice = (mix(np.arange(BINS * turn, BINS * (turn + 1), dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64)
        take = open_bins - col + choice[col]
        good = known[take]
        sig[open_bins[good]] = sig[take[good]] ^ np.uint64(0x5851F42D4C957F2D)
        open_bins = open_bins[~good]
    if len(open_bins):
        sig[open_bins] = sig.reshape(n, BINS).min(axis=1)[open_bins // BINS]
    bands = sig.reshape(n, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS))
    for r in range(ROWS):
        key = mix((key ^ bands[:, :, r]) + np.uint64(r + 1))
    return key


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (doc_id, tkey, text) to (doc_id, tkey, lines), lines being
    a list of (id, keys, repeated); keys once a task for equal lines."""
    seen: set[int] = set()
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column(2), SLICE):
            raw, bounds = data.tobytes(), offsets.tolist()
            texts = [raw[x:y].split(b"\n") for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            ids, new, fresh = [], [], []
            for line in itertools.chain.from_iterable(texts):
                x = line_id(line)
                if x and len(line) >= CHARS and x not in seen:
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen.add(x)
                    new.append(len(ids))
                    fresh.append(line)
                ids.append(x)
            each = np.zeros(len(ids), dtype=np.int64)
            parts, at = [np.empty(0, np.uint64)], 0
            for part in pieces(fresh):
                values, n = shingles(part)
                full = np.flatnonzero(n)  # the others are under CHARS characters long
                if len(full):
                    parts.append(band_keys(values, np.repeat(np.arange(len(full)), n[full]), len(full)).reshape(-1))
                    each[np.array(new[at : at + len(part)])[full]] = BANDS
                at += len(part)
            keys = np.concatenate(parts)
            send, repeated = graph.local_repeats(keys)
            owner = np.repeat(np.arange(len(each)), each)
            fields = [pa.array(ids, pa.int64()), *(list_array(keys[m], np.bincount(owner[m], minlength=len(each))) for m in (send, repeated))]
            rows = pa.StructArray.from_arrays(fields, ["id", "keys", "repeated"])
            ends = pa.array(np.append(0, np.cumsum([len(lines) for lines in texts])), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                                              pa.ListArray.from_arrays(ends, rows)], ["doc_id", "tkey", "lines"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (text, need) to (id, n, data) of the lines (line number,
    id) in ``need``, each once a task; data is the line in UTF-8."""
    seen: set[int] = set()
    for batch in batches:
        ids, raws = [], []
        for text, need in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
            lines = text.split(b"\n")
            for spot in need:
                if spot["id"] not in seen:
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen.add(spot["id"])
                    ids.append(spot["id"])
                    raws.append(lines[spot["line"]])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) for x in decode(raws)], pa.int64()),
                                              pa.array(raws, pa.binary())], ["id", "n", "data"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with ``text`` less its duplicate lines, and with ``n_lines`` and
    ``n_removed`` (long).

    Lines end at \\n. Two lines are duplicates when they are equal or their sets
    of 8-character runs have a Jaccard similarity of num / den or more; groups
    are closed under this relation, and one line of a group stays. Blank lines
    always stay. Lines of under 8 characters are duplicates only if equal. A
    null text stays null (no lines). Rows equal in doc_id and text count as one
    document: all keep the same lines. A null doc_id comes after all others.
    Other columns are kept (columns named n_lines or n_removed are replaced); an
    empty table gives an empty result.
    """
    key = "__tkey"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"),
                       F.col(text).alias("text")).where("text is not null")
    sig = save(rows.mapInArrow(tidy(_signatures), "doc_id long, tkey long, lines array<struct<id: long, keys: array<long>, repeated: array<long>>>"),
               "line-signatures", BATCH)
    shared = save(graph.shared_keys(sig.select(F.explode("lines").alias("l")).select("l.id", "l.keys", "l.repeated")), "line-shared")
    spots = sig.select("doc_id", "tkey", F.posexplode(F.col("lines.id")).alias("line", "id")).where("id != 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey", "line")
    firsts = save(spots.groupBy("id").agg(F.min(order).alias("first"), F.count("*").alias("c")), "line-firsts")
    wanted = firsts.join(shared.select("id").distinct(), "id")
    needs = save(wanted.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.tkey").alias("tkey"))
                 .agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "id")).alias("need")), "line-needs")
    match = rows.join(beside(needs.withColumnsRenamed({"doc_id": "d", "tkey": "k"})),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k")))
    sets = graph.once(save(match.select("text", "need").mapInArrow(tidy(_sets), "id long, n long, data binary"), "line-sets", BATCH))
    groups = graph.linked_groups(shared, sets, decode, num, den)
    # lines that occur once and have no link stay
    labelled = (firsts.join(groups, "id", "left").where("c > 1 or root is not null")
                .select("id", "first", "c", F.coalesce("root", "id").alias("root")))
    keepers = labelled.groupBy("root").agg(F.min("first").alias("kept"), F.sum("c").alias("n")).where("n > 1")
    repeated = labelled.join(keepers, "root").select("id", "kept")
    removed = (spots.join(repeated, "id").where(order != F.col("kept"))
               .groupBy("doc_id", "tkey").agg(F.collect_set("line").alias("__gone")))
    removed = save(removed.select(F.col("doc_id").alias("__d"), F.col("tkey").alias("__k"), "__gone"), "line-removed")
    cut = F.split(F.col(text), "\n", -1)
    out = (docs.withColumn(key, F.xxhash64(text))
           .join(beside(removed), F.col(doc_id).cast("long").eqNullSafe(F.col("__d")) & (F.col(key) == F.col("__k")), "left"))
    kept = F.array_join(F.filter(cut, lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    ends = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    return (out.withColumn("n_lines", F.coalesce(ends + 1, F.lit(0)).cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
            .withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
            .drop(key, "__d", "__k", "__gone"))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, the text that is left, n_lines, n_removed."""
    docs = scan(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")
