"""Best-fit packing of tokenised documents by a configuration linear program.

Spark tokenises the texts, counts the pieces by length and later deals the
pieces out; the driver only ever sees the histogram, which has at most
``capacity`` lengths however large the table is. On it, a configuration (how
many pieces of which lengths share a sequence) has a variable, and every length
must be covered:

* prices by multiplicative weights: a length that is covered more than its
  share gets cheaper;
* pricing by the unbounded knapsack's dynamic program over the capacity, which
  gives the best configuration for each length that it may start with;
* rounding: configurations are used as often as the average solution says
  (rounded up, to the nearest or down, whichever ends with the fewest sequences)
  and the counts allow, the fullest first, and what is left is packed best fit
  decreasing, on counts of equal bins.

Pieces of one length are exchangeable. So the plan is a small table (length,
first rank, last rank, sequences), and a piece finds its place by its rank
among the pieces of its length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promofund.llm.common import BATCH, beside, rank_buckets, running_totals, save, scan, tidy
from promofund.llm.textgrams import LOWER, byte_hashes, chunks, mix

CAPACITY = 4096
#: The id that ends every document.
END_ID = 1
#: Rounds of multiplicative weights, and how strongly a round changes prices.
TURNS, RATE = 10, 0.5
#: Most units whose ids a task remembers.
UNITS = 1_500_000
#: Bytes of text tokenised at a time: a task takes some hundred times as much.
CHUNK = 1 << 18

# what the tokenizer's own splitting does with single bytes: space separates,
# runs of letters and runs of punctuation are words, digits are words each
_SPACE, _LETTER, _DIGIT, _PUNCT, _ODD = range(5)
_CLASS = np.full(256, _ODD, dtype=np.uint8)
_CLASS[33:127] = _PUNCT
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE


class Ids:
    """Token ids of texts.

    The tokenizer lowers letters, drops white space and encodes every word by
    itself. Texts made of ASCII and Latin-1 letters are cut into words on their
    bytes; a white-space separated chunk with anything else (or an apostrophe
    before a letter) is one unit, encoded as it is. Units are known by a 64-bit
    hash; each new one is encoded once by the tokenizer: words in one call, as
    every word's last token is marked in the vocabulary.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would each keep memory of their own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # hashes, sorted
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)  # their ids in the store
        self.store, self.used = np.empty(1 << 16, np.uint32), 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids, one after the other, and how many each has."""
        flat, n = [], []
        for a in range(0, len(words), 2000):
            part = words[a : a + 2000]
            ids = self.encode([b" ".join(part).decode()])[0]
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):  # not one word each after all
                each = self.encode([w.decode() for w in part])
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            flat.append(ids)
            n.append(np.diff(ends, prepend=0))
        return np.concatenate([np.empty(0, np.uint32), *flat]), np.concatenate([np.empty(0, np.int64), *n])

    def _learn(self, hashes: np.ndarray, units: list[bytes], words: np.ndarray) -> None:
        word, other = np.flatnonzero(words), np.flatnonzero(~words)
        ids, counts = self._encode_words([units[i] for i in word.tolist()])
        rest = self.encode([units[i].decode() for i in other.tolist()])
        flat = np.concatenate([ids, *rest])
        order = np.argsort(np.concatenate((word, other)))  # words first in the store
        n = np.concatenate((counts, np.array([len(x) for x in rest], dtype=np.int64)))
        start = (np.cumsum(n) - n)[order]
        n = n[order]
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate((self.store, np.empty_like(self.store)))
        self.store[self.used : self.used + len(flat)] = flat
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.at = np.insert(self.at, place, self.used + start)
        self.n = np.insert(self.n, place, n)
        self.used += len(flat)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk of texts, and the number of each text's ids."""
        cls = _CLASS[data]
        low = LOWER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # Latin-1 letters, but not the signs of times and division
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        cls[lead] = cls[lead + 1] = _LETTER
        upper = lead[data[lead + 1] < 0x9F] + 1
        low[upper] += 0x20
        quote = np.flatnonzero((data[:-1] == 39) & (cls[1:] != _SPACE) & (cls[1:] != _PUNCT) & (cls[1:] != _DIGIT))
        cls[quote] = _ODD
        solid = cls != _SPACE
        first = np.zeros(len(data), dtype=bool)  # of a text
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | first[1:]
        chunk = np.flatnonzero(begins)
        if not len(chunk):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, dtype=np.int64)
        inside = np.flatnonzero(solid)
        whole = np.zeros(len(inside), dtype=bool)
        if (cls == _ODD).any():
            odd = np.logical_or.reduceat(cls == _ODD, chunk)
            whole = np.repeat(odd, np.diff(np.append(np.searchsorted(inside, chunk), len(inside))))
        own = cls[inside]
        cut = begins[inside]
        change = np.zeros(len(inside), dtype=bool)
        change[1:] = (own[1:] != own[:-1]) | (own[1:] == _DIGIT)
        cut |= change & ~whole
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(inside)))
        byte = np.where(whole, data[inside], low[inside])
        h = np.add.reduceat(byte_hashes(inside - np.repeat(inside[start], length), byte), start)
        h = mix(h + length.astype(np.uint64) + whole[start] * np.uint64(1 << 40))
        unit, one, inverse = np.unique(h, return_index=True, return_inverse=True)
        new = np.arange(len(unit))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, unit), len(self.known) - 1)
            new = np.flatnonzero(self.known[at] != unit)
        if len(self.known) + len(new) > UNITS:
            self._forget()
            new = np.arange(len(unit))
        if len(new):
            raw, spot = byte.tobytes(), start[one[new]].tolist()
            self._learn(unit[new], [raw[s : s + k] for s, k in zip(spot, length[one[new]].tolist(), strict=True)],
                        (own[start[one[new]]] == _LETTER) & ~whole[start[one[new]]])
        at = np.searchsorted(self.known, unit)
        n = self.n[at][inverse]
        ids = self.store[np.arange(int(n.sum())) + np.repeat(self.at[at][inverse] - (np.cumsum(n) - n), n)]
        ends = np.append(0, np.cumsum(n))
        return ids, np.diff(ends[np.searchsorted(inside[start], offsets)])


def _pieces(path: str, capacity: int):
    """Arrow batches (doc_id, text) to (doc_id, piece, start, length,
    ids_crc32, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = Ids(path), np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for a, b, _, _ in chunks(batch.column(1)):
                part, rows = batch.slice(a, b - a), []
                for first, _, data, offsets in chunks(part.column(1), CHUNK):
                    ids, counts = coder.of(data, offsets)
                    raw, at = ids.astype("<u4").tobytes(), 0
                    for n, count in enumerate(counts.tolist(), first):
                        own = raw[at : at + 4 * count] + end
                        at += 4 * count
                        rows += [(n, k, k * capacity, min(capacity, count + 1 - k * capacity), zlib.crc32(own[4 * capacity * k : 4 * capacity * (k + 1)]))
                                 for k in range(-(-(count + 1) // capacity))]
                n, piece, start, length, crc = np.array(rows, dtype=np.int64).T
                doc = part.column(0).take(pa.array(n))
                frame = pd.DataFrame({"d": doc.fill_null(-1).to_numpy(), "p": piece, "c": crc})
                copy = frame.groupby(["d", "p", "c"]).cumcount().to_numpy()  # equal rows differ in their salt
                salt = frame["d"].to_numpy().astype(np.uint64)
                for x in (piece, crc, copy):
                    salt = mix(salt + mix(x.astype(np.uint64) + np.uint64(1)))
                yield pa.RecordBatch.from_arrays(
                    [doc, *(pa.array(x, pa.int64()) for x in (piece, start, length, crc)), pa.array((salt >> np.uint64(1)).view(np.int64))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return run


#: A configuration: how many pieces of each length share a sequence, longest first.
Configuration = tuple[tuple[int, int], ...]


def best_fills(prices: np.ndarray, capacity: int) -> list[Configuration]:
    """The unbounded knapsack: for every room 0..capacity the lengths that fit
    and have the highest sum of prices; of equal ones, those with the longest."""
    best, fill = np.zeros(capacity + 1), [()] * (capacity + 1)
    for room in range(1, capacity + 1):
        value = best[:room] + prices[room:0:-1]  # best[r] + prices[room - r]
        r = int(value.argmax())  # the first: the longest length
        if value[r] > best[room - 1] + 1e-12:
            best[room], fill[room] = value[r], _with(fill[r], room - r)
        else:
            best[room], fill[room] = best[room - 1], fill[room - 1]
    return fill


def _with(p: Configuration, length: int, n: int = 1) -> Configuration:
    """``p`` and n more pieces of a length."""
    counts = dict(p)
    counts[length] = counts.get(length, 0) + n
    return tuple(sorted(counts.items(), reverse=True))


def _used(p: Configuration) -> int:
    return sum(x * c for x, c in p)


def fractional(counts: np.ndarray, capacity: int) -> dict[Configuration, float]:
    """An approximate solution of the configuration program for counts[length],
    as configuration -> sequences, covering each length about once."""
    lengths = np.flatnonzero(counts)
    n = counts[lengths].astype(float)
    price = lengths / capacity
    total: dict[Configuration, float] = {}
    covered = np.zeros(capacity + 1)
    for _ in range(TURNS):
        prices = np.full(capacity + 1, -1.0)
        prices[lengths] = price
        fills = best_fills(prices, capacity)
        gain = np.zeros(capacity + 1)
        used_now: dict[Configuration, float] = {}
        for length, own in zip(lengths.tolist(), n.tolist(), strict=True):
            p = _with(fills[capacity - length], length)
            used = own / dict(p)[length]
            used_now[p] = used_now.get(p, 0.0) + used
            for x, c in p:
                gain[x] += used * c
        scale = (n @ lengths) / (gain[lengths] @ lengths)  # each round covers all mass once
        covered += gain * scale
        for p, used in used_now.items():
            total[p] = total.get(p, 0.0) + used * scale
        share = gain[lengths] * scale / n
        price = np.maximum(price * np.exp(-RATE * (np.minimum(share, 4.0) - 1.0) / 4.0), 1e-4)
        price *= (lengths @ n) / ((price @ n) * capacity)
    lift = np.divide(counts, covered, out=np.zeros(capacity + 1), where=covered > 0)
    return {p: u * sum(lift[x] * c for x, c in p) / sum(c for _, c in p) for p, u in total.items()}


def rounded(counts: np.ndarray, solution: dict[Configuration, float], capacity: int) -> list[tuple[Configuration, int]]:
    """Whole numbers of sequences by configuration that use every piece: of
    rounding up, to the nearest and down, what takes the fewest sequences. The
    fullest configurations come first; what is left is packed best fit
    decreasing."""
    order = [p for p in sorted(solution, key=lambda p: (-_used(p), sum(c for _, c in p), p)) if _used(p) >= capacity - capacity // 256]
    plans = []
    for up in (1.0 - 1e-9, 0.5, 0.0):
        left = counts.tolist()
        plan: list[tuple[Configuration, int]] = []
        for p in order:
            k = min(int(solution[p] + up), *(left[x] // c for x, c in p))
            if k > 0:
                plan.append((p, k))
                for x, c in p:
                    left[x] -= c * k
        plans.append(plan + best_fit_decreasing(np.array(left, dtype=np.int64), capacity))
    return min(plans, key=lambda plan: sum(k for _, k in plan))


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Best fit decreasing on counts: equal bins are one entry, so the work
    depends on the number of lengths, not of pieces."""
    open_bins: dict[int, dict[Configuration, int]] = {}  # by room: configuration -> bins
    rooms: list[int] = []
    done: list[tuple[Configuration, int]] = []

    def put(p, k, room):
        if room == 0:
            done.append((p, k))
            return
        if room not in open_bins:
            open_bins[room] = {}
            insort(rooms, room)
        open_bins[room][p] = open_bins[room].get(p, 0) + k

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length  # new bins, filled with this length alone
                if n >= each:
                    put(((length, each),), n // each, capacity - each * length)
                if n % each:
                    put(((length, n % each),), 1, capacity - (n % each) * length)
                break
            room = rooms[i]
            p, k = next(iter(open_bins[room].items()))
            each = room // length
            full = min(k, n // each)
            used = full or 1
            if used == k:
                del open_bins[room][p]
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(i)
            else:
                open_bins[room][p] = k - used
            add = each if full else n
            put((*p, (length, add)), used, room - add * length)
            n -= add * used
    return done + [(p, k) for by in open_bins.values() for p, k in by.items()]


def allocation(plan: list[tuple[Configuration, int]]) -> pd.DataFrame:
    """For every length and range of ranks: the first sequence, pieces of the
    length in a sequence, and the offset of the first of them."""
    rows, taken, sequence = [], {}, 0
    for p, k in plan:
        offset = 0
        for x, c in p:
            at = taken.get(x, 0)
            rows.append((x, at, at + c * k, c, sequence, offset))
            taken[x] = at + c * k
            offset += c * x
        sequence += k
    return pd.DataFrame(rows, columns=["len", "lo", "hi", "each", "seq", "off"], dtype="int64")


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Per piece of ``docs``: doc_id, piece (int, from 0), start, length,
    ids_crc32, sequence_id and offset (long).

    A document is its text's token ids and END_ID; null and empty texts are
    END_ID alone. Longer ones are cut into pieces of ``capacity`` ids. Pieces
    of a sequence lie one after the other from offset 0. Rows may repeat and
    doc_id may be null: each row is packed. Other columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = save(rows.mapInArrow(tidy(_pieces(tokenizer_path, capacity)),
                                  "doc_id long, piece long, start long, length long, ids_crc32 long, salt long"), "pieces", BATCH)
    counts, n_rows = np.zeros(capacity + 1, dtype=np.int64), 0
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
        n_rows += n
    plan = rounded(counts, fractional(counts, capacity), capacity) if n_rows else []
    table = allocation(plan)
    # as Arrow: a pandas frame would start a second set of Python workers, which stay on the executors
    places = beside(save(spark.createDataFrame(pa.Table.from_pandas(table, preserve_index=False)), "packing-plan"))
    ranked = running_totals(pieces, ["length"], "salt", F.lit(1), rank_buckets(n_rows), out="rank")
    step = F.col("rank") - F.col("lo")
    return (ranked.join(places, (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32",
                    (F.col("seq") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("off") + F.pmod(step, F.col("each")) * F.col("length")).cast("long").alias("offset")))


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, 4096 ids a sequence, by the word-piece vocabulary of 49k."""
    import public_tokenizers

    return pack(scan(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
