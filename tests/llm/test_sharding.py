import random
import zlib
from collections import Counter, defaultdict

import pytest

from promofund.llm import sharding

MID = "/root/testdata/sf0.01"


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    got = sharding.op1_sharding(spark, MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots = defaultdict(list)
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.op1_sharding(spark, MID).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


@pytest.mark.parametrize("slack", [0.0, 0.1, 0.5])
def test_runs_keep_bounds_and_stay_clockwise(slack):
    rng = random.Random(1)
    counts = {p: rng.randrange(30) + 4000 * (p == 77) for p in rng.sample(range(sharding.RING), 900)}
    out = sharding.runs(counts, 10, slack)
    got, loads = defaultdict(int), Counter()
    for place, lo, hi, s, base in out:
        assert lo == got[place] and base == loads[s]
        got[place], loads[s] = hi, loads[s] + hi - lo
    assert dict(got) == {p: c for p, c in counts.items() if c}
    limit = sharding.bounds(sum(counts.values()), 10, slack)
    assert all(loads[s] <= limit[s] for s in range(10))
    # with room everywhere each place's rows go to the next virtual node
    nodes = sharding.virtual_nodes(10)
    free = sharding.runs(counts, 10, 100.0)
    assert all(s == next((x for q, x in nodes if q >= place), nodes[0][1]) for place, _, _, s, _ in free)


def test_a_further_shard_moves_few_rows():
    counts = dict.fromkeys(range(sharding.RING), 1)
    of = lambda n: {p: s for p, _, _, s, _ in sharding.runs(counts, n, 100.0)}
    a, b = of(24), of(25)
    moved = [p for p in counts if a[p] != b[p]]
    assert all(b[p] == 24 for p in moved) and len(moved) < 2 * sharding.RING / 25


def test_nulls_repeated_rows_long_texts_and_extra_columns(spark):
    rows = [(None, None, "x", 1)] * 5 + [(None, "é", "y", 2)] + [(7, "same", "z", None)] * 60 + [(8, "", None, 3), (9, "ab" * 100_000, "s", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, size int").repartition(3)
    out = sharding.shard(df, 4).collect()
    assert Counter(r.shard for r in out) == Counter(dict.fromkeys(range(4), 17))
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(n)) for s, n in Counter(r.shard for r in out).items())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        {(None, 8, 0): 5, (None, 10, zlib.crc32("é".encode())): 1, (7, 12, zlib.crc32(b"same")): 60, (8, 8, 0): 1, (9, 200_008, zlib.crc32(b"ab" * 100_000)): 1})
    assert sharding.shard(df.where("false"), 4).collect() == []


def test_overflow_goes_clockwise_row_by_row():
    """The runs equal a walk of every single row to the next virtual node with room."""
    rng = random.Random(7)
    for trial in range(25):
        n_shards, ring = rng.choice([2, 5, 24]), 64
        slack = rng.choice([0.0, 0.1])
        counts = {p: rng.choice([1, 2, 30]) for p in rng.sample(range(ring), rng.randrange(1, 40))}
        nodes = sharding.virtual_nodes(n_shards, 3, ring)
        room = sharding.bounds(sum(counts.values()), n_shards, slack)
        used, want = [0] * n_shards, {}
        for place in sorted(counts):
            first = next((k for k, (p, _) in enumerate(nodes) if p >= place), len(nodes))
            for rank in range(counts[place]):
                at = first
                while used[nodes[at % len(nodes)][1]] >= room[nodes[at % len(nodes)][1]]:
                    at += 1
                shard = nodes[at % len(nodes)][1]
                want[place, rank] = (shard, used[shard])
                used[shard] += 1
        got = {}
        for place, lo, hi, shard, base in sharding.runs(counts, n_shards, slack, 3, ring):
            got |= {(place, r): (shard, base + r - lo) for r in range(lo, hi)}
        assert got == want, trial
