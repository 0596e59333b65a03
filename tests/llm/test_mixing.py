import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm import helpers
from promofund.llm import mixing

MID = "/root/testdata/sf0.01"


def words(t):
    return len(helpers.WORD.findall(t or ""))


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.targets([10, 1000, 0], [5, 2, 1], 1.5, 2) == pytest.approx([20, 1495, 0])
    assert mixing.targets([], [], 1.5, 2) == []
    assert sum(mixing.targets([7, 3, 90, 4], [5, 2, 1, 5], 1.5, 2)) == pytest.approx(156)


def brute_flow(supply, members, quota, passes):
    """The least cost of the most flow, by trying all whole splits."""
    best = (0, 0)

    def go(p, left, sent, cost):
        nonlocal best
        if p == len(supply):
            best = max(best, (sent, -cost))
            return
        def split(k, rest, left, used):
            if k == len(members[p]):
                go(p + 1, left, sent + used, cost + sum(min(supply[p], max(0, used - i * supply[p])) * (i + 1) for i in range(passes)))
                return
            s = members[p][k]
            for x in range(min(rest, left[s]) + 1):
                split(k + 1, rest - x, [v - x * (i == s) for i, v in enumerate(left)], used + x)
        split(0, passes * supply[p], left, 0)

    go(0, list(quota), 0, 0)
    return best


def test_routes_are_min_cost():
    rng = random.Random(3)
    for _ in range(40):
        supply = [rng.randrange(4) for _ in range(3)]
        members = [sorted(rng.sample(range(2), rng.randrange(1, 3))) for _ in supply]
        quota = [rng.randrange(7) for _ in range(2)]
        flow = mixing.routes(supply, members, quota, 2)
        total = [sum(f for (q, _), f in flow.items() if q == p) for p in range(3)]
        assert all(sum(f for (_, s), f in flow.items() if s == k) <= quota[k] for k in range(2))
        cost = sum(min(c, t) + 2 * max(0, t - c) for c, t in zip(supply, total, strict=True))
        assert (sum(total), -cost) == brute_flow(supply, members, quota, 2)


def test_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    got = mixing.op4_mixing_to_target_weights(spark, MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    size, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == words(docs[r.doc_id].text) and 0 <= r.taken <= 2 * r["size"]
        size[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
        goal[docs[r.doc_id].source] = r.target
    assert all(r.source_size == size[docs[r.doc_id].source] for r in got)
    names = sorted(size)
    assert [goal[m] for m in names] == pytest.approx(mixing.targets([size[m] for m in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2))
    assert all(abs(taken[m] - goal[m]) <= 1 for m in names)
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in mixing.op4_mixing_to_target_weights(spark, MID).collect()}


def test_overlapping_sources_nulls_and_clashing_columns(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(40))), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a"], [None], [], None]), 3, "x")
            for i in range(400)]
    rows += [(None, None, ["a"], 1, "x"), (7, "\t \n", ["b"], 1, "x"), (8, "same words", ["a"], 1, "x"), (8, "same words", ["a"], 1, "x"), (9, "long " * 30_000, ["b"], 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, m array<string>, size int, sources string").repartition(3)
    out = mixing.mix_sources(df, F.col("m")).collect()
    assert len(out) == len(rows)
    by = defaultdict(lambda: [0, 0, 0])
    for r in out:
        assert r["size"] == words(r.text) and all(0 <= t <= r["size"] for t in r.takes) and len(r.takes) == 2
        key = tuple(sorted(set(r.m or []), key=lambda m: (m is None, m or "")))
        by[key][0] += r["size"]
        for k, t in enumerate(r.takes):
            by[key][1 + k] += t
    assert by[()][1:] == [0, 0]
    for key, (size, first, second) in by.items():
        assert second == 0 or abs(first - size) <= 4, key  # a second pass only after the first
    # a cut document, then whole ones, in the order of their rows
    kept = mixing.apply_mix(df, F.col("m"))
    assert kept.columns == df.columns
    assert sum(words(r.text) for r in kept.collect()) == sum(sum(r.takes) for r in out)
    assert mixing.mix_sources(df.where("false"), F.col("m")).collect() == []
