import random

import pytest
from pyspark.sql import functions as F

from llm import helpers
from promofund.llm import graph, ngram_join
from promofund.llm.textgrams import mix

MID = "/root/testdata/sf0.01"


def groups(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, n int, keys string").repartition(3)
    return sorted(tuple(r) for r in ngram_join.ngram_groups(df, **kw).select("doc_id", "n_shingles", "component_id").collect())


def pad(rows):
    return [(i, t, "x", 1, None) for i, t in rows]


@pytest.mark.parametrize("n_words,num", [(3, 90), (5, 80)])
def test_whole_table_equals_brute_force(spark, n_words, num):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_groups(docs, n_words=n_words, num=num).collect()}
    assert got == helpers.ngram_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], n_words, num, 100)


def edited_copies(seed, copies, length, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,length,edits", [(1, 60, 3), (2, 200, 8), (3, 15, 1), (4, 700, 30)])
def test_large_group_of_near_copies(spark, seed, length, edits):
    rows = edited_copies(seed, 150, length, edits) + [(1000 + i, t) for i, t in edited_copies(seed + 50, 40, length, edits)]
    want = helpers.ngram_groups(rows, 3, 90, 100)
    assert groups(spark, pad(rows)) == sorted((i, *v) for i, v in want.items())


def test_blocks_settle_what_leaders_miss(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_ITEMS", 7)
    rows = edited_copies(9, 120, 120, 7)
    want = helpers.ngram_groups(rows, 3, 90, 100)
    assert groups(spark, pad(rows)) == sorted((i, *v) for i, v in want.items())


def test_nulls_empty_short_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "two one"), (7, "É"), (8, "é"),
            (9, "a b c d"), (9, "a b c d"), (None, "a b c d"), (None, "only null ids here now"), (9, "one two"), (10, "x y\x85z"),
            (11, "x y z"), (12, "y " * 30000), (13, "y y y")]
    got = groups(spark, [r for r in pad(rows) if r[0] is not None])
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got
    assert [x for x in got if x[0] in (4, 5)] == [(4, 1, 4), (5, 1, 4)]
    assert (6, 1, 6) in got and (7, 1, 7) in got and (8, 1, 8) in got
    assert [x for x in got if x[0] == 9] == [(9, 1, 4), (9, 2, 9), (9, 2, 9)]
    assert (10, 1, 10) in got and (11, 1, 11) in got and (12, 1, 12) in got and (13, 1, 12) in got
    df = spark.createDataFrame(pad(rows), "doc_id long, text string, id string, n int, keys string")
    null = sorted((r.n_shingles, r.component_id or -1) for r in ngram_join.ngram_groups(df).where("doc_id is null").collect())
    assert null == [(2, 9), (3, -1)]


def test_empty_table(spark):
    assert groups(spark, []) == []


def test_range_keys_meet_at_the_threshold():
    import numpy as np
    rng = np.random.default_rng(0)
    for trial in range(300):
        n = int(rng.integers(1, 900))
        num, den = [(90, 100), (80, 100)][trial % 2]
        base = mix(rng.integers(1, 2**62, 2 * n + 400).astype(np.uint64))
        most = next(k for k in range(n, -1, -1) if den * (n - k) >= num * n)  # leave out k of n
        a, b = np.sort(base[:n]), np.sort(base[most:n])
        keys = [set(ngram_join.range_keys(x, np.array([len(x)]), num, den)[1].tolist()) for x in (a, b) if len(x)]
        assert len(keys) < 2 or keys[0] & keys[1]


def test_unrelated_short_sets_share_no_key():
    import numpy as np
    rng = np.random.default_rng(1)
    for num in (80, 90):
        for n in (*range(1, 31), 45, 80, 150):
            count = 3000
            sizes = np.full(count, n)
            h = np.sort(mix(rng.integers(1, 2**62, (count, n)).astype(np.uint64)), axis=1).reshape(-1)
            owner, key = ngram_join.range_keys(h, sizes, num, 100)
            assert np.unique(owner).size == count  # every set sends a key
            per_key = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1)[1]
            assert np.unique(per_key, return_counts=True)[1].max() <= 2, (num, n)


def test_pairs_whose_equal_ranges_are_empty_still_meet():
    import numpy as np
    rng = np.random.default_rng(2)
    for trial in range(4000):
        n = int(rng.integers(4, 40))
        base = mix(rng.integers(1, 2**62, n + 12).astype(np.uint64))
        d = next(k for k in range(n, -1, -1) if 100 * (n - k) >= 80 * (n + k))  # exchange k of n
        a, b = np.sort(base[:n]), np.sort(np.concatenate([base[: n - d], base[n : n + d]]))
        keys = [set(ngram_join.range_keys(x, np.array([len(x)]), 80, 100)[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1], (trial, n, d)


def test_unrelated_short_texts_make_no_clump(spark):
    """Texts of 12 to 16 words with nothing in common: no candidate pair is left to compare."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(10**7)}" for _ in range(rng.randrange(12, 17)))) for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sig = df.select("doc_id", "text", F.xxhash64("text").alias("tkey")).mapInArrow(
        ngram_join._signatures(5, 80, 100), "doc_id long, tkey long, n long, id long, keys array<long>, repeated array<long>")
    from promofund.llm.common import save
    assert graph.shared_keys(save(sig, "test-signatures")).count() < 20
    got = ngram_join.ngram_groups(df, n_words=5, num=80)
    assert got.where("component_id != doc_id").count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.root for r in graph.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
    assert graph.components(df.where(F.lit(False))).collect() == []
