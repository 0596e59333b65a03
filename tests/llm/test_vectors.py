import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from promofund.llm import ann, topk
from promofund.llm.hilbert import hilbert_keys

MID = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def good(v, zero_ok):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and (zero_ok or any(v))


def brute(rows, every, k, score, zero_ok, best_first):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and good(v, zero_ok)})
    out = {}
    for i, v in rows:
        if i % every == 0:
            cand = sorted((best_first * score(v, w), j) for j, w in rows if j != i)
            out[i] = [(j, best_first * s) for s, j in cand[:k]]
    return out


def distance(v, w):
    return float(np.sqrt(((np.array(v, dtype=float) - np.array(w, dtype=float)) ** 2).sum()))


def product(v, w):
    return int(sum(int(np.floor(64 * float(a))) * int(np.floor(64 * float(b))) for a, b in zip(v, w, strict=True)))


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def odd_rows(seed=0, d=8):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=d).astype(np.float32)]) for i in range(300)]
    same = [float(x) for x in rng.normal(size=d).astype(np.float32)]
    rows += [(1000 + i, list(same)) for i in range(150)]
    near = np.array(same)
    rows += [(2000 + i, [float(x) for x in (near + 0.01 * rng.normal(size=d)).astype(np.float32)]) for i in range(60)]
    rows += [(5000, None), (5001, []), (5002, [None] * d), (5003, [float("nan")] * d), (5004, [float("inf")] * d), (5020, [0.0] * d), (5040, [-0.0] * d),
             (None, list(same)), (1000, list(same)), (5100, [1.0] * d), (5200, [1.0] * d), (6000, [1.0] * (d + 1))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA).repartition(3)


def test_hilbert_curve_visits_every_cell_by_single_steps():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    key = hilbert_keys(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_of_odd_rows(spark):
    rows = [(i, v) for i, v in odd_rows() if i != 6000]
    got = by_query(ann.nearest(frame(spark, rows), every=20))
    want = brute(rows, 20, 10, distance, False, 1)
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12, atol=0) for q in want)


def test_products_of_odd_rows(spark, monkeypatch):
    for name, n in (("BLOCK", 16), ("CHUNK", 4), ("GROUP", 8)):
        monkeypatch.setattr(topk, name, n)
    rows = [(i, v) for i, v in odd_rows() if i != 6000]
    assert by_query(topk.top_products(frame(spark, rows))) == brute(rows, 20, 20, product, True, -1)


def test_large_values_and_other_dimensions(spark):
    rows = [(i, [float(i) * 3e4, -float(i % 7) * 1e5]) for i in range(50)] + [(100, [1.0])]
    assert by_query(topk.top_products(frame(spark, rows))) == brute(rows[:-1], 20, 20, product, True, -1)


@pytest.mark.parametrize("op", [ann.nearest, topk.top_products])
def test_empty_and_single(spark, op):
    assert op(frame(spark, [])).collect() == []
    assert op(frame(spark, [(0, [1.0, 2.0])])).collect() == []
    assert [(r.query_id, r.vec_id) for r in op(frame(spark, [(0, [1.0, 2.0]), (3, [1.0, 2.0])])).collect()] == [(0, 3)]


def test_whole_table_products(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MID}/embeddings.parquet").collect()]
    assert by_query(topk.op8_exact_top_k(spark, MID)) == brute(rows, 20, 20, product, True, -1)


def test_clusters_let_most_blocks_be_skipped(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(30, 32))
    x = centre[rng.integers(0, 30, 6000)] + 0.15 * rng.normal(size=(6000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    stats = {}
    got = by_query(topk.top_products(df, every=100, stats=stats))
    q = np.floor(64 * x).astype(np.int64)
    for i, found in got.items():
        score = q @ q[i]
        score[i] = -(10**15)
        best = np.lexsort((np.arange(len(x)), -score))[:20]
        assert found == [(int(j), int(score[j])) for j in best]
    assert len(got) == 60 and stats["all"] == 60 * 94 and stats["scored"] < 0.3 * stats["all"]


def test_bounds_are_bounds():
    rng = np.random.default_rng(6)
    for scale in (3, 1000, 10**7):
        x = rng.integers(-scale, scale + 1, size=(40, 7))
        q = rng.integers(-scale, scale + 1, size=(25, 7))
        parts = [topk._pack("block")(pd.DataFrame({"block": [b] * 10, "id": range(10), "item": range(10), "ints": x[10 * b : 10 * b + 10].tolist()})) for b in range(4)]
        row = pd.concat(parts)
        cell = type("Cell", (), {"matrix": q.astype("<i8").tobytes(), "kind": "<i8", "width": 7, "least": b"".join(row["least"]), "most": b"".join(row["most"]),
                                 "centre": b"".join(row["centre"]), "radius": row["radius"].tolist()})
        most = np.stack([(q @ x[10 * b : 10 * b + 10].T).max(axis=1) for b in range(4)], axis=1)
        assert (topk._bounds(cell) >= most).all()


def test_recall_is_high_where_windows_are_a_small_part(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 16))
    x = centre[rng.integers(0, 40, 6000)] + 0.3 * rng.normal(size=(6000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = by_query(ann.nearest(df, block=128).select("query_id", "rank", "vec_id", F.col("score")))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {j for j, _ in found})
    assert hits >= 0.9 * 10 * len(got)


@pytest.mark.parametrize("n", [1500, 6000, 24000])
def test_recall_holds_as_an_unclustered_table_grows(spark, n):
    # windows of 64-item blocks hold at most 16 * 3 * 64 items: all, 51% and 13% of the three tables
    x = np.random.default_rng(n).normal(size=(n, 24))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": list(x)}))
    every = n // 100
    got = by_query(ann.nearest(df, every=every, block=64))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {j for j, _ in found})
    assert len(got) == len(range(0, n, every))
    assert hits >= 0.9 * 10 * len(got)


def test_windows_widen_by_blocks_and_then_by_reach(monkeypatch):
    monkeypatch.setattr(ann, "WIDEST", 16)
    probe = np.arange(50)
    of = np.zeros((50, 2), dtype=int) + 1000
    assert ann.window_size(of, of + 3, probe, 8) == (8, 1)
    assert ann.window_size(of, of + np.array([400, 20]), probe, 8) == (16, 1)
    block, reach = ann.window_size(of, of + np.array([400, 100]), probe, 8)
    assert block == 16 and 6 <= reach <= 9  # the nearer of the two curves decides
    assert ann.window_size(np.empty((0, 0)), np.empty((0, 0)), np.empty(0, int), 8) == (8, 1)
