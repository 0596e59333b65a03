import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from promofund.llm import manifest
from promofund.llm.common import save

MID = "/root/testdata/sf0.01"


def digest(text):
    return sha256(text.encode()).hexdigest()


def tree(nodes, fanout):
    """The root and, per leaf, the siblings (left, right) of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            first = p // fanout * fanout
            run = nodes[first : first + fanout]
            paths[k].append((run[: p - first], run[p - first + 1 :]))
            at[k] = p // fanout
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], paths


def leaf(r, more=0):
    n_chars = None if r.n_chars is None else r.n_chars + more
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n_chars, r.text)))


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        group = sorted(groups[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees.append((group, *tree([leaf(r) for r in group], fanout)))
    if not trees:
        return []
    root, tops = tree([t[1] for t in trees], fanout)
    out = []
    for (group, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(group, paths, strict=True):
            struck = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            at = leaf(r, int(struck))
            for left, right in path + top:
                at = digest("".join(left) + at + "".join(right))
            proof = digest("".join("".join(a + b) for a, b in path + top))
            out.append((r.doc_id, leaf(r), subroot, root, proof, at, at == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_whole_table(spark):
    got = manifest.op12_merkle_manifest(spark, MID).collect()
    want = brute(spark.read.parquet(f"{MID}/documents.parquet").collect())
    assert ordered(got) == ordered(want)
    struck = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 7 == 0]
    assert struck and not any(r.verified for r in struck)
    assert all(r.verified for r in got if r not in struck)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __at string, idx int, __tie int"


def check(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = manifest.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert ordered(got) == ordered(brute(docs.collect()))
    return got


def test_odd_rows(spark, tmp_path):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(21)]
    rows += [(7, "t7", "en", "s", 7)] * 3  # repeated rows are leaves of their own
    rows += [(None, None, None, None, None), (30, "", "", "", 0), (31, "ü" * 200_000, "zh", None, None), (None, "x", "en", "s", 1)]
    got = check(spark, tmp_path, rows)
    assert len(got) == len(rows)


def test_one_leaf_and_none(spark, tmp_path):
    (only,) = check(spark, tmp_path, [(1, "a", "en", "s", 1)])
    assert only.root == only.subroot == only.leaf and only.proof_sha256 == digest("")
    assert check(spark, tmp_path, []) == []


@pytest.mark.parametrize("fanout", [3, 4])
def test_other_fanouts_and_several_strides(spark, monkeypatch, fanout):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rng = random.Random(fanout)
    rows = [(rng.choice("abcdefgh"), k, digest(str(rng.random())), None) for k in range(150)]
    leaves = save(spark.createDataFrame(rows, "lang string, key long, leaf string, altered string"), "test-leaves")
    got = manifest.prove(leaves, "lang", fanout).withColumn("end", manifest.fold(F.col("leaf"), F.col("path"))).collect()
    groups = {g: sorted(r[1:3] for r in rows if r[0] == g) for g in sorted({r[0] for r in rows})}
    trees = {g: tree([d for _, d in v], fanout) for g, v in groups.items()}
    root, tops = tree([t[0] for t in trees.values()], fanout)
    want = {k: (trees[g][0], [("".join(a), "".join(b)) for a, b in p + top])
            for (g, v), top in zip(groups.items(), tops, strict=True) for (k, _), p in zip(v, trees[g][1], strict=True)}
    assert {r.key: (r.subroot, [tuple(s) for s in r.path]) for r in got} == want
    assert all(r.root == r.end == root for r in got)


def test_records_are_addressed_by_content(spark):
    rows = [("g", k, k, digest(str(k % 4))) for k in range(64)]  # equal subtrees are stored once
    leaves = save(spark.createDataFrame([(0, k, 64, d) for _, k, _, d in rows], "grp long, idx long, n long, digest string"), "test-leaves")
    nodes = manifest.build(leaves).nodes().collect()
    assert all(r.digest == digest("".join(r.children)) for r in nodes)
    assert len(nodes) == 2 + 5  # two different pairs, then one node a level
