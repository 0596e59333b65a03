import random
import tracemalloc

import numpy as np
import pyarrow as pa

from llm import helpers
from promofund.llm import line_dedup

MID = "/root/testdata/sf0.01"


def shingles(line):
    return frozenset(line[i : i + 8] for i in range(len(line) - 7))


def brute(rows):
    """rows: (doc_id, text), doc_ids distinct and not null. {doc_id: text left}."""
    first = {}
    for i, t in sorted(rows):
        for n, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                first.setdefault(line, (i, n))
    lines = sorted(first, key=first.get)
    pairs = helpers.similar_pairs([shingles(x) for x in lines], 80, 100)
    comp = helpers.components(range(len(lines)), pairs)
    keep = {x: first[lines[comp[k]]] for k, x in enumerate(lines)}
    return {i: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if keep.get(x, (i, n)) == (i, n)) for i, t in rows}


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n_lines int, id string").repartition(3)
    out = line_dedup.dedup_lines(df)
    assert set(out.columns) == {"doc_id", "text", "n_lines", "id", "n_removed"}
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.text for r in line_dedup.op9_line_dedup(spark, MID).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    wrong = [i for i in want if want[i] != got[i]]
    assert len(got) == len(want) and len(wrong) <= 2, wrong  # banding may miss a pair close to 0.8


def test_groups_of_equal_and_near_lines(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    base = [word() for _ in range(60)]
    rows = []
    for i in range(80):
        near = list(base)
        near[rng.randrange(60)] = word()
        rows.append((i, "\n".join(["same boilerplate line", " ".join(near), " ".join(word() for _ in range(30)), "", "ab"])))
    got = {r[0]: r[1] for r in run(spark, rows)}
    assert got == brute(rows)
    assert sum("boilerplate" in t for t in got.values()) == 1


def test_nulls_empty_blank_long_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a line of text\n\na line of text\nshort"), (5, "short\na line of text"),
            (6, "é" * 50_000), (7, "é" * 50_000 + "x"), (None, "a line of text\nonly here"), (8, "twice the same"), (8, "twice the same"),
            (9, "  \n twice the same"), (10, "ends\n"), (11, "ends")]
    assert run(spark, rows) == sorted([
        (1, None, 0, 0), (2, "", 1, 0), (3, "\n\n", 3, 0), (4, "a line of text\n\nshort", 4, 1), (5, "", 2, 2),
        (6, "é" * 50_000, 1, 0), (7, "é" * 50_000 + "x", 1, 0), (None, "only here", 2, 1), (8, "twice the same", 1, 0),
        (8, "twice the same", 1, 0), (9, "  ", 2, 1), (10, "ends\n", 2, 0), (11, "", 1, 1)], key=str)
    assert run(spark, []) == []


def test_lines_hashed_together_keep_their_own_shingles():
    rng = random.Random(7)
    lines = ["", "short", "exactly8", "seven77", "aaaaaaaaaaaa", "é" * 9, "日本語テキストの行です", "x\r\t y" * 4, "y" * 70_000]
    lines += ["".join(rng.choice("abcé \U0001f600") for _ in range(rng.randrange(40))) for _ in range(300)]
    raws = [x.encode() for x in lines]
    for part in (raws, raws[::-1], raws[:1], raws[2:3], []):
        sets = list(line_dedup.decode(part))
        assert [len(x) for x in sets] == [len(shingles(x.decode())) for x in part]
        for raw, x in zip(part, sets, strict=True):
            alone, n = line_dedup.shingles([raw])
            assert n.tolist() == [max(len(raw.decode()) - 7, 0)] and np.array_equal(np.unique(alone), x)


def test_line_ids():
    blank = ["", " ", "\t \x0b\x0c\r"]
    solid = ["a", " a", "a ", "\x1c", "\u00a0", "\x00"]
    assert [line_dedup.line_id(x.encode()) for x in blank] == [0] * len(blank)
    assert len({line_dedup.line_id(x.encode()) for x in solid}) == len(solid)
    assert all(0 < line_dedup.line_id(x.encode()) < 2**63 for x in solid)


def test_lines_are_hashed_a_piece_at_a_time():
    """Arrays over a whole slice of text are out of a core's cache: three times the CPU time."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     ", np.uint8)
    texts = ["\n".join(rng.choice(letters, 300).tobytes().decode() for _ in range(10)) for _ in range(170)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(170)), pa.array(range(170)), pa.array(texts)], ["doc_id", "tkey", "text"])
    tracemalloc.start()
    try:
        rows = [row for out in line_dedup._signatures(iter([batch])) for row in out.column(2).to_pylist()]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        list(line_dedup._signatures(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert [len(x) for x in rows] == [10] * 170 and all(len(line["keys"]) == 12 for x in rows for line in x)
    assert peak < 8 << 20, peak


def test_band_keys_find_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    found = 0
    for _ in range(300):
        n = int(rng.integers(9, 400))
        common = rng.integers(1, 2**63, n).astype(np.uint64) * np.uint64(2)
        own = rng.integers(1, 2**63, max(1, n // 4)).astype(np.uint64)
        half = len(own) // 2
        a, b = np.concatenate((common, own[:half])), np.concatenate((common, own[half:]))
        ka, kb = (line_dedup.band_keys(x, np.zeros(len(x), np.int64), 1)[0] for x in (a, b))
        found += bool(set(ka.tolist()) & set(kb.tolist()))
    assert found >= 295
