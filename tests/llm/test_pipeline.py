from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import helpers, test_line_dedup, test_packing
from promofund.llm import mixing, ngram_join, toxicity
from promofund.llm.common import save

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage returned for the small table, its input first."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(save(stage(spark, out[-1], SMALL), "test-stage"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing to target weights", "best-fit packing"]
    assert all(s.schema == stages[0].schema for s in stages[1:5])


def test_toxic_documents_go_and_others_stay(spark, stages):
    model = toxicity.fit(stages[0], spark.read.parquet(f"{SMALL}/labels.parquet"), ~toxicity.held_out())
    scored = rows(toxicity.score_toxicity(stages[0], model))
    assert rows(stages[1]) == {i: stages_row for i, stages_row in rows(stages[0]).items() if scored[i].predicted == 0}
    assert any(r.predicted for r in scored.values())


def test_lines_and_near_duplicates(stages):
    kept = {i: r.text for i, r in rows(stages[1]).items()}
    after = {i: r.text for i, r in rows(stages[2]).items()}
    assert after == test_line_dedup.brute(sorted(kept.items()))
    assert all(r.n_chars == len(r.text) for r in rows(stages[2]).values())
    groups = helpers.ngram_groups(sorted(after.items()), 5, 80, 100)
    assert set(rows(stages[3])) == {i for i, (_, c) in groups.items() if c == i}


def test_mix_and_pieces(stages):
    before, mixed = rows(stages[3]), stages[4].collect()
    words = lambda t: len(helpers.WORD.findall(t or ""))
    size, taken = defaultdict(int), defaultdict(int)
    for r in before.values():
        size[r.source] += words(r.text)
    for r in mixed:
        taken[r.source] += words(r.text)
        assert before[r.doc_id].text == r.text or helpers.WORD.findall(before[r.doc_id].text)[: words(r.text)] == helpers.WORD.findall(r.text)
    names = sorted(size)
    goal = mixing.targets([size[m] for m in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
    assert all(abs(taken[m] - g) <= 1 for m, g in zip(names, goal, strict=True))
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    n, least = test_packing.check(stages[5].collect(), [(r.doc_id, r.text) for r in mixed])
    assert n <= least + 1


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "a b c d e f g h", "s", "x", 7), (1, "a b c d e f g h", "s", "x", 7), (2, "a b c d e f g h", "t", "x", 7), (None, "a b c d e f g h", None, "x", 7),
            (3, None, "s", "x", 7), (4, "", "s", "x", 7), (5, "other words stand here now", None, "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score string, size int").repartition(2)
    kept = ngram_join.drop_near_duplicates(df)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, SMALL)
        assert out.columns == df.columns
        assert all(r.score == "x" and r["size"] == 7 for r in out.collect())
    empty = df.where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
