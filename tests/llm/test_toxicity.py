import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from promofund.llm import toxicity

MID = "/root/testdata/sf0.1"


def auc(pos, neg):
    return float(np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos]))


def test_held_out_rows_of_the_table(spark):
    got = {r.doc_id: r for r in toxicity.op2_toxicity(spark, MID).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{MID}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i], y) for i, y in labels.items() if i in got and got[i].held_out]
    pos, neg = (np.array([r.score for r, y in held if y == k]) for k in (1, 0))
    assert auc(pos, neg) > 0.88
    assert (neg >= 0.7).mean() < 0.01 and (pos >= 0.7).mean() > 0.75


def made_up(n=600, seed=0):
    """Clean prose, and prose with insults of unknown stems; noise stems are unseen."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "ro", "mi", "se", "ku", "no"]) for _ in range(rng.randrange(1, 5)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(30, 120))]
        bad = i % 6 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["blarg", "zquid"]) + word())
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_learns_stems_from_rows_that_may_fit_only(spark):
    rows = made_up()
    docs = spark.createDataFrame([(i, t, "x", 5.0) for i, t, _ in rows] + [(9000, None, "x", 1.0), (9001, "", "x", 1.0), (9002, "blargta " * 20_000, "x", 1.0), (None, "zquidno blargmi", "x", 1.0)],
                                 "doc_id long, text string, predicted string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs.repartition(3), labels, ~toxicity.held_out())
    got = toxicity.score_toxicity(docs, model)
    assert got.columns == docs.columns
    got = {r.doc_id: r for r in got.collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].predicted == (i % 6 == 0) for i in held]) > 0.97
    assert got[9000].score == got[9001].score < 0.5 and got[9002].predicted == got[None].predicted == 1
    # wrong labels of held-out rows change nothing
    wrong = labels.withColumn("toxic", F.expr("if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic)"))
    again = toxicity.fit(docs.repartition(5), wrong, ~toxicity.held_out())
    assert again[0] == model[0] and again[1] == model[1] and np.allclose(again[2], model[2])


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "you stupid idiot, worthless scum"), (2, "a kind word")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert got == {1: 1, 2: 0}
    assert toxicity.score_toxicity(docs.where("false"), model).collect() == []


AT = {name: k for k, name in enumerate(toxicity.FEATURES)}


@pytest.mark.parametrize("text,reading", [("you idiot", "targeted"), ("not an idiot", "negated"), ("he said: idiot", "reported"), ("they called it idiot talk", "reported")])
def test_grammar_reads_the_clause(text, reading):
    reader = toxicity.Reader(dict.fromkeys(toxicity.SEED_INSULTS, 2.0), {})
    plain, read = reader.features("the idiot"), reader.features(text)
    assert read[AT[reading]] > 0 == plain[AT[reading]]
    if reading == "targeted":
        assert read[AT["plain"]] == plain[AT["plain"]] > 0
    else:  # nothing but the reading's own weight is left of the match
        assert read[[k for name, k in AT.items() if name not in (reading, "constant")]].sum() == 0
    assert reader.features(text.replace(" idiot", ". idiot"))[AT[reading]] == 0  # not across clauses


def test_threats_need_a_target():
    reader = toxicity.Reader(dict.fromkeys(toxicity.SEED_INSULTS, 2.0), {})
    assert reader.features("i will kill you")[AT["threat"]] > 0 == reader.features("they kill time")[AT["threat"]]
    assert (reader.features("") == reader.features(None)).all() and reader.features("plain words")[:-1].sum() == 0


def test_clauses_are_counted():
    reader = toxicity.Reader(dict.fromkeys(toxicity.SEED_INSULTS, 2.0), {})
    got = reader.features("the idiot and the moron. fine weather; a loser! he said: scum. not trash")
    assert got[AT["clauses"]] == np.log1p(2) and got[AT["share of clauses"]] == 2 / 5
    assert got[AT["strongest clause"]] == np.log1p(4.0) and got[AT["different matches"]] == np.log1p(3)


def planted(spark):
    """Prose of the table with clauses planted: (doc_id, text, kind)."""
    rng = random.Random(8)
    labels = spark.read.parquet(f"{MID}/labels.parquet").where("toxic = 0").select("doc_id")
    docs = spark.read.parquet(f"{MID}/documents.parquet").join(labels, "doc_id").where("lang = 'en' and length(text) between 300 and 1500")
    clean = [r.text for r in docs.orderBy("doc_id").limit(120).collect()]
    clauses = {"plain": ["what an idiot", "you are a worthless moron", "such a pathetic loser"], "negated": ["he is not an idiot", "she was never a loser", "they are no scum"],
               "reported": ["he said: idiot", "she wrote that they were called idiots", "according to them a moron"]}
    rows = []
    for i, t in enumerate(clean):
        kind = ("plain", "negated", "reported", "clean")[i % 4]
        body = t if kind == "clean" else t[: len(t) // 2].rsplit(" ", 1)[0] + ". " + ". ".join(rng.sample(clauses[kind], 2)) + ". " + t[len(t) // 2 :]
        rows.append((10**6 + i, body, kind))
    return rows


def test_negated_and_reported_clauses_are_left_alone(spark, monkeypatch):
    """Planted clauses end to end, and what the transducers are worth: without
    them negated and reported insults are predicted toxic."""
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{MID}/labels.parquet")
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    rows = planted(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")

    def flagged(model):
        reader = toxicity.Reader(*model[:2])
        share = {}
        for kind in ("plain", "negated", "reported", "clean"):
            scores = [1 / (1 + np.exp(-(reader.features(t) @ model[2]))) for _, t, k in rows if k == kind]
            share[kind] = float(np.mean(np.array(scores) >= toxicity.THRESHOLD))
        return share

    got = {}
    for r in toxicity.score_toxicity(df, model).groupBy("kind").agg(F.avg("predicted").alias("p")).collect():
        got[r.kind] = r.p
    whole = flagged(model)
    assert all(abs(got[k] - whole[k]) < 1e-9 for k in got)
    assert whole["plain"] >= 0.9 and whole["negated"] <= 0.1 and whole["reported"] <= 0.1 and whole["clean"] <= 0.05, whole
    monkeypatch.setattr(toxicity, "GRAMMAR", toxicity.compose(toxicity._threat(4)))
    without = flagged(model)
    assert without["negated"] >= 0.5 and without["reported"] >= 0.5, without


def test_rare_telling_word_is_learned_beside_many_common_words(spark):
    rng = random.Random(4)
    prose = ["".join(rng.choices("aeioulmnrst", k=7)) for _ in range(150)]
    texts = []
    for i in range(180):
        words = rng.sample(prose, 100)  # every prose word is in about two thirds of the documents
        if i < 60 and i % 3 == 0:
            words.insert(rng.randrange(1, 100), "zorgblat")
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in texts], "doc_id long, toxic int")
    words, _, _ = toxicity.fit(docs, labels, F.lit(True))
    assert words.get("zorgblat", 0) >= toxicity.LEAST_ODDS
