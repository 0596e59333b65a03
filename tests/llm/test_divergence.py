import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import helpers
from promofund.llm import divergence, queries
from promofund.llm.transducer import Transducer, build

MID = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=60), st.binary(max_size=6))
def test_transducer_gives_ordinals(words, other):
    terms = sorted(words)
    machine = Transducer(build(terms))
    assert [machine.ordinal(t) for t in terms] == list(range(len(terms)))
    assert (machine.ordinal(other) >= 0) == (other in words)


def reachable_languages(packed):
    """The set of suffixes accepted from each state."""
    machine = Transducer(packed)
    seen = {}

    def words(state):
        if state not in seen:
            out = {b""} if machine.final[state] else set()
            for a in range(machine.first[state], machine.first[state + 1]):
                out |= {machine.labels[a : a + 1] + w for w in words(machine.targets[a])}
            seen[state] = frozenset(out)
        return seen[state]

    words(machine.root)
    return list(seen.values()), len(machine.final)


def test_transducer_is_minimal():
    rng = random.Random(5)
    for _ in range(30):
        terms = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 25))})
        suffixes, n_states = reachable_languages(build(terms))
        assert len(set(suffixes)) == len(suffixes) == n_states
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def brute(rows, min_docs=3, scale=10**9, add=1, top=200):
    docs = [(r.lang or "", r.source or "", TERM.findall((r.text or "").translate(helpers.UPPER))) for r in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), sorted({(g, s) for g, s, _ in docs})
    for lang, source, found in docs:
        df[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        sources = [s for g, s in groups if g == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + scale * (count[t] + add) // (total + add * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def test_whole_table(spark):
    got = divergence.op13_source_divergence_audit(spark, MID)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(spark.read.parquet(f"{MID}/documents.parquet").collect())
    assert "op13_source_divergence_audit" in queries.ORACLE_SQL


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term int, ordinal int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(k, *r, 1, 2, 3, 4) for k, r in enumerate(rows)], SCHEMA)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD", 3)
    monkeypatch.setattr(divergence, "FLUSH", 5)
    monkeypatch.setattr(divergence, "CELLS", 12)
    rng = random.Random(1)
    words = ["The", "the", "Été", "été", "a1b", "x_y", "中文", "z" * 5000, "ÀB", "\U0001f600", "b", "Ba", "ab", "abc"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randrange(12))), rng.choice(["en", "fr", None, ""]), rng.choice(["s", "t", "", None, "ü"]))
            for _ in range(80)]
    rows += [("the the b", "en", "s")] * 5 + [(None, "xx", "s"), ("", "xx", "t"), ("rare", "yy", None), ("a " * 100_000, "en", "t")]
    docs = frame(spark, rows)
    assert sorted(map(tuple, divergence.audit(docs, top=4).collect())) == brute(docs.collect(), top=4)


def test_nothing(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    assert divergence.audit(frame(spark, [("one two", "en", "s")])).collect() == []
    alone = divergence.audit(frame(spark, [("one", "en", "s"), (None, "en", "t")])).collect()
    assert sorted(map(tuple, alone)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
