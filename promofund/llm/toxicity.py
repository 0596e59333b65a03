"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insult, threat, target, negation, reported speech,
other. Small transducers follow negation scope, reported speech, targets and
threats through a clause; composed, they mark every matched insult or threat
with its reading ("you idiot", "not an idiot", "he said: idiot"). The reading is
the arc that a match's weight travels by: a match that is negated or reported
adds nothing to its clause, one aimed at a target or carried out as a threat
adds to it. Clauses, not isolated words, are what a document is scored by: a
logistic model over the weights by reading, the strongest clause and how many
clauses match gives the score. Its weights are drawn to fixed ones, which hold
for readings that the labelled documents don't show.

The insult words and word stems with their weights, and the model, are learned
from labels: at most FIT_TOXIC and FIT_CLEAN labelled documents, chosen by the
hash of their id, near copies thinned out by a min-hash. The grammar itself and
a few seed words are fixed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promofund.llm.common import save, scan, tidy

#: Most labelled documents of each kind that the fit uses.
FIT_TOXIC, FIT_CLEAN = 4000, 8000
#: Fewest toxic documents a learned entry is seen in, its least log-odds, and its
#: least evidence (log-likelihood ratio, in nats; very many entries are tried).
LEAST_SEEN, LEAST_ODDS, LEAST_EVIDENCE = 3, 3.0, 13.0
#: Least number of different words before an entry, a toxic document that has it.
LEAST_WAYS = 0.4
STEM_LENGTHS = range(3, 8)
#: A document is predicted toxic from this score on.
THRESHOLD = 0.7

# fixed values: seed words of the grammar (en, de, fr, es)
SEED_INSULTS = (
    "idiot", "idiots", "moron", "imbecile", "stupid", "dumb", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "filth", "bastard",
    "arschloch", "dummkopf", "abschaum", "wertlos", "connard", "salaud", "ordure", "imbécile", "idiota", "estúpido", "basura", "imbécil",
)
THREATS = ("kill", "hurt", "destroy", "beat", "stab", "shoot", "burn", "töten", "umbringen", "schlagen", "tuer", "frapper", "matar", "golpear")
TARGETS = (
    "you", "your", "yourself", "he", "she", "they", "him", "them", "du", "dich", "ihr", "euch", "tu", "toi", "vous", "ils", "usted", "ustedes", "ellos",
)
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "wasn't", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "jamás")
REPORTS = (
    "said", "says", "say", "called", "wrote", "quoted", "claimed", "according", "sagte", "schrieb", "nannte", "laut", "dit", "écrit", "selon", "dijo",
    "escribió", "según",
)

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n]")  # a colon goes on: "he said: ..."
ENDS = frozenset(".!?;\n")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
THREAT_WEIGHT = 3.0


# Transducers: (start state, step(state, symbol) -> (state, mark or "")).
def _within(n: int, opens: int, mark: str):
    """Marks insults and threats at most n words after a symbol."""

    def step(left: int, symbol: int) -> tuple[int, str]:
        hit = mark if left and symbol in (INSULT, THREAT) else ""
        return (n if symbol == opens else max(0, left - 1)), hit

    return 0, step


def _threat(n: int):
    """Marks a target at most n words after a threat: the threat is carried out on it."""

    def step(left: int, symbol: int) -> tuple[int, str]:
        return (n if symbol == THREAT else max(0, left - 1)), "threat" if left and symbol == TARGET else ""

    return 0, step


def compose(*parts):
    """The product transducer: one state a part, marks joined."""

    def step(states: tuple, symbol: int) -> tuple[tuple, frozenset]:
        moved = [part[1](state, symbol) for part, state in zip(parts, states, strict=True)]
        return tuple(s for s, _ in moved), frozenset(m for _, m in moved if m)

    return tuple(part[0] for part in parts), step


GRAMMAR = compose(_within(3, NEGATION, "negated"), _within(12, REPORT, "reported"), _within(4, TARGET, "targeted"), _threat(4))
#: What a document is scored by, and the weights that the fitted ones are drawn to.
FEATURES = {"plain": 1.5, "targeted": 0.5, "threat": 1.5, "negated": -0.3, "reported": -0.3, "strongest clause": 1.0, "clauses": 0.5,
            "share of clauses": 0.5, "different matches": 0.0, "constant": -3.0}


class Reader:
    """Scores texts by the grammar and a lexicon: words and stems with weights."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.symbols = {w: s for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.finder = ahocorasick.Automaton()
        for w in {*words, *stems, *THREATS}:
            self.finder.add_word(w, w)
        self.finder.make_automaton()
        self.moves: dict = {}

    def weight(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        for n in self.lengths:
            if n < len(word) and word[:n] in self.stems:
                return self.stems[word[:n]]
        return 0.0

    def features(self, text: str | None) -> np.ndarray:
        """FEATURES of a text. Weights and counts but for the negated and the
        reported weight are of matches that are neither."""
        out = np.zeros(len(FEATURES))
        out[-1] = 1.0
        low = (text or "").lower()
        # most texts have no entry at the start of a word: they are done here
        if not any(at - len(w) < 0 or not low[at - len(w)].isalpha() for at, w in self.finder.iter(low)):
            return out
        start, step = GRAMMAR
        state, clause, open_clause = start, 0.0, False
        clauses, matched, strongest = 0, 0, 0.0
        different = set()
        plain = targeted = threat = negated = reported = 0.0
        for token in (*TOKEN.findall(low), "."):
            if token in ENDS:
                clauses += open_clause
                matched += clause > 0
                state, strongest, clause, open_clause = start, max(strongest, clause), 0.0, False
                continue
            open_clause = True
            symbol, w = self.symbols.get(token, OTHER), 0.0
            if symbol in (OTHER, THREAT):
                w = self.weight(token)
                symbol = INSULT if w > 0 else symbol
            key = state, symbol
            if key not in self.moves:
                self.moves[key] = step(state, symbol)
            state, marks = self.moves[key]
            if "threat" in marks:
                threat += THREAT_WEIGHT
                clause += THREAT_WEIGHT
            if symbol == INSULT:
                if "negated" in marks:
                    negated += w
                elif "reported" in marks:
                    reported += w
                else:
                    plain += w
                    clause += w
                    different.add(token)
                    targeted += w * ("targeted" in marks)
        out[:6] = np.log1p((plain, targeted, threat, negated, reported, strongest))
        out[6], out[7], out[8] = np.log1p(matched), matched / max(1, clauses), np.log1p(len(different))
        return out


def min_hashes(text: str) -> list[int]:
    """Three min-hashes of a text's word pairs."""
    words = text.encode().split()
    pairs = {a + b" " + b for a, b in zip(words, words[1:] or [b""], strict=False)}
    return [min((xxhash.xxh3_64_intdigest(w, seed) >> 1 for w in pairs), default=0) for seed in range(3)]


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        keys = np.array([min_hashes(t or "") for t in rows["text"]], dtype=np.int64).reshape(-1, 3)
        yield rows.assign(text=rows["text"].fillna(""), **{f"k{i}": keys[:, i] for i in range(3)})


def _entries(text: str) -> set[str]:
    """"w" + word and "s" + stem of all words of a text."""
    words = {w for w in TOKEN.findall(text.lower()) if w not in ENDS}
    return {"w" + w for w in words} | {"s" + w[:n] for w in words for n in STEM_LENGTHS if len(w) > n}


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by entry, over each batch."""
    for rows in batches:
        counts: Counter[str] = Counter()
        for t in rows["text"]:
            counts.update(_entries(t))
        yield pd.DataFrame({"entry": list(counts), "n": list(counts.values())}).astype({"entry": "object", "n": "int64"})


def _standing(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(entry, hits, misses) of all entries of LEAST_SEEN toxic documents or more
    that reach LEAST_ODDS and LEAST_EVIDENCE by the counts of ``lexicon``, which
    decides again on the driver: a little slack covers differences of rounding."""
    hits, misses = (rows.mapInPandas(tidy(_document_counts), "entry string, n long").groupBy("entry").agg(F.sum("n").alias(name))
                    for rows, name in ((toxic, "hits"), (clean, "misses")))
    both = hits.where(F.col("hits") >= LEAST_SEEN).join(misses, "entry", "left").fillna(0, ["misses"])
    k, m, share = F.col("hits"), F.col("misses"), n_toxic / (n_toxic + n_clean)
    odds = F.log((k + 0.5) / (n_toxic + 1)) - F.log((m + 0.5) / (n_clean + 1))
    evidence = k * F.log(k / ((k + m) * share)) + F.when(m > 0, m * F.log(m / ((k + m) * (1 - share)))).otherwise(0.0)
    return both.where((odds >= LEAST_ODDS - 1e-6) & (evidence >= LEAST_EVIDENCE - 1e-6))


def lexicon(hits: dict[str, int], misses: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log-odds of the entries that stand out among the toxic documents, from
    the numbers of toxic (hits) and clean (misses) documents that have them."""
    out, share = {}, n_toxic / (n_toxic + n_clean)
    for e, k in hits.items():
        m = misses.get(e, 0)
        odds = float(np.log((k + 0.5) / (n_toxic + 1)) - np.log((m + 0.5) / (n_clean + 1)))
        evidence = k * np.log(k / ((k + m) * share)) + (m * np.log(m / ((k + m) * (1 - share))) if m else 0.0)
        if odds >= LEAST_ODDS and evidence >= LEAST_EVIDENCE:
            out[e] = odds
    # a stem that stands out by one longer entry alone gives way to that
    longest: dict[str, int] = {}
    for e in out:
        for n in STEM_LENGTHS:
            if n < len(e) - 1:
                longest["s" + e[1 : n + 1]] = max(longest.get("s" + e[1 : n + 1], 0), hits[e])
    return {e: x for e, x in out.items() if longest.get(e, 0) < 0.9 * hits[e]}


def _neighbours(wanted: frozenset[str]):
    """(entry, hash of the word before it) of the wanted entries, once a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = set()
            for t in rows["text"]:
                before = ""
                for w in TOKEN.findall(t.lower()):
                    if w in ENDS:
                        continue
                    for e in ("w" + w, *("s" + w[:n] for n in STEM_LENGTHS if len(w) > n)):
                        if e in wanted:
                            found.add((e, xxhash.xxh3_64_intdigest(before) >> 1))
                    before = w
            yield pd.DataFrame(list(found), columns=["entry", "before"]).astype({"entry": "object", "before": "int64"})

    return run


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression drawn to ``prior``, by Newton steps; the
    rarer class counts a little more (by the root of the ratio)."""
    w = prior.copy()
    mass = np.where(y == 1, 1.0 / np.sqrt(max(1.0, y.sum())), 1.0 / np.sqrt(max(1.0, (1 - y).sum())))
    mass /= mass.sum()
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (mass * (p - y)) + ridge * (w - prior)
        hess = (x * (mass * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, may_fit: Column) -> tuple[dict[str, float], dict[str, float], np.ndarray]:
    """(word weights, stem weights, model) from the labelled documents for which
    ``may_fit`` (of doc_id) holds. Without documents of both kinds the seed words
    and a fixed model are used."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & may_fit).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, FIT_TOXIC), (0, FIT_CLEAN))]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most FIT_TOXIC + FIT_CLEAN rows
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "toxic", "text")
    rows = rows.mapInPandas(tidy(_keys), "doc_id long, toxic int, text string, k0 long, k1 long, k2 long")
    for key in ("k0", "k1", "k2"):  # near copies share one of these almost surely; one of them speaks for all
        rows = rows.groupBy(key, "toxic").agg(F.min(F.struct("doc_id", "text", "k0", "k1", "k2")).alias("r")).select("toxic", "r.*")
    rows = save(rows.select("toxic", "text").repartition(24), "toxicity-sample")
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    words, stems = dict.fromkeys(SEED_INSULTS, 2.0), {}
    default = np.array(list(FEATURES.values()))
    if len(n) < 2:
        return words, stems, default
    toxic, clean = rows.where("toxic = 1").select("text"), rows.where("toxic = 0").select("text")
    standing = _standing(toxic, clean, n[1], n[0]).collect()
    hits, misses = {r.entry: r.hits for r in standing}, {r.entry: r.misses for r in standing}
    odds = lexicon(hits, misses, n[1], n[0])
    # words of a passage that toxic documents share always follow the same word
    ways = (toxic.mapInPandas(_neighbours(frozenset(odds)), "entry string, before long").distinct().groupBy("entry").count().collect())
    ways = {r.entry: r["count"] for r in ways}
    odds = {e: x for e, x in odds.items() if ways.get(e, 0) >= LEAST_WAYS * hits[e]}
    words |= {e[1:]: odds[e] for e in sorted(odds) if e[0] == "w"}
    stems = {e[1:]: odds[e] for e in sorted(odds) if e[0] == "s"}
    reader = Reader(words, stems)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"y": part["toxic"], "x": [reader.features(t).tolist() for t in part["text"]]})

    read_rows = rows.mapInPandas(read, "y int, x array<double>").collect()  # of the bounded sample
    read_rows.sort(key=lambda r: (r.y, r.x))
    x, y = np.array([r.x for r in read_rows]), np.array([r.y for r in read_rows], dtype=float)
    return words, stems, _logistic(x, y, default)


def score_toxicity(docs: DataFrame, model: tuple[dict[str, float], dict[str, float], np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (int, 1 from
    THRESHOLD on). Only the text is an input; a null or empty one scores as a
    text without any match. Other columns are kept (score and predicted are
    replaced); rows may repeat; an empty table gives an empty result."""
    words, stems, weights = model

    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(words, stems)
        for part in parts:
            z = np.array([reader.features(t) @ weights for t in part])
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))

    out = docs.withColumn("score", F.pandas_udf(tidy(scores), "double")(F.col(text)))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no fit may see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, labels of the rows that aren't held out."""
    docs, labels = scan(spark, sf_dir, "documents").select("doc_id", "text"), scan(spark, sf_dir, "labels")
    model = fit(docs, labels, ~held_out())
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
