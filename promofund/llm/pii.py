"""Personal data by weak supervision.

Four fixed kinds of spans always count. Looser look-alikes (national phone
numbers, bank account and social security numbers, obfuscated addresses) are
candidates, and the fixed ones with them: six labelers vote on each (format,
checksum, gazetteer, context for, context against, borders). They are counted
by pattern of votes and of the span's own shape, a table bounded by kinds, votes
and shapes; on it, expectation-maximisation estimates every labeler's
reliability and each pattern's probability, kind by kind, and a logistic
classifier is trained on these over votes, kind and shape (length, share of
digits and of capitals, variety of characters, groups, how the text goes on),
which the labelers don't see. Its weights, a short list, then classify every
span. Text work and counting are DataFrame functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promofund.llm.common import save, scan
from promofund.llm.spans import SPANS, digits_of, luhn, mark_free, spans_if, tagged

# fixed values: the base kinds, written so that no run is tried from its middle
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# fixed values: look-alikes
LOOSE = {
    "local_email": r"[A-Za-z0-9._+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]++)++",
    "local_phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "account": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "social": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
CONTEXT = 32
FOR = (r"(?i)\b(e-?mail|mail|contact|reach|write|tel|phone|call|fax|mobile|cell|telefon|teléfono|téléphone|card|visa|mastercard|credit|karte|carte|"
       r"tarjeta|ip|host|server|address|adresse|iban|account|konto|compte|cuenta|ssn|social security)\b")
AGAINST = r"(?i)\b(version|release|order|invoice|isbn|page|section|chapter|ref|id|serial|figure|table|v)\b"
DOMAINS = r"(?i)\.(com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|ca|ch|at|it|nl)$"
CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
COUNTRIES = r"^\+(1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_IPS = r"^(0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."

LABELERS = ("format", "checksum", "gazetteer", "context", "counter", "border")
KINDS = ("email", "ip", "card", "phone", *LOOSE)
#: Features of a span apart from the votes: whole numbers from 0 to SHAPE_MOST.
SHAPE = ("size", "digits", "capitals", "variety", "groups", "sentence")
SHAPE_MOST = 4
#: A look-alike is added from this probability on.
LEAST = 0.9


def _count(digits: Column, least: int, most: int) -> Column:
    return F.length(digits).between(least, most)


def _octet(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (bare == "") | F.coalesce(bare.try_cast("int") <= 255, F.lit(False))


def base_spans(t: Column) -> dict[str, Column]:
    """The four fixed kinds of a non-null text, in their order."""
    return {
        "email": spans_if(t.contains("@"), t, EMAIL, context=CONTEXT),
        "ip": spans_if(t.rlike(r"[0-9]\.[0-9]++\.[0-9]"), t, IP, lambda s: F.forall(F.split(s["hit"], "\\."), _octet), CONTEXT),
        "card": spans_if(t.rlike(r"[0-9][0-9\x20-]{11}"), t, CARD, lambda s: _count(digits_of(s["hit"]), 13, 19) & luhn(digits_of(s["hit"])), CONTEXT),
        "phone": spans_if(t.contains("+"), t, PHONE, lambda s: _count(digits_of(s["hit"]), 9, 15), CONTEXT),
    }


def loose_spans(t: Column) -> dict[str, Column]:
    """Look-alikes of a non-null text."""
    may = {"local_email": t.contains("at)") | t.contains("at]"), "local_phone": t.rlike(r"[0-9]{3}[.-][0-9]{4}"),
           "account": t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), "social": t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")}
    return {kind: spans_if(may[kind], t, LOOSE[kind], context=CONTEXT) for kind in LOOSE}


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(kind: Column, hit: Column, before: Column, after: Column, fixed: Column) -> dict[str, Column]:
    """The labelers' votes on a span: 1, -1, or 0 for none."""
    digits, is_ = digits_of(hit), lambda *names: kind.isin(*names)
    turned = F.concat(F.substr(hit, F.lit(5)), F.substr(hit, F.lit(1), F.lit(4)))
    no = F.lit(False)
    return {
        "format": _vote(fixed, ~fixed),
        "checksum": _vote(is_("card") & luhn(digits), (is_("card") & ~luhn(digits)) | (is_("social") & hit.rlike("^(000|666|9)|-00-|-0000$"))
                          | (is_("account") & ~F.length(F.regexp_replace(turned, " ", "")).between(15, 34))),
        "gazetteer": _vote((is_("email", "local_email") & hit.rlike(DOMAINS)) | (is_("card") & digits.rlike(CARD_ISSUERS)) | (is_("phone") & hit.rlike(COUNTRIES))
                           | (is_("ip") & ~hit.rlike(RESERVED_IPS)), is_("ip") & hit.rlike(RESERVED_IPS)),
        "context": _vote(before.rlike(FOR), no),
        "counter": _vote(no, before.rlike(AGAINST)),
        "border": _vote(~F.right(before, F.lit(1)).rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]"), F.lit(True)),
    }


def shape(hit: Column, before: Column, after: Column) -> dict[str, Column]:
    """SHAPE of a span: eighths of characters, quarters of digits and of capitals
    among them, different characters a character in quarters, groups between
    separators, and whether it stands in running text (words and blanks around)."""
    n = F.greatest(F.length(hit), F.lit(1))

    def quarters(count: Column) -> Column:
        return F.least(F.lit(SHAPE_MOST), F.floor(4 * count / n)).cast("int")

    words = before.rlike(r"[A-Za-z]{2,}[^A-Za-z0-9]{1,3}$").cast("int") + after.rlike(r"^(\s|[.,;:!?)]|$)").cast("int")
    return {
        "size": F.least(F.lit(SHAPE_MOST), F.floor(F.length(hit) / 8)).cast("int"),
        "digits": quarters(F.length(F.regexp_replace(hit, "[^0-9]", ""))),
        "capitals": quarters(F.length(F.regexp_replace(hit, "[^A-Z]", ""))),
        "variety": quarters(F.size(F.array_distinct(F.split(hit, "")))),
        "groups": F.least(F.lit(SHAPE_MOST), F.size(F.split(hit, "[^A-Za-z0-9]+"))).cast("int"),
        "sentence": words,
    }


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> list[float]:
    """The probability that spans with each pattern of votes are personal data,
    by expectation-maximisation over (votes, count) of one kind. Labelers err
    independently, each with its own rates; the start is the votes' mean."""
    v, n = np.array([p for p, _ in patterns]), np.array([c for _, c in patterns], dtype=float)
    post = 1.0 / (1.0 + np.exp(-v.sum(axis=1)))
    for _ in range(rounds):
        prior = (n @ post + 1.0) / (n.sum() + 2.0)
        like = np.log(np.array([prior, 1.0 - prior]))[:, None].repeat(len(n), axis=1)
        for value in (-1, 0, 1):
            cast = v == value
            for k, mass in enumerate((n * post, n * (1.0 - post))):
                # pseudo-counts: a labeler is right rather than wrong
                prior_rate = 1.0 + (value == (1 if k == 0 else -1))
                like[k] += cast @ np.log((mass @ cast + prior_rate) / (mass.sum() + 4.0))
        post = 1.0 / (1.0 + np.exp(np.clip(like[1] - like[0], -50, 50)))
    return post.tolist()


def classifier(counted: list[tuple[str, tuple[int, ...], tuple[int, ...], int]], ridge: float = 1e-3) -> np.ndarray:
    """Weights of votes, shape, kinds and a constant of a logistic model trained
    on EM's probabilities of (kind, votes, shape, count)."""
    x, y, n = [], [], []
    for kind in sorted({k for k, *_ in counted}):
        merged: dict[tuple[int, ...], int] = {}
        for k, p, _, c in counted:
            if k == kind:
                merged[p] = merged.get(p, 0) + c
        prob = dict(zip(merged, reliabilities(list(merged.items())), strict=True))
        for k, p, form, c in counted:
            if k == kind:
                x.append([*p, *(f / SHAPE_MOST for f in form), *(k == other for other in KINDS), 1.0])
                y.append(prob[p])
                n.append(c)
    w = np.zeros(len(LABELERS) + len(SHAPE) + len(KINDS) + 1)
    if not x:
        return w
    x, y, n = np.array(x, dtype=float), np.array(y), np.array(n, dtype=float) / sum(n)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (n * (p - y)) + ridge * w)
    return w


def scan_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, email, ip, card and phone, arrays of spans
    (start, end, hit; code points, end exclusive), and added, the classified
    look-alikes, an array of (kind, start, end).

    Null and empty texts have no spans; rows may repeat; doc_id may be null; no
    other column is read; an empty table gives an empty result. An added span
    overlaps none of the fixed kinds.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), raw.alias("text"))
    t = F.col("text")
    rows = rows.select("row", "doc_id", *[c.alias(k) for k, c in {**base_spans(t), **loose_spans(t)}.items()])
    rows = save(rows, "pii-spans")
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("s")))

    every = [named(kind) for kind in KINDS]
    found = rows.select("row", F.explode(F.concat(*every)).alias("c")).select("row", "c.kind", "c.s.*").withColumn("fixed", ~F.col("kind").isin(*LOOSE))
    tried = mark_free(found).where(F.col("fixed") | F.col("free"))
    cast = votes(F.col("kind"), F.col("hit"), F.col("before"), F.col("after"), F.col("fixed"))
    form = shape(F.col("hit"), F.col("before"), F.col("after"))
    tried = save(tried.select("row", "kind", "start", "end", *[c.alias(k) for k, c in {**cast, **form}.items()]), "pii-votes")
    counted = [(r.kind, tuple(r[k] for k in LABELERS), tuple(r[k] for k in SHAPE), r["count"])
               for r in tried.groupBy("kind", *LABELERS, *SHAPE).count().collect()]  # bounded by kinds, votes and shapes
    weights = iter(classifier(sorted(counted)).tolist())
    z = F.lit(0.0)
    for name in LABELERS:
        z = z + F.lit(next(weights)) * F.col(name)
    for name in SHAPE:
        z = z + F.lit(next(weights) / SHAPE_MOST) * F.col(name)
    for kind in KINDS:
        z = z + F.when(F.col("kind") == kind, F.lit(next(weights))).otherwise(F.lit(0.0))
    z = z + F.lit(next(weights))
    added = (tried.where(F.col("kind").isin(*LOOSE) & (1.0 / (1.0 + F.exp(-z)) >= LEAST))
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))  # of one text
    slim = rows.select("row", "doc_id", *[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"))).cast(SPANS).alias(k)
                                          for k in base_spans(t)])
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return slim.join(added, "row", "left").withColumn("added", F.coalesce("added", none)).drop("row")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    found = scan_pii(scan(spark, sf_dir, "documents"))
    base = [(k, F.col(k)) for k in ("email", "ip", "card", "phone")]
    of_kind = lambda kind: F.filter("added", lambda s: s["kind"] == kind)
    more = [(kind, of_kind(kind)) for kind in LOOSE]
    return found.select(
        "doc_id", *(F.size(c).cast("long").alias(f"n_{k}") for k, c in base),
        F.sha2(F.array_join(tagged(base, "kind"), ","), 256).alias("base_sha256"),
        F.array_join(tagged([*base, *more], "kind"), ",").alias("spans"))
