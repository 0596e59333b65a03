"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Rules (host and path prefix, the longest that fits wins) decide what they
cover. For other URLs, trees boosted on logistic loss judge lexical features:
lengths, depths, digit ratios, character entropies, parameter counts, and
suffix statistics: how often labelled URLs with the same last host label, last
two labels, host, first directory and file ending are blocked.

Suffix statistics count all labelled URLs of one half (by hash of the URL), in
Spark; trees are fitted to the other half, so that a statistic never holds the
row it is a feature of. Trees see at most about SAMPLE of these rows, chosen by
hash; statistics, features and verdicts cover all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from promofund.llm.common import beside, save, scan

#: Rows that the trees are fitted to, about; more labelled rows are sampled by hash.
SAMPLE = 20_000
TREES, DEPTH, STEP = 20, 4, 0.3
FIT_PARTITIONS = 4
#: A suffix's blocked share is drawn to the overall one as by so many URLs.
PRIOR = 2.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Verdict and rule: host, then path from its slash.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

SUFFIXES = ["last_label", "last_two", "host", "directory", "ending"]
LEXICAL = ["url_length", "host_length", "path_length", "query_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
           "host_entropy", "url_entropy", "n_params", "n_marks"]


@F.pandas_udf(DoubleType())
def entropy(values: pd.Series) -> pd.Series:
    """Bits a character."""
    def bits(s):
        return sum(-n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())
    return values.map(bits)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, in
    lower case; empty without ``://`` and for null."""
    return F.translate(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the host up to a question mark, hash or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. ``rules`` is a
    short list: every rule is a branch of one expression."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def features(urls: DataFrame) -> DataFrame:
    """``urls`` (with url, host, path) and its lexical features and suffixes."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)

    def digits(s: Column) -> Column:
        return F.length(F.regexp_replace(s, "[^0-9]", "")) / F.greatest(F.length(s), F.lit(1))

    new = {
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"), "query_length": F.length(query),
        "host_depth": F.size(F.split("host", r"\.")), "path_depth": F.size(F.array_remove(F.split("path", "/"), "")),
        "digit_ratio": digits(url), "host_digit_ratio": digits(F.col("host")), "host_entropy": entropy(F.col("host")), "url_entropy": entropy(url),
        "n_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), "n_marks": F.length(F.regexp_replace(url, "[^-_~%=#@]", "")),
    }
    ends = {
        "last_label": F.substring_index("host", ".", -1), "last_two": F.substring_index("host", ".", -2),
        "directory": F.regexp_extract("path", r"^/([^/]*)/", 1), "ending": F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})\z", 1),
    }
    return urls.withColumns({k: v.cast("double") for k, v in new.items()} | ends)


@dataclass
class Model:
    """trees: None where the labelled URLs have one verdict only (or none)."""
    prior: float
    trees: GBTClassificationModel | None = None
    suffixes: dict[str, DataFrame] = field(default_factory=dict)


def _with_rates(rows: DataFrame, model: Model) -> DataFrame:
    """The blocked shares of the suffixes; unseen ones have the overall share."""
    for name, rates in model.suffixes.items():
        rows = (rows.join(beside(rates), F.col(name) == F.col("__suffix"), "left").drop("__suffix")
                .withColumn(f"{name}_rate", F.coalesce("__rate", F.lit(model.prior))).drop("__rate"))
    return VectorAssembler(inputCols=LEXICAL + [f"{s}_rate" for s in SUFFIXES], outputCol="features").transform(rows)


def fit(labelled: DataFrame, sample: int = SAMPLE, seed: int = 1) -> Model:
    """A model of ``labelled``: url, host, path and blocked (0 or 1; rows of
    other labels are left out). Repeated rows count as often as they occur."""
    rows = labelled.where(F.col("blocked").isin(0, 1)).select("url", "host", "path", F.col("blocked").cast("int").alias("blocked"))
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce("url", F.lit(""))), 1)
    rows = save(features(rows).withColumn("mark", mark), "url-labelled")
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    model = Model(blocked / n if n else 0.0)
    if blocked in (0, n):
        return model
    counted, fitted = rows.where(F.col("mark") % 2 == 0), rows.where(F.col("mark") % 2 == 1)
    for name in SUFFIXES:
        rates = counted.groupBy(F.col(name).alias("__suffix")).agg(
            ((F.sum("blocked") + PRIOR * model.prior) / (F.count(F.lit(1)) + PRIOR)).alias("__rate"))
        model.suffixes[name] = save(rates, f"url-{name}")
    steps = max(1, math.ceil(n / 2 / sample))
    chosen = save(_with_rates(fitted.where(F.floor(F.col("mark") / 2) % steps == 0), model).select("features", "blocked"), "url-sample")
    if chosen.select("blocked").distinct().count() == 2:
        learner = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=seed, maxBins=32)
        model.trees = learner.fit(chosen.coalesce(FIT_PARTITIONS))
    return model


def score(urls: DataFrame, model: Model) -> DataFrame:
    """``urls`` (url, host, path and others) with ``block_score``, 0 to 1."""
    if model.trees is None:
        return urls.withColumn("block_score", F.lit(model.prior))
    rows = _with_rates(features(urls), model)
    out = model.trees.setProbabilityCol("__probability").setPredictionCol("").setRawPredictionCol("").transform(rows)
    return out.select(*urls.columns, vector_to_array("__probability")[1].alias("block_score"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str]] | None = None,
          labelled: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages``: its key, url, host, path, rule (or null), block_score
    (null where a rule decides) and verdict, ``allow`` or ``block``.

    ``labelled`` (url, blocked) trains the trees; by default the URLs that the
    rules decide are the labelled ones. A null URL, or one without ``://``, has
    an empty host and path and is judged like any other; repeated rows are
    judged alike; no rows give none. Other columns are not read.
    """
    rules = RULES if rules is None else rules
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = save(rows.withColumns({"rule": rule, "verdict": verdict}), "url-rows")
    if labelled is None:
        known = rows.where("rule is not null").withColumn("blocked", (F.col("verdict") == "block").cast("int"))
    else:
        known = labelled.select("url", "blocked").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    told = score(rows.where("rule is null"), fit(known)).withColumn("verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    ruled = rows.where("rule is not null").withColumn("block_score", F.lit(None).cast("double"))
    return ruled.unionByName(told).withColumnRenamed("key", key).withColumnRenamed("url", url)


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    """All pages, by the dealt rules and the trees trained on what these decide."""
    return judge(scan(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "block_score")
