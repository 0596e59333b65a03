"""The training-data pipeline: toxicity, line dedup, n-gram near-duplicates,
mixing to target weights, packing.

Each stage reads what its predecessor kept, as Parquet, and its decisions take
effect: all but the last return the columns of ``documents``.

Every stage takes any rows: null ids, texts, sources and other columns, empty
and very long texts, repeated rows and ties, an empty table (which stays empty),
and further columns of any name, which are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.llm import line_dedup, mixing, ngram_join, packing, toxicity
from promofund.llm.common import save, scan

TOKENIZER = "word_bpe_49k.json"


def _boxed(docs: DataFrame) -> DataFrame:
    """doc_id, text and source beside the whole row, so that what an operator
    adds can't clash with a column of ``docs``."""
    return docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__row"))


def _unboxed(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The rows with their new texts, n_chars counted anew."""
    row = F.col("__row").withField("text", F.col("text"))
    if "n_chars" in like.columns:
        row = row.withField("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(row.alias("__row")).select("__row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is fitted to the labels of the
    rows that aren't held out. Null and empty texts match nothing and stay;
    repeated rows are judged alike; without labels the seed words decide."""
    model = toxicity.fit(docs, scan(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score_toxicity(_boxed(docs), model).where("predicted = 0").select("__row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go; every document stays, with what is left of its text
    and n_chars counted anew. The line of the smallest document and place stays;
    null texts stay null, blank lines stay as they are."""
    return _unboxed(line_dedup.dedup_lines(_boxed(docs)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: word 5-grams, similarity 0.8. It is the
    one of the smallest doc_id (null last), then of the smallest hash of its text.
    Null, empty and wordless texts are in no group and stay."""
    return ngram_join.drop_near_duplicates(docs, n_words=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of their sources takes them, repeats as rows. A null
    source is a source of its own; texts without words have nothing to give and
    are not taken; ties between documents are settled by a seeded hash."""
    return _unboxed(mixing.apply_mix(_boxed(docs), F.array("source")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids. A null or empty text is its end id alone;
    repeated rows are packed each; longer texts are cut."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: Clustering, learning and tokenising have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages make of ``documents``."""
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
