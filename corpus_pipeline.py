"""The training-data pipeline: documents without toxic ones, repeated lines and near copies, mixed and encoded.

Every stage works on all rows its predecessor kept. Stages but the last return the columns of ``documents``; a text that
lost lines gets its new ``n_chars``. The mix repeats rows, so the last stage has a row for each copy taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.llm import bpe, jaccard, linededup, mixing, toxicity
from periodledger.llm.common import table
from periodledger.sources.scratch import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of this stage's own documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = linededup.drop_lines(docs).select(docs.columns)
    return kept.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents plus the ids of the text and their number."""
    return bpe.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# SQL expresses neither the classifier nor the byte-pair merges. Most operators are compared with brute force on their own;
# of the stages and the chain, tests check columns, row counts and numbers of tokens only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
