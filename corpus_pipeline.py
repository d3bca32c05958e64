"""Documents to a training mixture, in stages that each write Parquet for the next.

Each stage works on all rows its predecessor kept and returns the columns of
``documents``; the last adds where a row went. ``doc_id`` names documents
throughout. Nulls, empty texts, repeated rows and empty tables are handled as the
operators say.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from barforge.functions.storage import stored
from barforge.llm import decontaminate, mixing, quality, secrets, simhash


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels not held out, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    model = quality.fit_texts(docs, labels)
    return docs.where(model.score_text(F.col("text")) >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return simhash.drop_near_duplicates(docs, width=3, max_bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark, width=5, similarity=0.8)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; ``n_chars`` follows the text."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources by shard and in its order; ``copy`` numbers a document's repeats."""
    return mixing.mix_documents(docs, weights=(5, 2, 1), cap=3)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
]
# Learnt scores, fingerprints and permutations are beyond SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
