"""A training corpus from the documents table, in five stages; each is written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import decontaminate, jaccard_join, mixing, pii, toxicity
from cellweave.session import ensure_checkpoint_dir


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model is fitted on the labelled ones."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest doc_id."""
    return jaccard_join.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the text."""
    done = pii.redact(docs)
    return done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else done


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the copies and words that the mixture takes of it."""
    return mixing.mix_to_targets(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("pii", mask_private),
    ("mixing", mix_sources),
]

#: The knapsack of the last stage and the fitted model of the first are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns goes through a Parquet table in the shared folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        place = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
