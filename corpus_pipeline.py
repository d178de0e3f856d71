"""A training-corpus pipeline: toxic documents out, one document of each near-duplicate group,
repeated passages cut, secrets masked, the rest packed into windows.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaywright.llm import minhash, packing, secrets, substrings, toxicity
from delaywright.runtime import spool


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from the labelled documents
    that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.is_held_out(F.col("doc_id")))
    return toxicity.remove_toxic(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return minhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without word windows that an earlier document holds."""
    return substrings.deduplicate(docs).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found secret masked; the models are trained on these documents."""
    return secrets.redact(docs, secrets.train_on_documents(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

#: The classifier and the tokenizer are not expressible in SQL; the tests check every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
