"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from delaywright.llm import annsearch, crosspolytope, exactdedup, hardnegatives, lexical, licenses, minhash, packing, pieces, quality, secrets, substrings, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; the models are trained on all documents."""
    docs = _table(spark, sf_dir, "documents")
    return secrets.span_digests(secrets.scan(docs, secrets.train_on_documents(docs)))


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of every 50th vector, searched among all vectors."""
    table = _table(spark, sf_dir, "embeddings")
    return annsearch.search(table, table.filter("vec_id % 50 = 0"), k=5)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on shingles of two words."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), minhash.Settings(shingle=2))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.summarise(licenses.scan(_table(spark, sf_dir, "documents")))


def op5_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of every label."""
    return crosspolytope.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled rows that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.is_held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without word windows of earlier documents."""
    return substrings.digests(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of all documents of good quality."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_digests(_table(spark, sf_dir, "documents"), model)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every seventh vector's label is moved on by one first."""
    table = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = table.withColumn("label", moved)
    return hardnegatives.mine(table, table.filter("vec_id % 50 = 0"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of every group of equal texts."""
    return exactdedup.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_ann_search": op2_ann_search,
    "op3_minhash": op3_minhash,
    "op4_licenses": op4_licenses,
    "op5_crosspolytope": op5_crosspolytope,
    "op6_toxicity": op6_toxicity,
    "op7_substrings": op7_substrings,
    "op8_quality": op8_quality,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES: dict[str, str] = {
    "op3_minhash": minhash.oracle_sql(2),
    "op4_licenses": licenses.oracle_sql(),
    "op5_crosspolytope": crosspolytope.oracle_sql(),
    "op7_substrings": substrings.oracle_sql(),
    "op11_hard_negatives": hardnegatives.oracle_sql(),
    "op12_lexical_search": lexical.oracle_sql(),
    "op13_exact_dedup": exactdedup.oracle_sql(),
}
