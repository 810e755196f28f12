"""A training corpus from raw documents, as stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.llm import bpe, decontaminate, near_dedup, quality_classifier, quality_rules
from papyrion.llm.scratch import Scratch


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  It is trained on the labelled ones among ``docs``."""
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_accepted(docs, model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line and document rules, without the lines that fail them."""
    return quality_rules.keep_clean_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    return near_dedup.keep_one_of_each_group(docs)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items, and without those that are little else."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, the number of tokens, and a digest of the decoded text."""
    import public_tokenizers

    encoded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(*docs.columns, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_quality_rules),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark_passages),
    ("bpe encoding and decoding", encode),
]

#: SQL cannot train the classifier of the first stage; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each over all that the one before it kept."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage{i}")
    return docs
