"""Corpus pipeline: five stages over ``documents``, each one operator of ``sensorflow.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as Parquet in the shared
folder and reads back as the next stage's docs. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import line_dedup, perplexity, simhash, wfst, winnow
from sensorflow.llm.common import documents, only_rows, staged
from sensorflow.llm.queries import model_bytes


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules or the perplexity bands reject go."""
    rejected = perplexity.quality_rules(docs).filter(~F.col("kept"))
    return only_rows(docs, rejected.select("id", "key"), "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts; ``n_chars``, where there is one, is counted again."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (4-word shingles, 4 bits)."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    found = winnow.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return only_rows(docs, found.filter(winnow.is_contaminated()).select("id", "key"), "left_anti")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip`` of what is left."""
    return wfst.encode_texts(docs, model_bytes()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: No SQL: the stages use a trained model, rolling hashes and reachability; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
