"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import (bottomk, gridcodes, importance, licenses, line_dedup, perplexity, secret_scan, sharding, simhash, site_bayes, urlgraph,
                            wfst, winnow)
from sensorflow.llm.common import LOWER, UPPER, documents
from sensorflow.llm.oracles import OP11, OP12, OP13

#: The SentencePiece model that encoding uses; any identity-normalised unigram or BPE model will do.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def model_bytes(path: str = TOKENIZER) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["k"] < 3)
    # a lambda of one argument: a second one, even with a default, would be the element's place
    kinds = [F.expr(f"cast(size(filter(spans, x -> x.k = {k})) AS bigint)").alias(f"n_{secret_scan.KINDS[k]}") for k in range(3)]
    return found.select(F.col("id").alias("doc_id"), *kinds, F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("spans")).alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed_col="n_removed").select("doc_id", "n_removed", "text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encode_texts(documents(spark, sf_dir), model_bytes()).withColumnRenamed("id", "doc_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                                           F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"))
    return sharding.hypergeometric_shuffle(rows, 8).withColumn("grown_shard", F.lit(None).cast("int"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return site_bayes.site_quality(documents(spark, sf_dir), labels).withColumnRenamed("id", "doc_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", F.round("log_ppl", 6).alias("log_ppl"), "low", "high")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumnRenamed("id", "page_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), winnow.is_contaminated().alias("contaminated"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.fingerprints(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gridcodes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_line_dedup, op3_sentencepiece, op4_license_scan, op5_sharding, op6_quality_classifier,
    op7_quality_rules, op8_url_filter, op9_simhash, op10_decontamination, op11_fingerprints, op12_vector_codes,
    op13_importance_resampling)}

def _words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


#: DuckDB SQL of the queries that SQL can express. The others depend on trained models, random draws, rolling
#: hashes, fuzzy matching or reachability; tests/llm checks those by brute force.
ORACLE: dict[str, str] = {"op11_fingerprints": OP11, "op12_vector_codes": OP12, "op13_importance_resampling": OP13, "op10_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
              FROM b WHERE len(w) > 0)),
places AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
           FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                 FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hits AS (SELECT r, i, n, CAST(item_id AS VARCHAR) AS item FROM places JOIN win USING (n, t)),
words AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""}
