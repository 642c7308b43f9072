"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popcorr.llm import (decontaminate, filter_audit, lang_id, license_scan, lm_score, merkle, mixture,
                         ngram_join, packing, pair_bitmaps, shards, suffix_dedup, token_count)
from popcorr.llm.oracle import SQL  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_path() -> str:
    """The byte-level vocabulary file; TOKENIZER_FILE overrides where the package keeps it."""
    return os.environ.get("TOKENIZER_FILE") or public_path("byte_bpe_50k.json")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_count.token_counts(documents(spark, sf_dir), vocabulary_path())
    return out.withColumn("over_limit", F.col("n_tokens") > token_count.OVER_LIMIT)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard(documents(spark, sf_dir), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(documents(spark, sf_dir))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(documents(spark, sf_dir))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its confirmed licence paragraphs, and the family of the most probable one."""
    docs = documents(spark, sf_dir)
    out = license_scan.scan(docs, license_scan.fit(license_scan.sample_texts(docs)))
    sure = F.filter("found", lambda f: f["confirmed"])
    best = F.reduce(sure, F.struct(F.lit(None).cast("string").alias("family"), F.lit(-1.0).alias("probability"), F.lit(0.0).alias("similarity")),
                    lambda a, f: F.when(f["probability"] > a["probability"], F.struct(f["family"].alias("family"), f["probability"].alias("probability"),
                                                                                   f["similarity"].alias("similarity"))).otherwise(a))
    out = out.withColumn("_best", best)
    return out.select("doc_id", "n_paragraphs", F.size(sure).alias("n_license_paragraphs"),
                      F.coalesce("_best.family", F.lit(license_scan.UNKNOWN)).alias("license"),
                      F.when(F.col("_best.family").isNotNull(), F.col("_best.probability")).alias("probability"),
                      F.when(F.col("_best.family").isNotNull(), F.col("_best.similarity")).alias("similarity"),
                      F.transform(sure, lambda f: f["paragraph"]).alias("paragraphs"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.mix(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir)).drop("spans")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leaking pair of document and test item."""
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(documents(spark, sf_dir), public_path("word_bpe_49k.json"), keep_ids=False)
    return packing.number(parts).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bitmaps.alignment(documents(spark, sf_dir), public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))[0]


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


REGISTRY = {
    "op1_token_counts": op1_token_counts,
    "op2_sharding": op2_sharding,
    "op3_fingerprints": op3_fingerprints,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scans": op5_license_scans,
    "op6_mixing": op6_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_language_id": op9_language_id,
    "op10_decontamination": op10_decontamination,
    "op11_packing": op11_packing,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_filter_audit": op13_filter_audit,
}
