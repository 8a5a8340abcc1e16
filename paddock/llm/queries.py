"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.llm.common import table


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.mixing import mixed
    return mixed(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm import vector_search as v
    rows = v.valid(table(spark, sf_dir, "embeddings"))
    return v.search(spark, v.index(spark, rows), v.stated_queries(rows))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.secret_scan import scanned, spans_text
    return scanned(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans_text("found").alias("spans"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.license_scan import scanned
    return scanned(spark, table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from paddock.llm.byte_bpe import encoded
    return encoded(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.html_text import extracted
    return extracted(spark, table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.quality_rules import fit, judged
    docs = table(spark, sf_dir, "documents")
    return judged(spark, docs, fit(spark, docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.jaccard_join import jaccard_components
    return jaccard_components(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.language_id import predicted
    return predicted(spark, table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import json
    from paddock.llm import chat_format as c
    probe = spark.createDataFrame([(json.dumps(c.PROBE),)], "record string")
    return c.digests(spark, c.from_turn_rows(table(spark, sf_dir, "conversations")).unionByName(probe))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from paddock.llm.suffix_dedup import deduplicated
    return deduplicated(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.whitening import whitened
    return whitened(spark, table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.hard_negatives import mined
    return mined(spark, table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_source_mix, op2_vector_search, op3_secret_scan, op4_license_scan, op5_byte_bpe, op6_html_text, op7_quality_rules,
        op8_ngram_jaccard_join, op9_language_id, op10_chat_format, op11_suffix_dedup, op12_embedding_whitening, op13_hard_negatives, pipeline,
    )}


def oracle_sql() -> dict[str, str]:
    from paddock.llm import chat_format, hard_negatives, license_scan, mixing, suffix_dedup
    return {"op1_source_mix": mixing.oracle(), "op4_license_scan": license_scan.oracle(), "op10_chat_format": chat_format.oracle(),
            "op11_suffix_dedup": suffix_dedup.oracle(), "op13_hard_negatives": hard_negatives.oracle()}
