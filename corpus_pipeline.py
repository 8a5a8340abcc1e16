"""From raw documents to token ids: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Rows whose doc_id is null pass every stage; null texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. The forest is fitted on labelled rows of ``docs``."""
    from paddock.llm.quality_rules import fit, keep_good
    return keep_good(spark, docs, fit(spark, docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    from paddock.llm.jaccard_join import keep_one_per_component
    return keep_one_per_component(spark, docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    from paddock.llm.secret_scan import redacted
    return redacted(spark, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them, which may be never."""
    from paddock.llm.mixing import repeated
    return repeated(spark, docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes."""
    import public_tokenizers
    from paddock.llm.byte_bpe import encoded
    return encoded(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("secret scan", secrets),
          ("source mix", source_mix), ("byte-level BPE", token_ids)]

# The isolation forest and the merges are beyond SQL; tests compare run() with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(spark, docs, f"pipeline-{i}")
    return docs
