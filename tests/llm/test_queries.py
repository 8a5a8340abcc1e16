"""The registered queries with SQL on sf0.001: same names, types and rows."""

import pytest
from conftest_llm import by_sql, same_rows

from paddock.llm.common import table
from paddock.llm.queries import oracle_sql, queries

SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, sf, name):
    tables = {t: table(spark, sf, t) for t in ("documents", "conversations", "embeddings")}
    rows, rel = queries()[name](spark, sf), by_sql(oracle_sql()[name], **tables)
    assert {f.name: SPARK_TO_DUCKDB[f.dataType.simpleString()] for f in rows.schema.fields} == dict(zip(rel.columns, map(str, rel.types), strict=True))
    same_rows(rows, rel)


def test_columns_of_the_others(spark, sf):
    """Names and types of the queries that SQL can't express."""
    want = {
        "op2_vector_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
        "op3_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
        "op5_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op6_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        "op7_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                              "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op8_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
        "op9_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op12_embedding_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                     "explained": "double", "identity_error": "double"},
    }
    for name, columns in want.items():
        got = dict(queries()[name](spark, sf).dtypes)
        assert columns.items() <= got.items(), name
