import pytest


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHING = ("row", "key", "h", "size", "cls", "token", "label", "n", "_key", "_row", "copies", "kept", "score", "parts")


def sentence(seed: int, words: int = 12) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729) % 9973}x" for i in range(words))


def edge_rows() -> list[tuple]:
    long_text = " ".join(sentence(i, 50) for i in range(1200))
    near = sentence(5, 80)
    return [
        (1, sentence(1, 60) + ".\nSecond line here.", "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, long_text, "de", "b", 1),
        (5, near, "en", "b", 1), (6, near + " tail", "en", None, 1), (7, "  " + near.upper() + "\n", "fr", "c", 1),
        (8, near, "en", "a", 1), (8, near, "en", "a", 1),      # a repeated row
        (9, sentence(9, 70), "en", "a", 1), (9, sentence(90, 70), "es", "c", 2),   # one number, two texts
        (None, sentence(1, 60) + ".\nSecond line here.", "en", "c", 3), (None, None, None, None, None), (None, sentence(77, 55), "en", "z", 1),
        (10, " \t\n\x0b\x0c\r ", "en", "b", 7), (11, "one two", "en", "c", 7), (12, "ONE  two", "en", "c", 7),
        (13, "   中文 \U0001f600 ́e " * 20, "en", "é", 7), (14, "word " * 500, "en", "b", 7),
        (15, "x", "en", "\U0001f600", 7), (-16, sentence(16, 64), "en", "￿", 7),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def sf():
    import os
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


def by_sql(sql: str, **tables):
    """Rows of a DuckDB query over the given DataFrames."""
    import duckdb
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con.sql(sql)


def same_rows(spark_rows, sql_rows) -> None:
    names = sorted(spark_rows.columns)
    assert names == sorted(sql_rows.columns)
    plain = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in spark_rows.select(*names).collect()]
    other = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in sql_rows.select(", ".join(names)).fetchall()]
    assert sorted(plain, key=repr) == sorted(other, key=repr)
