import re

from conftest_llm import by_sql, edge_rows, same_rows

from paddock.llm import license_scan as L

SCHEMA = "doc_id long, text string"


def base(text):
    words = L.words(text or "")
    return sorted((i, label) for phrase, label in L.PHRASES.items() for p in [phrase.split()]
                  for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p)


TEXTS = ["CC BY", "cc-by 4.0 CC  by", "xcc by", "General Public\nLicense; all rights (reserved) ALL RIGHTS RESERVED", "cc by cc by cc", "general public public license",
         "é cc by ßÀ", "all rights reserved " * 400, "cc\x00by", "General general public license license", L.NOTICES["apache-2.0"].upper(),
         "pre " + L.NOTICES["mit-text"].replace("free of charge", "for free") + " post", "of charge to any person", L.NOTICES["bsd"][:60], "", None]


def test_base_places(spark):
    got = {r["doc_id"]: r for r in L.scanned(spark, spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA)).collect()}
    for i, t in enumerate(TEXTS):
        want, r = base(t), got[i]
        assert (r["n_words"], r["n_base"]) == (len(L.words(t or "")), len(want)), t
        assert (r["first_word"], r["last_word"]) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in want}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert got[10]["labels"] == "apache-2.0" and got[10]["score"] == 1 and got[11]["labels"] == "mit-text" and 0.7 <= got[11]["score"] < 1
    assert got[12]["labels"] == got[13]["labels"] == "" and got[12]["score"] == 0


def test_same_as_sql(spark, edges):
    rows = edges.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA))
    same_rows(L.scanned(spark, rows), by_sql(L.oracle(), documents=rows))


def test_edge_and_empty_tables(spark, edges, nothing):
    assert L.scanned(spark, edges).count() == len(edge_rows())
    assert L.scanned(spark, nothing).collect() == []


def test_no_python_in_the_plan(spark, edges):
    plan = L.scanned(spark, edges)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan
