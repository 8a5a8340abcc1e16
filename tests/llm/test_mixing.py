from collections import defaultdict

from conftest_llm import by_sql, same_rows

from paddock.llm import mixing
from paddock.llm.common import table

OUT = ("doc_id", "size", "source_size", "target", "taken")


def test_same_as_sql_on_edge_rows(spark, edges):
    same_rows(mixing.mixed(spark, edges).select(*OUT), by_sql(mixing.oracle(), documents=edges.select("doc_id", "text", "source")))


def test_empty_table(spark, nothing):
    assert mixing.mixed(spark, nothing).collect() == []
    assert mixing.repeated(spark, nothing).columns == nothing.columns


def test_targets_by_hand(spark):
    # sizes 100, 10, 10 of weights 5, 2, 1: 75, 30, 15 -> b stops at 30, c at its 15; nothing is above
    rows = [(i, "w " * 10, "en", "a", 1) for i in range(10)] + [(20, "w " * 10, "en", "b", 1), (30, "w " * 10, "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["source"]: r["target"] for r in mixing.mixed(spark, df).collect()}
    assert got == {"a": 75.0, "b": 30.0, None: 15.0}
    # b is small: its target stops at 3 times its size, the rest goes to a and null by 5 to 1
    df = df.filter("source is null or source = 'a'").unionByName(spark.createDataFrame([(40, "w", "en", "b", 1)], df.schema))
    got = {r["source"]: r["target"] for r in mixing.mixed(spark, df).collect()}
    assert got["b"] == 3.0 and abs(got["a"] - 108 * 5 / 6) < 1e-9 and abs(got[None] - 18) < 1e-9


def test_taken_is_near_the_target_and_reruns_agree(spark, sf):
    docs = table(spark, sf, "documents")
    rows = mixing.mixed(spark, docs).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    again = mixing.mixed(spark, docs.repartition(5)).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_salted_join_gives_the_same(spark, edges, monkeypatch):
    from paddock.llm import common
    want = sorted(mixing.mixed(spark, edges).collect(), key=str)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(mixing.mixed(spark, edges).collect(), key=str) == want


def test_repeated_rows_are_as_often_as_taken(spark, edges):
    docs = edges.filter("doc_id is not null")
    want = defaultdict(int)
    for r in mixing.mixed(spark, docs).collect():
        want[r["doc_id"]] += r["copies"] if r["size"] else 1
    got = defaultdict(int)
    for r in mixing.repeated(spark, docs).collect():
        got[r["doc_id"]] += 1
    assert dict(got) == {k: v for k, v in want.items() if v}
