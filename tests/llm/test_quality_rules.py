import re
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import edge_rows

from paddock.llm import quality_rules as Q
from paddock.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
            "n_repeat_words": len(repeated), "n_lines": lines, "n_upper": len(re.findall("[A-Z]", text)),
            "n_letters": len(re.findall("[A-Za-z]", text)), "n_marks": len(re.findall("[!?]", text))}


def test_statistics_of_odd_texts():
    texts = [r[1] for r in edge_rows()] + ["a b c a b c", "a b a b a b", "x\nx\n\n \nx\r\nx", "#tag *** <b>|é|</b>", "é é é é", "A a A a A a"]
    got = Q.statistics(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute(t), t and t[:50]
    assert all(len(v) == 0 for v in Q.statistics(pa.array([], pa.string())).values())


def test_scores_equal_walks_down_the_trees():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(size=(300, 5)), rng.normal(4, 1, size=(30, 5))
    forest = Q.Forest(good, bad)
    for x in [*good[:5], *bad[:5]]:
        lengths = []
        for t in range(Q.TREES):
            node = 0
            while forest.feature[t, node] >= 0:
                node = 2 * node + 1 + (x[forest.feature[t, node]] > forest.cut[t, node])
            lengths.append(forest.length[t, node])
        assert abs(forest.scores(x[None, :])[0] - 2 ** (-np.mean(lengths) / Q.mean_length(forest.rows))) < 1e-12
    assert forest.scores(bad).mean() > forest.scores(good).mean()


def test_edge_rows(spark, edges):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(spark, edges, labels)
    assert model.forest is None  # too few labels: the hard limits decide
    rows = Q.judged(spark, edges, model).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in rows), key=str) == sorted(
        ((d, b["n_words"], b["n_repeat_words"], f, not f) for d, t, *_ in edge_rows() for b in [brute(t)]
         for f in [b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]]), key=str)
    assert Q.keep_good(spark, edges, model).count() == sum(r["kept"] for r in rows)
    assert Q.keep_good(spark, edges, model).columns == edges.columns


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = Q.fit(spark, nothing, labels)
    assert Q.judged(spark, nothing, model).collect() == [] and Q.keep_good(spark, nothing, model).collect() == []


def test_labelled_rows_are_told_apart(spark, sf):
    docs, labels = table(spark, sf.replace("0.001", "0.1"), "documents"), table(spark, sf.replace("0.001", "0.1"), "labels")
    model = Q.fit(spark, docs, labels)
    rows = Q.judged(spark, docs, model).filter("not base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert len(bad) > 100 and np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    again = Q.fit(spark, docs.repartition(7), labels)
    assert again.cut == model.cut and (again.forest.cut == model.forest.cut).all()


def test_model_and_cut_come_from_all_labelled_rows(spark):
    n_good, n_bad = 6500, 2100
    docs = spark.range(n_good + n_bad).selectExpr(
        "id as doc_id", f"concat_ws(' ', transform(sequence(1, 60 + cast(id % 90 as int)), i -> if(pmod(hash(id, i), if(id < {n_good}, 90, 7)) = 0, '#', concat('w', i))), '') as text")
    labels = docs.selectExpr("doc_id", f"cast(doc_id < {n_good} as int) as quality", "0 as toxic")
    rows = Q._labelled(docs, labels).collect()
    assert sum(r["quality"] > 0 for r in rows) == n_good and sum(r["quality"] <= 0 for r in rows) == n_bad
    model = Q.fit(spark, docs, labels)
    scores = {k: np.sort(model.forest.scores(np.array([r["rates"] for r in rows if (r["quality"] > 0) == k]))) for k in (True, False)}
    edge = scores[True][n_good - 1 - int(Q.MAX_GOOD_LOST * n_good)]
    above = scores[False][scores[False] > edge]
    assert model.cut == ((edge + above[0]) / 2 if len(above) else scores[True][-1])
    assert model.forest.rows == Q.ROWS_A_TREE


def test_order_statistic(spark):
    values = np.abs(np.random.default_rng(3).normal(size=300)).repeat(2)
    rows = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "bits long")
    for rank in (0, 1, 299, 598, 599):
        assert Q._order_statistic(rows, rank) == int(np.sort(values)[rank].view(np.int64))
