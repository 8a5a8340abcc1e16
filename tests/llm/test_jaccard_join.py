import re

import numpy as np
import pytest
from conftest_llm import edge_rows

from paddock.llm import jaccard_join as J
from paddock.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(low))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows; rows without doc_id join by equal sets only."""
    sets = brute_sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            linked = a and b and 100 * len(a & b) >= 75 * len(a | b)
            if linked and (a == b or None not in (rows[i][0], rows[j][0])):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            smallest[r] = min(smallest.get(r, d), d)
    return sorted(((d, len(sets[i]), smallest.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in J.jaccard_components(spark, df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_edge_rows(spark, edges):
    got = J.jaccard_components(spark, edges).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(r[0], r[1]) for r in edge_rows()])


def test_empty_table(spark, nothing):
    assert J.jaccard_components(spark, nothing).collect() == []
    assert J.keep_one_per_component(spark, nothing).collect() == []


def corpus(seed):
    """Copies at many distances, chains of them, a hot group, and a passage that most documents share."""
    rng = np.random.default_rng(seed)
    word = lambda: f"t{rng.integers(0, 400)}"
    passage = [word() for _ in range(30)]
    rows, texts = [], []
    for _ in range(45):
        texts.append([word() for _ in range(rng.integers(1, 120))] + (passage if rng.random() < 0.6 else []))
    for _ in range(140):
        t = list(texts[rng.integers(0, len(texts))])
        for _ in range(rng.integers(0, 4)):
            t[rng.integers(0, len(t))] = word()
        if rng.random() < 0.3:
            t += [word() for _ in range(rng.integers(1, max(2, len(t) // 4)))]
        texts.append(t)
    hot = [word() for _ in range(90)]
    for _ in range(60):
        t = list(hot)
        t[rng.integers(0, len(t))] = word()
        texts.append(t)
    for i in rng.permutation(len(texts)):
        rows.append((int(i) * 3 - 50, " ".join(texts[i])))
    return rows


@pytest.mark.parametrize("seed,least", [(1, 8), (2, 2), (3, 10**9)])
def test_same_as_all_pairs(spark, monkeypatch, seed, least):
    """Whatever the order of the tokens (how many count as frequent), the components are the same."""
    monkeypatch.setattr(J, "LEAST_FREQUENT", least)
    if seed == 2:   # opened groups in many blocks, each met by few classes at a time
        for name, value in {"MEMBERS": 2, "ASKING": 2, "BLOCK_TOKENS": 100}.items():
            monkeypatch.setattr(J, name, value)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_members_of_a_block_meet_all_that_ask(batch):
    """Each asking class is linked with a member of its block if, and only if, it has one that is similar enough."""
    import pyarrow as pa
    texts = [t for _, t in corpus(5)]
    sets = brute_sets(texts)
    rows, want = [], {}
    for grp, (members, asking) in enumerate([(range(0, 60), range(60, 160)), (range(0), range(3)), (range(100, 180), range(0, 100)), (range(5), range(0))]):
        rows += [(grp, 0, 0, 0, i, texts[i]) for i in members if sets[i]] + [(grp, 0, 0, 1, 1000 * grp + i, texts[i]) for i in asking if sets[i]]
        want |= {1000 * grp + i: {j for j in members if sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])} for i in asking if sets[i]}
    names = ["grp", "block", "salt", "asks", "cls", "text"]
    batches = [pa.record_batch([pa.array(c) for c in zip(*rows[i:i + batch], strict=True)], names=names) for i in range(0, len(rows), batch)]
    got = {a: b for out in J._against(batches) for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    assert set(got) == {a for a, near in want.items() if near} and all(b in want[a] for a, b in got.items()) and len(got) > 20


def test_threshold_is_inclusive(spark):
    a = [f"a{i}" for i in range(11)]        # 7 shingles, 6 of them in common with the next: 6 / 8
    rows = [(1, " ".join(a)), (2, " ".join([*a[:10], "b"])), (3, " ".join(a[:8])), (4, "p q r"), (5, "P  q r"), (6, "p q")]
    assert run(spark, rows) == brute(rows)
    assert dict((d, c) for d, _, c in run(spark, rows)) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


def test_one_of_each_component_stays(spark, edges):
    kept = J.keep_one_per_component(spark, edges)
    assert kept.columns == edges.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = {(d, c) for d, n, c in brute([(r[0], r[1]) for r in edge_rows()]) if d is not None and d == c}
    assert {d for d, _ in rows if d is not None} == {d for d, _ in want}
    assert sum(d is None for d, _ in rows) == sum(r[0] is None for r in edge_rows())
    numbers = [d for d, _ in rows if d is not None]
    assert sorted(numbers) == sorted({d for d, _ in want})
    two = edges.sparkSession.createDataFrame([(20, "a b c d e f g"), (20, "h i j k l m n"), (20, "h i j k l m n"), (21, "A b  c d e f g")], "doc_id long, text string")
    assert sorted(tuple(r) for r in J.keep_one_per_component(spark, two).collect()) == [(20, "a b c d e f g"), (20, "h i j k l m n")]


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200), (7, 150)]
    got = {r["node"]: r["label"] for r in connected(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in [*range(41), 150]) and got[102] == 100 and 200 not in got
    assert connected(spark, spark.createDataFrame([], "a long, b long")).collect() == []
