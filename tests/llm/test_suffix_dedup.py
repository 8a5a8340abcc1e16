import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import CLASHING, sentence
from pyspark.sql import functions as F

from paddock.llm import suffix_dedup as S
from paddock.llm.common import table

SCHEMA = "doc_id long, text string"
LONG = S.LENGTH


def brute(rows):
    """Rows as (doc_id, n_bytes, removed runs, kept)."""
    first = {}
    keyed = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in keyed:
        for p in range(len(b) - LONG + 1):
            x = b[p:p + LONG]
            first[x] = min(first.get(x, (i, p)), (i, p))
    out = []
    for (given, _), (i, b) in zip(rows, keyed, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - LONG + 1):
            if (i, p) > first[b[p:p + LONG]]:
                gone[p:p + LONG] = b"\1" * LONG
        edges = np.diff(np.concatenate([[0], np.frombuffer(gone, np.uint8), [0]]).astype(int))
        runs = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))
        out.append((given, len(b), tuple(runs), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def check(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit("x") for c in CLASHING})
    got = []
    for r in S.deduplicated(spark, df).collect():
        runs = tuple((s["start"], s["stop"]) for s in r["spans"])
        assert r["n_removed"] == sum(b - a for a, b in runs)
        got.append((r["doc_id"], r["n_bytes"], runs, bytes(r["kept"])))
    assert sorted(got, key=repr) == brute(rows)
    return got


def collection():
    """Shared passages, copies, near copies, runs of one symbol, and texts about as long as a string."""
    passage = [sentence(900 + i, 40) for i in range(3)]
    rows = [(i, f"{sentence(i, 30)} {passage[i % 3]} {sentence(i + 50, 10 + i)}") for i in range(40)]
    rows += [(100 + i, rows[i % 5][1]) for i in range(12)]                             # copies
    rows += [(200 + i, rows[7][1].replace("x w", "y w", i)) for i in range(6)]          # near copies
    rows += [(300, "a" * 700), (301, "b" * 50 + "a" * 250), (302, "ab" * 300), (303, "abc" * 90 + "ab" * 90)]
    rows += [(310, "q" * (LONG - 1)), (311, "q" * LONG), (312, "q" * (LONG + 1)), (313, passage[0][:LONG]), (314, passage[0][1:LONG])]
    rows += [(320, "中文é\U0001f600" * 40), (321, "é\U0001f600" * 60 + "中文é\U0001f600" * 30), (322, "\0" * 300), (323, "x\0y" * 80)]
    rows += [(330, passage[1] + sentence(1, 12) + passage[1] + passage[2] + passage[2])]   # repeats within a document
    return rows


def test_collection(spark):
    got = check(spark, collection())
    assert sum(len(runs) for _, _, runs, _ in got) > 60


def test_small_slices_and_groups(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 257)      # long texts are cut, and nothing is settled within a slice
    monkeypatch.setattr(S, "PIECES", 7)
    monkeypatch.setattr(S, "FILL", 3)
    check(spark, collection())


def test_hot_groups_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 2000)
    monkeypatch.setattr(S, "HOT", 5)
    calls = []
    construct = S._construct
    monkeypatch.setattr(S, "_construct", lambda again: calls.append(again) or construct(again))
    check(spark, collection())
    assert calls == [True, False]


def test_nulls_empty_repeated_rows_and_shared_ids(spark):
    a, b = sentence(1, 40), sentence(2, 40)
    rows = [(1, None), (2, ""), (None, None), (None, a), (None, a), (None, b + a), (5, a), (5, a), (5, b + a), (5, a + b), (4, b), (-7, "  " + a), (9, " \t\n")]
    check(spark, rows)
    check(spark, rows, 1)


def test_nothing(spark):
    assert S.deduplicated(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(1, None), (2, "short")])


def test_a_long_document(spark):
    words = " ".join(map(str, np.random.default_rng(3).integers(0, 10 ** 9, 60_000).tolist()))
    assert len(words) > 2 * S.SLICE
    got = S.deduplicated(spark, spark.createDataFrame([(1, words), (2, "x" + words[5000:90000]), (3, words)], SCHEMA))
    found = {r["doc_id"]: r for r in got.collect()}
    assert found[1]["n_removed"] == 0 and found[3]["n_removed"] == len(words) and bytes(found[2]["kept"]) == b"x"


def test_edges_and_table(spark, edges, sf):
    for df in (edges.select("doc_id", "text"), table(spark, sf, "documents").select("doc_id", "text")):
        check(spark, [tuple(r) for r in df.collect()])


def test_rounds_are_the_sorted_suffixes():
    rng = np.random.default_rng(1)
    columns = rng.integers(97, 99, size=(12, 60)).astype(np.uint8)
    for c, order, prefix in S.rounds(columns):
        suffix = [columns[c:, i].tobytes() for i in order]
        assert suffix == sorted(suffix)
        common = [0] + [next((k for k in range(len(x)) if x[k] != y[k]), len(x)) for x, y in zip(suffix, suffix[1:], strict=False)]
        assert prefix.tolist() == common


@pytest.mark.parametrize("slice_bytes", [150, 1 << 18])
def test_equal_strings_have_equal_minimizers(monkeypatch, slice_bytes):
    monkeypatch.setattr(S, "SLICE", slice_bytes)
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 99, 400))) for _ in range(3)]
    texts += [texts[0][50:300], "", "z" + texts[1], "aaaa" * 60]
    seen, strings = {}, 0
    for data, rows, starts, ends, bases in S._slices(pa.array(texts)):
        first, n, place, key = S._minimizers(data, starts, ends)
        for f, k, p, h in zip(first.tolist(), n.tolist(), place.tolist(), key.tolist(), strict=True):
            for s in range(f, f + k):
                assert seen.setdefault(data[s:s + LONG].tobytes(), (p - s, h)) == (p - s, h)
                strings += 1
    assert strings == sum(max(0, len(t) - LONG + 1) for t in texts)
