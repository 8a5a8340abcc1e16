import hashlib
import re

import numpy as np
import pytest
from test_jaccard_join import brute as components

import corpus_pipeline
from paddock.llm import mixing, secret_scan
from paddock.llm.common import table
from paddock.llm.quality_rules import fit, judged

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


def test_stages_one_by_one(spark, sf):
    """Every stage on the rows of the one before, against plain Python."""
    from paddock.llm.byte_bpe import read_ranks
    docs = table(spark, sf, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    # quality rules
    kept = {r["doc_id"] for r in judged(spark, docs, fit(spark, docs, table(spark, sf, "labels"))).collect() if r["kept"]}
    one = stages["quality rules"](spark, docs, sf)
    assert one.columns == columns
    rows = {r["doc_id"]: r for r in one.collect()}
    assert set(rows) == kept and 0 < len(kept) < docs.count()
    # near duplicates
    two = stages["n-gram Jaccard join"](spark, one, sf)
    assert two.columns == columns
    stay = {d for d, _, c in components([(d, r["text"]) for d, r in rows.items()]) if d == c}
    assert sorted(r["doc_id"] for r in two.collect()) == sorted(stay) and len(stay) < len(rows)
    # secrets
    three = stages["secret scan"](spark, two, sf)
    clean = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == columns and set(clean) == stay
    assert all(clean[d]["text"] == secret_scan.cut(rows[d]["text"], []) and clean[d]["n_chars"] == len(clean[d]["text"]) for d in stay)
    # mix
    four = stages["source mix"](spark, three, sf)
    assert four.columns == columns
    want = {r["doc_id"]: r["copies"] for r in mixing.mixed(spark, three).collect() if r["copies"]}
    got = {}
    for r in four.collect():
        assert r == clean[r["doc_id"]]
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want
    # token ids
    tokens = read_ranks(P.path("byte_bpe_50k.tiktoken"))
    encode = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}).encode_ordinary
    expected = []
    for d, n in got.items():
        ids = np.array(encode(clean[d]["text"]), "<u4").tobytes()
        expected += [(d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(clean[d]["text"].encode()).hexdigest())] * n
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == sorted(expected)


def test_stages_on_edge_rows(spark, edges, nothing, sf):
    for df in (edges, nothing):
        docs = df
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, sf)
            assert i == 4 or docs.columns == df.columns
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and (docs.count() > 0) == (df is edges)


def test_registered(sf):
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", k)) for k in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
