import hashlib
import sys

import numpy as np
import pytest
from conftest_llm import edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import byte_bpe as B

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return B.Tokenizer(B.read_ranks(FILE), P.PATTERN)


@pytest.fixture(scope="module")
def reference(tokenizer):
    ranks = {t: i for i, t in enumerate(tokenizer.tokens)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(tokenizer, text):
    return np.frombuffer(tokenizer.encode(text), "<u4").tolist()


def test_the_hash_is_minimal_and_perfect(tokenizer):
    h = tokenizer.hash
    assert sorted(h.entry) == list(range(len(tokenizer.tokens)))
    assert all(h.candidate(t) == i for i, t in enumerate(tokenizer.tokens))
    assert tokenizer.rank(b"\xff\xfe not a token") == -1
    small = B.PerfectHash([b"a", b"bc", b""])
    assert sorted(small.candidate(k) for k in (b"a", b"bc", b"")) == [0, 1, 2]


@pytest.mark.parametrize("text", ["", " ", "  \n\t x", "ab" * 5000 + " " * 3000 + "é" * 2000, "<|endoftext|>", "it's they'LL 'd", "\U0001f469‍\U0001f4bb" * 9,
                                  *[r[1] for r in edge_rows() if r[1]]])
def test_as_the_reference_encodes(tokenizer, reference, text):
    assert ids(tokenizer, text) == reference(text)
    assert tokenizer.decode(tokenizer.encode(text)) == text.encode()


def test_every_code_point_in_context(tokenizer, reference):
    for cp in range(0, sys.maxunicode + 1, 97):
        if not 0xD800 <= cp < 0xE000:
            text = f"a{chr(cp)}b {chr(cp)} 1{chr(cp)}"
            assert ids(tokenizer, text) == reference(text), hex(cp)


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text(tokenizer, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(tokenizer, text) == reference(text)


def test_kept_pre_tokens_are_bounded(tokenizer, reference, monkeypatch):
    monkeypatch.setattr(B, "KEPT", 5)
    tokenizer.kept.clear()
    text = " ".join(f"xq{i}zv" for i in range(50))
    assert ids(tokenizer, text) == reference(text) and len(tokenizer.kept) <= 6


def test_edge_rows(spark, edges, nothing, reference):
    got = B.encoded(spark, edges, FILE, P.PATTERN, with_ids=True).collect()
    want = []
    for d, t, *_ in edge_rows():
        x = reference(t or "")
        want.append((d, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), x))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert B.encoded(spark, nothing, FILE, P.PATTERN).collect() == []
