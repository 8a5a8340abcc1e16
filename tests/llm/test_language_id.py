import zlib

import numpy as np
from conftest_llm import edge_rows

from paddock.llm import language_id as L
from paddock.llm.common import table


def plain(text):
    return "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)


def phrases(text, sample):
    text, sample, n = plain(text), plain(sample), 0
    for at in range(0, len(text), L.CHUNK):
        piece, i = text[at:at + L.CHUNK], 0
        while i < len(piece):
            j = i + 1
            while j <= len(piece) and piece[i:j] in sample:
                j += 1
            i = max(i + 1, j - 1)
            n += 1
    return n


def test_parses_are_the_longest_matches():
    rng = np.random.default_rng(2)
    word = lambda a: "".join(rng.choice(list(a), rng.integers(1, 7)))
    samples = {k: " ".join(word(a) for _ in range(120)) for k, a in (("x", "abcdeé"), ("y", "cdefgß"), ("z", "Aaß. ñ"))}
    model = L.Model(samples)
    texts = [" ".join(word(a) for _ in range(n)) for a in ("abcdef", "cdeéQ1", "ñß.") for n in (1, 5, 40, 300)] + ["a" * 600, "QQQ", "x" * 257, "\U0001f600a", "İab"]
    names, scores = model.predict(texts)
    for t, name, score in zip(texts, names, scores, strict=True):
        n = sorted((phrases(t, s), k) for k, s in samples.items())
        assert (name, score) == (n[0][1], n[1][0] / (n[0][0] + n[1][0])), t[:40]


def test_no_letters_no_languages():
    model = L.Model({"en": "some text", "de": "ein Text"})
    assert model.predict([None, "", "123 !?", "\U0001f600"]) == (["und"] * 4, [0.0] * 4)
    assert L.Model({"en": "some text"}).predict(["any"]) == (["en"], [1.0])
    assert L.Model({}).predict(["any", None]) == (["und", "und"], [0.0, 0.0])


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf.replace("0.001", "0.01"), "documents")
    rows = L.predicted(spark, docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean(held) >= 0.98


def test_predictions_see_the_text_alone(spark, sf):
    docs = table(spark, sf, "documents")
    texts = L.samples(docs)
    shuffled = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 5 = 0 then 'xx' else lang end as lang", "'s' as source")
    assert L.samples(shuffled) == texts
    assert "xx" not in {r["lang_pred"] for r in L.predicted(spark, shuffled).collect()}


def test_edge_rows(spark, edges, nothing):
    rows = L.predicted(spark, edges).collect()
    assert len(rows) == len(edge_rows()) and {r["doc_id"] for r in rows} == {r[0] for r in edge_rows()}
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (2, 3, 10))
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert L.predicted(spark, nothing).collect() == []
