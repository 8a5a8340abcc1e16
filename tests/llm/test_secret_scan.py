import hashlib
import re

from conftest_llm import edge_rows

from paddock.llm import secret_scan as S

PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}
TEXTS = [
    'é\U0001f600 Password = "hunter22" and TOKEN:abcdef; token=token: abcdefgh secret=ab api_key="x.y-z/1" apikey : \'123456\'',
    "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 12 + " AKIA" + "C" * 15 + " xAKIA" + "9" * 30,
    "deadbeef" * 3 + " " + "DEADBEEF" * 3 + " " + "0123456789abcdef" * 4 + "g" + "a" * 23,
    "ſecret=abcdefgh toKen=abcdefgh",   # letters that fold to ASCII don't count
    "password=" + "a" * 100_000, "=" * 50, "token token = = 'a' \"", "secret:\n abcdefgh", "secret:   abcdefgh secret\t: abcdefgh",
]


def base(text):
    found = [(k, m.start(), m.end()) for k, (p, ok) in PATTERNS.items() for m in p.finditer(text or "") if ok(m)]
    return sorted(found, key=lambda x: (x[1], list(PATTERNS).index(x[0])))


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in S.scanned(spark, df).select("*", S.spans_text("found").alias("spans")).collect()}


def test_base_spans(spark):
    texts = TEXTS + [r[1] for r in edge_rows()]
    for i, r in run(spark, texts).items():
        want = base(texts[i])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in want) for k in PATTERNS]
        assert r["spans"] == text


ID, KEY, HOST = "AKIA" + "X" * 10, "aB3" * 7 + "x", "https://api.example.com:8443"


def test_weak_parts_count_only_together(spark):
    pad = "lorem ipsum " * 50
    texts = [f"id {ID} key {KEY} at {HOST}", f"id {ID} key {KEY}", f"key {KEY} at {HOST}", f"{ID} {HOST}", KEY,
             f"{ID} {KEY} {pad} {HOST}", f"{ID} {pad} {KEY} {HOST}", f"é{'é' * 390} {HOST} {ID} {KEY}",
             f"secret={'k' * 8} {HOST} AKIA{'Z' * 16} {pad} {pad} {HOST}"]
    got = {i: [p["kind"] for p in r["found"]] for i, r in run(spark, texts).items()}
    weak = ["weak_access", "weak_secret", "endpoint"]
    assert got[0] == weak and got[7] == [weak[2], weak[0], weak[1]]
    assert all(got[i] == [] for i in (1, 2, 3, 4, 5, 6))
    assert got[8] == ["assign", "endpoint", "access"]
    r = run(spark, [f"\U0001f600 id {ID} key {KEY} at {HOST}!"])[0]
    text = f"\U0001f600 id {ID} key {KEY} at {HOST}!"
    assert [text[p["start"]:p["end"]] for p in r["found"]] == [ID, KEY, HOST]


def test_links_as_brute_force(spark):
    """Any weak part with parts of all three roles that start within the scope of its own start."""
    import random
    rng = random.Random(3)
    texts = [" ".join(rng.choice([ID, KEY, HOST, "w" * rng.randint(1, 150), f"token={'q' * 9}", "AKIA" + "Y" * 16]) for _ in range(60)) for _ in range(12)]
    for i, r in run(spark, texts).items():
        data = texts[i].encode()
        parts = S.base_parts(data)
        parts += S.weak_parts(data, parts)
        want = [p for p in parts if p[0] in S.KINDS or {"identifier", "secret", "endpoint"} == {S.ROLES[k] for k, a, _ in parts if abs(a - p[1]) <= S.SCOPE}]
        assert r["spans"] == S.joined(want)


def test_edge_rows_are_redacted(spark, edges, nothing):
    out = S.redacted(spark, edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    assert sorted(map(str, (r[1] for r in out.collect()))) == sorted(str(r[1]) for r in edge_rows())
    assert S.redacted(spark, nothing).collect() == [] and S.scanned(spark, nothing).collect() == []
    df = spark.createDataFrame([(1, f"a token = \"{'f' * 40}\" b {ID} {KEY} {HOST} é", "en", "a", 5), (1, None, None, None, None), (None, f"x AKIA{'X' * 16}", "en", "a", 5)],
                               nothing.schema)
    got = {r["doc_id"] or 0: (r["text"], r["n_chars"]) for r in S.redacted(spark, df.filter("text is not null")).collect()}
    text = "a [assign]\" b [weak_access] [weak_secret] [endpoint] é"
    assert got == {1: (text, len(text)), 0: ("x [access]", 10)}
