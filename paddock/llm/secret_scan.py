"""Secret scan with multipart credential linking.

Certain secrets (the base kinds) are found by pattern alone: assignments to a secret's name, access
identifiers and long hexadecimal strings. Weak candidates - short access identifiers, bare random-looking
strings, endpoints - prove nothing alone. They are reported only when complementary parts of one
credential co-occur within a scope: an identifier (certain or weak), a secret (an assignment, a
hexadecimal string or a bare random string) and an endpoint. The parts are joined as intervals: each
part reaches ``SCOPE`` code points to either side of its start, and a weak part counts if parts of the
two other roles reach its start in the same document.

Where a document has no identifier or no endpoint, none of its weak parts can count, so bare strings
are only looked for in the others. The join is on (document, window of SCOPE code points), so that the parts
of a very long document meet in many keys, and it is a semi join per role: it never lists pairs.

Spans are ``kind:start:end`` in code points, end exclusive. A null text is empty. A null doc_id is
kept as it is; rows are told apart by an own number, so repeated rows stay apart.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import fresh, join_small, ship_package, written

SCOPE = 400
KINDS = ("assign", "access", "hex")
# The patterns work on ASCII lower-cased bytes (assign) or on the bytes (the others).
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")  # maximal runs, as a shorter run can't hold a longer one
_WEAK_ACCESS = re.compile(rb"(?<![A-Za-z0-9])(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{8,}(?![A-Za-z0-9])")
_ENDPOINT = re.compile(rb"(?:https?|s3|jdbc:[a-z]+|redis|amqp|mongodb)://[A-Za-z0-9.-]+(?::[0-9]+)?")
_WEAK_SECRET = re.compile(rb"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9A-Z+/_-]*[a-z])(?=[0-9a-z+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
#: role of each kind in a credential
ROLES = {"assign": "secret", "hex": "secret", "access": "identifier", "weak_access": "identifier",
         "weak_secret": "secret", "endpoint": "endpoint"}
ORDER = [*KINDS, "weak_access", "weak_secret", "endpoint"]


def base_parts(data: bytes) -> list[tuple[str, int, int]]:
    """The certain secrets of a text: kind, start, end in bytes."""
    found = []
    low = data.lower()  # bytes: A-Z only
    if any(name in low for name in _NAMES):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(low) if m.end(1) - m.start(1) >= 6]
    if b"AKIA" in data:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(data)]
    return found


def weak_parts(data: bytes, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates outside the certain secrets, where the document has an identifier and an endpoint."""
    points = [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(data)] if b"://" in data else []
    if not points:
        return []
    access = [("weak_access", m.start(), m.end()) for m in _WEAK_ACCESS.finditer(data)]
    if not access and not any(k == "access" for k, _, _ in base):
        return []
    found = access + [("weak_secret", m.start(), m.end()) for m in _WEAK_SECRET.finditer(data)]
    taken = sorted((a, b) for _, a, b in base)
    return points + [x for x in found if not any(a < x[2] and x[1] < b for a, b in taken)]


def _code_points(data: bytes, parts: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out, at, chars = {}, 0, 0
    for place in sorted({p for _, a, b in parts for p in (a, b)}):
        chars += len(data[at:place].decode("utf-8"))
        at = place
        out[place] = chars
    return [(k, out[a], out[b]) for k, a, b in parts]


def in_order(parts) -> list[tuple[str, int, int]]:
    return sorted(parts, key=lambda x: (x[1], ORDER.index(x[0]), x[2]))


def joined(parts) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in in_order(parts))


_PART = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SCAN = "row long, doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, parts array<struct<kind:string,start:long,end:long>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text"):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            base = base_parts(data)
            weak = weak_parts(data, base)
            base, weak = _code_points(data, base), _code_points(data, weak)
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), [dict(zip(("kind", "start", "end"), p, strict=True)) for p in in_order(base + weak)]))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.record_batch([batch.column("row"), batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                               pa.array(columns[3], pa.string()), pa.array(columns[4], pa.list_(_PART))],
                              names=["row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "parts"])


def _linked(scan: DataFrame) -> DataFrame:
    """row, kind, start, end of the weak parts that parts of both other roles reach."""
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    parts = (scan.filter(F.exists("parts", lambda p: p["kind"].startswith("weak") | (p["kind"] == "endpoint")))
             .select("row", F.explode("parts").alias("p")).select("row", "p.*", role[F.col("p.kind")].alias("role")))
    # a part lies in the window of its start; a reach is listed in every window that it touches
    window = F.floor(F.col("start") / SCOPE)
    reach = parts.select("row", "role", (F.col("start") - SCOPE).alias("from"), (F.col("start") + SCOPE).alias("to"))
    reach = reach.withColumn("window", F.explode(F.sequence(F.floor(F.greatest("from", F.lit(0)) / SCOPE), F.floor(F.col("to") / SCOPE))))
    weak = parts.filter(~F.col("kind").isin(*KINDS)).withColumn("window", window)
    for role_met in ("identifier", "secret", "endpoint"):  # a part reaches itself, so its own role is met
        w, o = weak.alias("w"), reach.filter(F.col("role") == role_met).alias("o")
        weak = w.join(o, (F.col("w.row") == F.col("o.row")) & (F.col("w.window") == F.col("o.window"))
                      & F.col("w.start").between(F.col("o.from"), F.col("o.to")), "left_semi").select("w.*")
    return weak.select("row", "kind", "start", "end")


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """row, doc_id, counts and digest of the base spans, and ``found``: all spans reported, in order."""
    ship_package(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scan = written(spark, rows.mapInArrow(_scan, _SCAN), "secrets-scan")
    links = _linked(scan).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    base = F.filter("parts", lambda p: p["kind"].isin(*KINDS))
    place = F.create_map(*[F.lit(x) for i, k in enumerate(ORDER) for x in (k, i)])
    every = F.concat(base, F.coalesce("more", F.array().cast("array<struct<kind:string,start:long,end:long>>")))
    ordered = F.array_sort(F.transform(every, lambda p: F.struct(p["start"].alias("start"), place[p["kind"]].alias("place"), p["end"].alias("end"), p["kind"].alias("kind"))))
    return (scan.join(links, "row", "left")
            .select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", ordered.alias("found")))


def spans_text(found):
    return F.array_join(F.transform(found, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])), ",")


def _key():
    """Rows with equal doc_id and text have the same spans."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by ``[kind]``; the text's length in n_chars follows.

    Certain spans are found again where the text is; only the linked weak ones are joined to it.
    """
    ship_package(spark)
    rows = docs.select(_key().alias("row"), F.lit(None).cast("long").alias("doc_id"), "text")
    scan = rows.mapInArrow(_scan, _SCAN).filter(F.exists("parts", lambda p: ~p["kind"].isin(*KINDS)))
    links = _linked(written(spark, scan.select("row", "parts").groupBy("row").agg(F.min("parts").alias("parts")), "secrets-weak"))
    names = docs.columns
    key, extra = fresh(docs, "key"), fresh(docs, "more")
    more = written(spark, links.groupBy(F.col("row").alias(key)).agg(F.collect_set(F.struct("kind", "start", "end")).alias(extra), F.count("*").alias("spans")), "secrets-linked")
    n = more.agg(F.sum("spans")).first()[0] or 0
    both = join_small(docs.withColumn(key, _key()), more.drop("spans"), key, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else cut(t, m or []) for t, m in zip(batch.column("text").to_pylist(), batch.column(extra).to_pylist(), strict=True)]
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(texts, batch.schema.field("text").type)}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(columns["n_chars"].type)
            yield pa.record_batch(list(columns.values()), names=names)

    return both.mapInArrow(run, docs.schema)


def cut(text: str, more: list[dict]) -> str:
    """The text without its certain secrets and the spans ``more``. Spans may overlap; what any of them
    covers goes, marked by the kind that comes first."""
    data = text.encode()
    base = base_parts(data)
    if not base and not more:
        return text
    out, at = [], 0
    for kind, start, end in in_order([*_code_points(data, base), *((p["kind"], p["start"], p["end"]) for p in more)]):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
