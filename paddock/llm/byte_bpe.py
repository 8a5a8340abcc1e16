"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the tokenizer's pattern. A minimal perfect hash over the vocabulary
resolves pre-tokens that are tokens themselves: one slot of a table that has exactly one entry per
token is read and compared. Any other pre-token is merged: its bytes form a linked list, and a heap
of neighbouring pairs gives the pair of the lowest rank next, so a run of n bytes takes
O(n log n) steps. What a task has resolved it keeps in a table of at most ``KEPT`` short pre-tokens.

The vocabulary is a fixed file, so what is broadcast doesn't grow with the data. A null text is
empty; a null doc_id is kept as it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import ship_package

KEPT = 400_000        # pre-tokens a task keeps resolved
KEPT_BYTES = 64       # of at most so many bytes
PER_BUCKET = 4        # tokens per bucket of the perfect hash, on average
_MASK = (1 << 64) - 1
_SEED, _SPREAD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError(f"the ranks in {path} are not 0 to {len(ranks) - 1}")
    return sorted(ranks, key=ranks.get)


def _slot(key: int, seed: int, n: int) -> int:
    return (((key ^ (seed * _SEED & _MASK)) * _SPREAD & _MASK) >> 32) % n


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: as many slots as strings.

    Buckets with several strings get the first seed that sends them all to free slots, largest
    buckets first; a bucket with one string names its slot itself (as -1 - slot).
    """

    TRIED_AT_ONCE = 256

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // PER_BUCKET)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        bucket = ((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        members = np.split(order, np.cumsum(sizes)[:-1])
        seeds, entry = [0] * self.buckets, np.full(n, -1, np.int64)
        by_size = np.argsort(-sizes, kind="stable").tolist()
        for b in by_size:
            own = members[b]
            if len(own) < 2:
                break
            first = 1
            while not seeds[b]:
                tried = np.arange(first, first + self.TRIED_AT_ONCE, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    slots = (((hashes[own] ^ (tried * np.uint64(_SEED))[:, None]) * np.uint64(_SPREAD)) >> np.uint64(32)) % np.uint64(n)
                slots = np.sort(slots.astype(np.int64), axis=1)
                good = np.flatnonzero((entry[slots] < 0).all(1) & (slots[:, 1:] != slots[:, :-1]).all(1))
                if len(good):
                    seeds[b] = int(tried[good[0]])
                first += self.TRIED_AT_ONCE
            for i in own.tolist():
                entry[_slot(int(hashes[i]), seeds[b], n)] = i
        free = iter(np.flatnonzero(entry < 0).tolist())
        for b in by_size:
            if len(members[b]) == 1:
                slot = next(free)
                seeds[b], entry[slot] = -1 - slot, members[b][0]
        self.seeds, self.entry = seeds, entry.tolist()

    def candidate(self, key: bytes) -> int:
        """The number of the only string that ``key`` can be; the caller compares."""
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[(h >> 32) % self.buckets]
        return self.entry[-1 - seed if seed < 0 else _slot(h, seed, self.n)]


class Tokenizer:
    """Encoding and decoding by a vocabulary of tokens in rank order and a pre-token pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, regex.compile(pattern)
        self.hash = PerfectHash(tokens)
        self.single = [self.rank(bytes([x])) for x in range(256)]
        # what two neighbouring tokens make, by first * tokens + second
        self.pairs: dict[int, int] = {}
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                if (a := self.rank(token[:cut])) >= 0 and (b := self.rank(token[cut:])) >= 0:
                    self.pairs[a * len(tokens) + b] = i
        self.kept: dict[str, bytes] = {}
        joined = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts, self.bytes = np.cumsum(self.lengths) - self.lengths, joined

    def rank(self, key: bytes) -> int:
        """The token's rank, or -1."""
        i = self.hash.candidate(key)
        return i if self.tokens[i] == key else -1

    def merged(self, piece: bytes) -> list[int]:
        """Ranks of the tokens that merging by lowest rank (leftmost first) makes of a piece."""
        n, size, pair = len(piece), len(self.tokens), self.pairs.get
        ids = [self.single[x] for x in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [pair(ids[i] * size + ids[i + 1], -1) for i in range(n - 1)] + [-1]  # of each part with the next
        bits = n.bit_length()
        at = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i, r = x & at, x >> bits
            if rank[i] != r:
                continue  # one of the two has changed since
            gone = after[i]
            j = after[i] = after[gone]
            rank[gone], ids[i] = -1, r
            rank[i] = -1
            if j < n:
                before[j] = i
                if (new := pair(r * size + ids[j], -1)) >= 0:
                    rank[i] = new
                    heappush(heap, new << bits | i)
            if (h := before[i]) >= 0:
                rank[h] = new = pair(ids[h] * size + r, -1)
                if new >= 0:
                    heappush(heap, new << bits | h)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def resolve(self, word: str) -> bytes:
        """A pre-token's ids as little-endian unsigned 32-bit integers."""
        data = word.encode("utf-8")
        whole = self.rank(data)
        ids = np.array([whole] if whole >= 0 else self.merged(data), "<u4").tobytes()
        if len(data) <= KEPT_BYTES:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            self.kept[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        kept, resolve = self.kept, self.resolve
        return b"".join([kept.get(w) or resolve(w) for w in self.pattern.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        """The tokens' bytes, one after the other."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(numbers):
            return b""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = self.starts[numbers] - (ends - lengths)
        return self.bytes[np.arange(ends[-1]) + np.repeat(shift, lengths)].tobytes()


_TOKENIZERS: dict[str, Tokenizer] = {}


def _tokenizer(tokens: list[bytes], pattern: str) -> Tokenizer:
    """One tokenizer per worker process and vocabulary."""
    key = hashlib.sha256(b"".join(tokens) + pattern.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer(tokens, pattern)
    return _TOKENIZERS[key]


def encoded(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row; the ids themselves too if asked for."""
    ship_package(spark)
    vocabulary = spark.sparkContext.broadcast(read_ranks(rank_file))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from paddock.llm import byte_bpe
        tokenizer = byte_bpe._tokenizer(vocabulary.value, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = tokenizer.encode(text or "")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(tokenizer.decode(ids)).hexdigest(), ids))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            arrays = [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in columns[3]], pa.list_(pa.int64())))
            yield pa.record_batch(arrays, names=names)
        tokenizer.kept.clear()  # a worker outlives the stage

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
