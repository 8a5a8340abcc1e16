"""Words and word n-grams of many texts at once, as 64-bit hashes, over their UTF-8 bytes.

A word is a maximal run of bytes other than the six ASCII white-space characters. Every result
is a numpy array over the words of a slice of documents; the hash of a word depends only on its
bytes (lower-cased A-Z where asked).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # texts are handled in slices of about this many bytes (one long text may exceed it)

_U = np.uint64
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x.astype(_U)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_VALUE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for_base = [np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, p, _U)]))
                        for p in (_BASE, inverse)]
        _POWERS[:] = for_base
    return _POWERS[0], _POWERS[1]


class Slice:
    """Some consecutive documents: ``n`` of them from number ``at`` of the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, at: int):
        self.at, self.n = at, len(offsets) - 1
        self.data = data[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        size = len(self.data)
        solid = ~_SPACE[self.data]
        begins = np.ones(size + 1, bool)
        begins[1:size] = ~solid[:-1] if size else begins[1:size]
        begins[self.offsets] = True  # a word never crosses documents
        self.solid = solid
        self.starts = np.flatnonzero(solid & begins[:size])
        after = begins[1:] | np.append(~solid[1:], True) if size else np.zeros(0, bool)
        self.ends = np.flatnonzero(solid & after) + 1
        #: words before each document, one longer than the documents
        self.first = np.searchsorted(self.starts, self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    def word_hashes(self, lower: bool) -> np.ndarray:
        power, inverse = _powers(len(self.data) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(self.data) + 1, _U)
            np.cumsum((_LOWER if lower else _VALUE)[self.data] * power[:len(self.data)], out=total[1:])
            return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])

    def gram_hashes(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on; the last ``k - 1`` of a document are not valid."""
        n = len(words)
        total = np.zeros(n, _U)
        weight = _U(1)
        with np.errstate(over="ignore"):
            for j in range(min(k, n)):
                total[:n - j] += words[j:] * weight
                weight = weight * _STEP
        return mix(total)

    def shingles(self, k: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the document in the batch, its distinct k-word shingles in ascending order).

        Fewer words than ``k`` make one shingle; no word, none.
        """
        words = self.word_hashes(lower)
        grams = self.gram_hashes(words, k)
        for i in range(self.n):
            a, b = self.first[i], self.first[i + 1]
            if b - a >= k:
                yield self.at + i, np.unique(grams[a:b - k + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    short = sum((words[a + j] * _STEP ** _U(j) for j in range(b - a)), _U(b - a))
                yield self.at + i, mix(np.array([short], _U))
            else:
                yield self.at + i, np.zeros(0, _U)


def slices(texts: pa.Array) -> Iterator[Slice]:
    """The texts of an Arrow string column (null: empty), in slices of bounded size."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        to = min(to, len(texts))
        yield Slice(data, offsets[at:to + 1], at)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set of shingles."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(shingles ^ _BASE)) + _U(len(shingles)) * _STEP if len(shingles) else _U(0)
    return int(mix(np.array([total], _U)).view(np.int64)[0])
