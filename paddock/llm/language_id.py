"""Language identification by cross-parsing entropy.

For each language the labelled text of a bounded sample is made into a suffix automaton. A text is parsed
greedily into the longest pieces that occur in a language's sample; the fewer phrases a language
needs per character, the closer the text is to it. The language with the fewest wins.

Texts are parsed in pieces of ``CHUNK`` characters, every character of every text, so that long and
short texts take the same steps: all pieces of a batch walk an automaton together, one character at
a time, by a table from (state, character) to the next state and the phrases that end there. A piece's end
ends its last phrase. Letters are lower-cased; whatever isn't a letter counts as one space.

Fitting: at most ``ROWS`` labelled documents per language, those with the smallest hash of doc_id among
documents with crc32(doc_id) mod 5 other than 0, and of each an excerpt of ``EXCERPT`` characters
from its middle. ``lang``, ``source`` and ``doc_id`` are never seen in a prediction.

The score is s / (s + b) for the phrases b of the best and s of the second language (0.5 to 1; 1 if there is
one language only); ties go to the smaller name. A text that is null or has no letter is ``und`` with score 0.
A null doc_id isn't held out and isn't learned from. Without any labelled row every text is ``und``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import ship_package

ROWS, EXCERPT = 60, 400   # the fitting sample of a language: 24,000 characters at most
CHUNK = 256
FOLDS = 5
UNDETERMINED = "und"
_SPACE, _RARE = 0, 1      # letters of no sample share one code
_CODES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """The lower-case code point of each code point that is a letter, else 0."""
    if "letters" not in _CODES:
        table = np.zeros(0x110000, np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _CODES["letters"] = table
    return _CODES["letters"]


class Automaton:
    """The suffix automaton of a code sequence, as a table of steps that never fails.

    ``step[state * size + code]`` is ``next state * 4 + phrases that end before or with this character``.
    """

    def __init__(self, codes: list[int], size: int):
        follow: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes:
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = new
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        # no way on: the phrase ends and a new one begins; a character that no phrase begins with is one itself
        begin = np.full(size, 1, np.int32)
        begin[list(follow[0])] = [t * 4 for t in follow[0].values()]
        self.step = np.tile(np.where(begin == 1, 2, begin + 1).astype(np.int32), (len(follow), 1))
        self.step[0] = begin
        for state, ways in enumerate(follow):
            if state and ways:
                self.step[state, list(ways)] = [t * 4 for t in ways.values()]
        self.size, self.step = size, self.step.ravel()

    def phrases(self, codes: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``codes`` (one step per row); -1 ends a column early."""
        columns = codes.shape[1]
        state, count = np.zeros(columns, np.int64), np.zeros(columns, np.int64)
        live = columns  # columns are sorted by length, longest first
        for row in codes:
            while live and row[live - 1] < 0:
                live -= 1
            step = self.step[state[:live] * self.size + row[:live]]
            count[:live] += step & 3
            state[:live] = step >> 2
        return count + (state > 0)


class Model:
    """An automaton for each language, over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        letters = _letters()
        seen = sorted({int(x) for t in samples.values() for x in letters[_points(t)]} - {0})
        self.size = len(seen) + 2
        self.code = np.where(letters > 0, _RARE, _SPACE).astype(np.int16)
        known = np.zeros(0x110000, np.int16)
        known[seen] = np.arange(2, self.size)
        self.code = np.where(known[letters] > 0, known[letters], self.code)
        self.automata = [Automaton(self.code[_points(samples[n])].tolist(), self.size) for n in self.names]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lengths = np.array([len(t or "") for t in texts], np.int64)
        codes = self.code[_points("".join(t or "" for t in texts))]
        first = np.cumsum(lengths) - lengths
        pieces = -(-lengths // CHUNK)
        doc = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = first[doc] + number * CHUNK
        sizes = np.minimum(CHUNK, lengths[doc] - number * CHUNK)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes, doc = starts[order], sizes[order], doc[order]
        best_names, scores = [], []
        has_letter = np.zeros(len(texts), bool)
        total = np.zeros((len(texts), len(self.names)), np.int64)
        for at in range(0, len(doc), 8192):
            part = slice(at, at + 8192)
            step = np.arange(CHUNK)[:, None]
            inside = step < sizes[part]
            rows = np.where(inside, codes[np.minimum(starts[part] + step, max(len(codes) - 1, 0))], -1) if len(codes) else np.zeros((0, 0), int)
            np.logical_or.at(has_letter, doc[part], (rows > 0).any(0))
            for k, automaton in enumerate(self.automata):
                np.add.at(total[:, k], doc[part], automaton.phrases(rows))
        for i in range(len(texts)):
            if not has_letter[i] or not self.names:
                best_names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            ranked = np.argsort(total[i], kind="stable")
            best_names.append(self.names[ranked[0]])
            b, s = total[i][ranked[0]], total[i][ranked[1]] if len(ranked) > 1 else 0
            scores.append(float(s / (s + b)) if len(ranked) > 1 else 1.0)
        return best_names, scores


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _fold() -> F.Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS


def samples(docs: DataFrame) -> dict[str, str]:
    """The labelled text of each language: at most ROWS * EXCERPT characters reach the driver for each."""
    row = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (_fold() != 0))
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - EXCERPT) / 2) + 1).cast("int")
    row = row.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"), F.substr("text", middle, F.lit(EXCERPT)).alias("text"))
    best = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    rows = row.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= ROWS).select("lang", "n", "text").collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return {lang: " ".join(texts) for lang, texts in out.items()}


_MODELS: dict[str, Model] = {}


def _model(texts: dict[str, str]) -> Model:
    """One model per worker process and sample."""
    key = hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(texts)
    return _MODELS[key]


def predicted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    texts = spark.sparkContext.broadcast(samples(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from paddock.llm import language_id
        model = language_id._model(texts.value)
        for batch in batches:
            column, names, scores = batch.column("text"), [], []
            for at in range(0, batch.num_rows, 500):
                n, s = model.predict(column.slice(at, 500).to_pylist())
                names += n
                scores += s
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
