"""Quality rules: per-document statistics, hard limits, and an isolation forest on the statistics.

Words are maximal runs of anything but the six ASCII white-space characters. The hard limits
(``base_failed``) are fewer than 50 words, or more than half of the words inside repeated 3-word
windows. The forest sees rates made from the statistics; documents that few random splits isolate are
anomalous. The cut on its score is calibrated from labelled rows (``labels.quality``): it catches as
many bad rows as it can while at most ``MAX_GOOD_LOST`` of the good ones go.

All labelled documents that pass the hard limits take part: the trees draw their ``ROWS_A_TREE`` rows
from all of them, each tree anew (the subsampling that makes an isolation forest), and the cut is the
exact order statistic of all their scores. Statistics and verdicts cover every document.
Without labelled rows of both kinds only the hard limits decide.

Nulls: a null text has no words and fails the hard limits. A null doc_id is kept as it is. Labels
with a null doc_id or quality don't count; of several labels of a document the lowest does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import ship_package, written
from paddock.llm.textnum import mix, slices

MIN_WORDS, MAX_REPEATED = 50, 50          # words; percent of the words
TREES, ROWS_A_TREE, BAD_SHARE = 150, 256, 0.06
MAX_GOOD_LOST = 0.003
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")

_SYMBOL, _UPPER, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_MARK[list(b"!?")] = True


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Each of ``STATISTICS`` for every text."""
    out = {k: np.zeros(len(texts), np.int64) for k in STATISTICS}
    for part in slices(texts):
        at = slice(part.at, part.at + part.n)

        def count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            total = np.zeros(len(mask) + 1, np.int64)
            np.cumsum(mask, out=total[1:])
            return np.diff(total[offsets])

        data = part.data
        out["n_words"][at] = np.diff(part.first)
        out["word_chars"][at] = count(part.solid & ((data & 0xC0) != 0x80), part.offsets)
        for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_marks", _MARK)):
            out[name][at] = count(table[data], part.offsets)
        out["n_repeat_words"][at] = count(_repeated(part), part.first)
        for i in range(part.n):
            lines = [x for x in part.text(i).split(b"\n") if x.strip()]
            out["n_lines"][part.at + i], out["n_dup_lines"][part.at + i] = len(lines), len(lines) - len(set(lines))
    return out


def _repeated(part) -> np.ndarray:
    """Words inside a 3-word window that its document has twice or more."""
    n = len(part.starts)
    cover = np.zeros(n + 1, np.int64)
    doc = np.repeat(np.arange(part.n), np.diff(part.first))
    whole = np.flatnonzero(doc[2:] == doc[:-2]) if n > 2 else np.zeros(0, np.int64)
    if len(whole):
        grams = mix(part.gram_hashes(part.word_hashes(lower=False), 3)[whole] + mix(doc[whole].astype(np.uint64)))
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        often = whole[order[np.append(same, False) | np.append(False, same)]]
        np.add.at(cover, often, 1)
        np.add.at(cover, often + 3, -1)
    return np.cumsum(cover)[:n] > 0


def rates(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees: rates that hardly depend on a document's length. The added constants keep
    a few marks of a short document from counting as a high rate; repetition counts from a quarter of
    the words or lines on, as headings and refrains repeat in good documents too."""
    words, lines = s["n_words"] + 20, s["n_lines"] + 20
    return np.stack([s["n_symbols"] / words, np.maximum(s["n_upper"] / (s["n_letters"] + 100), 0.1), s["n_marks"] / words,
                     np.maximum(s["n_repeat_words"] / words, 0.25), np.maximum(s["n_dup_lines"] / lines, 0.25)], axis=1)


class Forest:
    """Isolation trees as arrays; the children of node i are 2 i + 1 and 2 i + 2."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        n_good, n_bad = rows_a_tree(len(good), len(bad))
        self._plant([np.concatenate([good[rng.choice(len(good), n_good, replace=False)], bad[rng.choice(len(bad), n_bad, replace=False)]])
                     for _ in range(TREES)], rng)

    @classmethod
    def of(cls, drawn: list[np.ndarray], seed: int = 7) -> Forest:
        """A tree from each of ``TREES`` sets of rows."""
        forest = cls.__new__(cls)
        forest._plant(drawn, np.random.default_rng(seed))
        return forest

    def _plant(self, drawn: list[np.ndarray], rng) -> None:
        self.rows = max(map(len, drawn))
        self.depth = max(1, math.ceil(math.log2(max(2, self.rows))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.full((TREES, nodes), -1, np.int64)
        self.cut, self.length = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
        for t, rows in enumerate(drawn):
            self._grow(t, 0, 0, rows, rng)

    def _grow(self, t: int, node: int, depth: int, rows: np.ndarray, rng) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        open_ = np.flatnonzero(high > low)
        if depth == self.depth or not len(open_):
            self.length[t, node] = depth + mean_length(len(rows))
            return
        f = rng.choice(open_)
        cut = rng.uniform(low[f], high[f])
        self.feature[t, node], self.cut[t, node] = f, cut
        right = rows[:, f] > cut
        self._grow(t, 2 * node + 1, depth + 1, rows[~right], rng)
        self._grow(t, 2 * node + 2, depth + 1, rows[right], rng)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected length): near 1 for anomalies."""
        tree, row = np.arange(TREES)[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), TREES), np.int64)
        for _ in range(self.depth):
            f = self.feature[tree, node]
            right = x[row, np.maximum(f, 0)] > self.cut[tree, node]
            node = np.where(f < 0, node, 2 * node + 1 + right)
        return 2.0 ** (-self.length[tree, node].mean(1) / max(mean_length(self.rows), 1e-9))


def mean_length(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649 if n > 2 else 0.5) - 2 * (n - 1) / n


def rows_a_tree(good: int, bad: int) -> tuple[int, int]:
    """How many good and bad rows a tree draws."""
    n_bad = min(bad, round(BAD_SHARE * ROWS_A_TREE))
    return min(good, ROWS_A_TREE - n_bad), n_bad


class Model:
    def __init__(self, forest: Forest | None, cut: float):
        self.forest, self.cut = forest, cut

    def verdicts(self, s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, anomaly score, kept."""
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEATED * s["n_words"])
        scores = self.forest.scores(rates(s)) if self.forest else np.zeros(len(failed))
        return failed, scores, ~failed & (scores <= self.cut)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality and rates of every labelled document that passes the hard limits. The rates are made before the join, so
    that no text is shuffled."""
    by_doc = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .dropna().groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
            .mapInArrow(_usual_rates, "doc_id long, rates array<double>").groupBy("doc_id").agg(F.min("rates").alias("rates")))
    return rows.join(by_doc, "doc_id").select("doc_id", "quality", "rates")


def _usual_rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = statistics(batch.column("text"))
        usual = (s["n_words"] >= MIN_WORDS) & (100 * s["n_repeat_words"] <= MAX_REPEATED * s["n_words"])
        yield pa.record_batch([batch.column("doc_id"), pa.array(list(rates(s)), pa.list_(pa.float64()))], names=["doc_id", "rates"]).filter(pa.array(usual))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _drawn(rows: DataFrame, good: int, bad: int) -> list[np.ndarray]:
    """The rows of each tree, drawn from all: those of its least hashes. Hashes under a limit that more than enough rows
    stay under are numbered, so that a tree's number of rows doesn't depend on how many there are."""
    wanted = dict(zip((True, False), rows_a_tree(good, bad), strict=True))
    limit = {k: int(2 ** 63 * min(1.0, (n + 8 * math.sqrt(n) + 20) / m)) for (k, n), m in zip(wanted.items(), (good, bad), strict=True)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = mix(np.arange(1, TREES + 1, dtype=np.uint64) << np.uint64(32))
        for batch in batches:
            is_good = batch.column("quality").to_numpy() > 0
            ids = mix(batch.column("doc_id").to_numpy().view(np.uint64))
            h = mix(ids[:, None] ^ trees[None, :]) >> np.uint64(1)
            row, tree = np.nonzero(h < np.where(is_good, np.uint64(limit[True]), np.uint64(limit[False]))[:, None])
            taken = batch.take(pa.array(row))
            yield pa.record_batch([pa.array(tree.astype(np.int32)), pa.array(is_good[row]), pa.array(h[row, tree].astype(np.int64)),
                                   taken.column("doc_id"), taken.column("rates")], names=["tree", "good", "h", "doc_id", "rates"])

    found = rows.mapInArrow(run, "tree int, good boolean, h long, doc_id long, rates array<double>")
    place = F.row_number().over(Window.partitionBy("tree", "good").orderBy("h", "doc_id"))
    found = found.withColumn("place", place).where(F.col("place") <= F.when(F.col("good"), wanted[True]).otherwise(wanted[False]))
    found = found.select("tree", "good", "place", "rates").toPandas().sort_values(["tree", "good", "place"])
    return [np.array(x["rates"].tolist()) for _, x in found.groupby("tree")]


def _calibrated(spark: SparkSession, rows: DataFrame, forest: Forest, good: int) -> float:
    """A cut that loses at most ``MAX_GOOD_LOST`` of the good scores: midway from there to the next bad score."""
    shared = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(_matrix(batch.column("rates")))
            yield pa.record_batch([pa.array(batch.column("quality").to_numpy() > 0), pa.array(scores), pa.array(scores.view(np.int64))],
                                  names=["good", "score", "bits"])

    scores = written(spark, rows.mapInArrow(run, "good boolean, score double, bits long"), "quality-scores")
    edge = float(np.int64(_order_statistic(scores.where("good"), good - 1 - math.floor(MAX_GOOD_LOST * good))).view(np.float64))
    above = scores.where(~F.col("good") & (F.col("score") > edge)).agg(F.min("score")).first()[0]
    return (edge + above) / 2 if above is not None else scores.where("good").agg(F.max("score")).first()[0]


def _order_statistic(rows: DataFrame, rank: int) -> int:
    """The ``rank``-th least, from 0, of the longs ``bits``, none negative (positive doubles have the order of their bits):
    16 bits at a time, by counts."""
    found = 0
    for shift in (48, 32, 16, 0):
        same = rows if shift == 48 else rows.where(F.shiftright("bits", shift + 16) == found)
        counts = same.groupBy(F.shiftright("bits", shift).alias("d")).agg(F.count("*").alias("n")).collect()   # at most 65,536
        for d, n in sorted(map(tuple, counts)):
            if rank < n:
                found = d
                break
            rank -= n
    return found


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """The forest and its cut, from all labelled documents that pass the hard limits."""
    ship_package(spark)
    rows = written(spark, _labelled(docs, labels), "quality-rates")
    good, bad = rows.agg(F.count_if(F.col("quality") > 0), F.count_if(F.col("quality") <= 0)).first()
    if good < 20 or bad < 5:
        return Model(None, math.inf)
    forest = Forest.of(_drawn(rows, good, bad))
    return Model(forest, _calibrated(spark, rows, forest, good))


def judged(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the statistics, base_failed, score and kept, one row per document."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column("text"))
            failed, scores, kept = shared.value.verdicts(s)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(s[k]) for k in STATISTICS), pa.array(failed), pa.array(scores), pa.array(kept)],
                                  names=["doc_id", *STATISTICS, "base_failed", "score", "kept"])

    columns = ", ".join(f"{k} long" for k in STATISTICS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, {columns}, base_failed boolean, score double, kept boolean")


def keep_good(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are kept, with all their columns."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.verdicts(statistics(batch.column("text")))[2]))

    return docs.mapInArrow(run, docs.schema)
