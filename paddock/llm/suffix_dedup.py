"""Suffix-array dedup: repeated strings of a collection, by column-wise construction of its sorted suffixes.

A byte is removed if a string of ``LENGTH`` bytes covers it that also starts earlier: in a smaller doc_id,
or in the same document at a smaller place. Strings never cross documents and are judged on the input.

Equal strings meet like this. Every string has a *minimizer*, its ``GRAM``-byte gram of the smallest hash (the leftmost
of equals); consecutive strings with the same one make a *piece*, and equal strings have equal minimizers
at equal places. Only pieces whose minimizer is found twice or more count (bitmaps of fixed size; a false bit costs
time, nothing else). Equal pieces are a *class* (by a 64-bit hash within their minimizer), whose earliest piece stands for all; the
others are removed whole. Within a slice of documents that is settled before anything is shuffled, and no bytes
are moved for it. Where a minimizer has several classes, the bytes of their earliest pieces meet.

These pieces, aligned at their minimizers, are the documents of the construction: each round inserts one symbol
per piece, the column to the left, and updates the order of all suffixes that start there. The symbols
before the sorted suffixes are the Burrows-Wheeler transform of that column; its stable sort is
the next order, and a common prefix is one longer than the least of those it spans, or 0 where symbols
differ. Neighbours with a common prefix of ``LENGTH`` start equal strings; all but the earliest are repeats. Suffixes of different
columns can't be equal for so long, so columns needn't be merged. The sequential files of the method are the
shuffle's: pieces come sorted by minimizer and are worked through in slices of bounded size.

A minimizer with more than ``HOT`` pieces is dealt over salts; the strings that are first within a salt
then meet by their own hash, as pieces of one string each, for a second construction, so no
group of the data ends up in one task, however many documents share it.

A null text is empty. Rows with one doc_id count as one document: the smaller place is earlier, and rows that agree
in doc_id and place don't remove each other (nor do repeated rows). A null doc_id is later than all others. Texts
of any length are worked through in chunks. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import ship_package, written
from paddock.llm.textnum import mix, signed

LENGTH = 100               # bytes of a repeated string
GRAM = 32                  # bytes of a minimizer, a power of two
SLICE = 1 << 18            # bytes of texts worked on at a time
BITS = 26                  # bits of a bucket number of minimizers: bitmaps of 8 MB
CHUNK_BITS = 19            # bits of a bitmap in one row
HOT = 200_000              # pieces of a minimizer that one task takes
PIECES = 20_000            # pieces of a construction, but for larger groups
FILL = 4096                # pieces whose bytes are put in columns at a time
PART_BYTES = 1 << 24       # bytes of pieces of a task, about
LAST_ID = (1 << 63) - 1

_U = np.uint64
_MASK = _U((1 << 20) - 1)  # places within a slice
_BYTE = mix(np.arange(1, 257, dtype=_U))
_OTHER = mix(np.arange(1001, 1257, dtype=_U))
_STEPS = [_U(int(x) | 1) for x in mix(np.arange(5001, 5017, dtype=_U))]
_BASE = int(_STEPS[-1])
_POWER: list[np.ndarray] = []


def _slices(texts: pa.Array) -> Iterator[tuple]:
    """Bytes of consecutive documents, with number of the row, start, end and place in its text of each document or chunk of one."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        start, size = offsets[at], int(offsets[at + 1] - offsets[at])
        if size > SLICE:
            for base in range(0, size - LENGTH + 1, SLICE):
                part = data[start + base:start + min(size, base + SLICE + LENGTH - 1)]
                yield part, np.array([at]), np.array([0]), np.array([len(part)]), np.array([base])
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(offsets, start + SLICE, "right")) - 1)
        rows = np.arange(at, min(to, len(texts)))
        yield data[start:offsets[rows[-1] + 1]], rows, offsets[rows] - start, offsets[rows + 1] - start, np.zeros(len(rows), np.int64)
        at = int(rows[-1]) + 1


def _minimizers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Pieces of a slice: first string, number of strings, place and hash of the minimizer."""
    size = len(data) - LENGTH + 1
    long_enough = ends - starts >= LENGTH
    if size < 1 or not long_enough.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[long_enough]] += 1
    edges[ends[long_enough] - LENGTH + 1] -= 1
    inside = np.cumsum(edges[:size]) > 0
    with np.errstate(over="ignore"):
        grams, width = _BYTE[data], 1
        for step in _STEPS:
            if width == GRAM:
                break
            grams = grams[:-width] * step + grams[width:]
            width *= 2
        grams = grams ^ (grams >> _U(29))
        grams *= _STEPS[7]
        grams ^= grams >> _U(32)
    least, width, span = (grams & ~_MASK) | np.arange(len(grams), dtype=_U), 1, LENGTH - GRAM + 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:size], least[span - width:span - width + size])
    place = (least & _MASK).astype(np.int64)
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    return first, np.add.reduceat(inside.astype(np.int64), first), place[first], grams[place[first]]


def _powers(n: int) -> list[np.ndarray]:
    if not _POWER or len(_POWER[0]) < n:
        size = max(n, SLICE + LENGTH)
        with np.errstate(over="ignore"):
            _POWER[:] = [np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, p, _U)])) for p in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWER


def _content(data: np.ndarray, first: np.ndarray, last: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hashes of the strings from ``first`` to ``last``."""
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, _U)
        np.cumsum(table[data] * power[:len(data)], out=total[1:])
        return mix((total[last] - total[first]) * inverse[first])


class Pieces:
    """The pieces of a slice, and which of them repeat an earlier one of the slice."""

    def __init__(self, data, rows, starts, ends, bases, ids):
        self.data = data
        self.first, self.n, place, self.key = _minimizers(data, starts, ends)
        segment = np.searchsorted(starts, self.first, "right") - 1   # an empty document starts where the next one does
        self.row = rows[segment]
        self.start = bases[segment] + self.first - starts[segment]   # in the document
        self.offset = place - self.first
        self.id = ids[self.row]
        self.repeats, self.content = np.zeros(len(self.first), bool), np.zeros(0, _U)
        if len(self.first):
            self._settle()

    def _settle(self) -> None:
        last = self.first + self.n + (LENGTH - 1)
        with np.errstate(over="ignore"):
            key = _content(self.data, self.first, last, _BYTE) + mix(self.key + (self.n * 256 + self.offset).astype(_U))
        self.content = key
        order = np.lexsort((self.start, self.id))
        found, at, which = np.unique(key[order], return_index=True, return_inverse=True)
        if len(found) == len(order):
            return
        earliest = np.empty(len(order), np.int64)
        earliest[order] = order[at][which]
        again = _content(self.data, self.first, last, _OTHER)
        later = (self.id > self.id[earliest]) | ((self.id == self.id[earliest]) & (self.start > self.start[earliest]))
        self.repeats = later & (again == again[earliest])

    def texts(self, some: np.ndarray) -> pa.Array:
        """The bytes of some pieces."""
        sizes = self.n[some] + (LENGTH - 1)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.first[some] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return _binary(offsets, self.data[at])


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _of(batch: pa.RecordBatch) -> Iterator[Pieces]:
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    for data, rows, starts, ends, bases in _slices(batch.column("text")):
        yield Pieces(data, rows, starts, ends, bases, ids)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimizers, with the number of pieces that a slice has to ship for each."""
    for batch in batches:
        for p in _of(batch):
            key, n = np.unique(p.key[~p.repeats], return_counts=True)
            yield pa.record_batch([signed(key), n.astype(np.int64)], names=["key", "n"])


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        for chunk in np.unique(bucket >> CHUNK_BITS).tolist():
            mine = bucket[bucket >> CHUNK_BITS == chunk] & ((1 << CHUNK_BITS) - 1)
            held.setdefault(chunk, np.zeros(1 << CHUNK_BITS, bool))[mine] = True
    for chunk, bits in held.items():
        yield pa.record_batch([pa.array([chunk], pa.int64()), pa.array([np.packbits(bits).tobytes()])], names=["chunk", "bits"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The buckets of the hashes ``key`` as bits; its size never depends on the data. A bucket is the hash's last bits: the first
    ones of minimizers are nearly all small."""
    bucket = keys.select(F.col("key").bitwiseAND((1 << BITS) - 1).alias("bucket"))
    rows = bucket.repartition(F.shiftright("bucket", CHUNK_BITS)).mapInArrow(_set_bits, "chunk long, bits binary").collect()
    bits = np.zeros(1 << BITS - 3, np.uint8)
    for r in rows:
        at = r["chunk"] << CHUNK_BITS - 3
        bits[at:at + (1 << CHUNK_BITS - 3)] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _bit(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    bucket = (key & _U((1 << BITS) - 1)).astype(np.int64)
    return (bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1


def _place(ids: np.ndarray, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of a piece's place in the collection."""
    with np.errstate(over="ignore"):
        return mix(mix(ids.view(_U) + _STEPS[5]) ^ h.view(_U) ^ (at.view(_U) * _STEPS[6]))


def _salts(hot: np.ndarray, key: np.ndarray, h: np.ndarray, salts: int) -> np.ndarray:
    return np.where(_bit(hot, key), 1 + (mix(h.view(_U)) % _U(salts)).astype(np.int64), 0)


#: A piece without its bytes: key and content name its class, at is the place of its minimizer in the document, offset that in the piece.
#: Rows with start and stop are removed spans.
_FOUND = "key long, content long, salt long, id long, h long, at long, start long, stop long"
_FOUND_NAMES = ["key", "content", "salt", "id", "h", "at", "start", "stop"]


def _found(key, content, salt, ids, h, at, start, stop) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) if x is not None else pa.nulls(len(ids), pa.int64()) for x in (key, content, salt, ids, h, at, start, stop)],
                           names=_FOUND_NAMES)


def _places(repeated, hot, salts: int):
    """Pieces that may have a partner elsewhere, and the spans settled within a slice. Until they are settled, start and
    stop are the piece's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            for p in _of(batch):
                some = np.flatnonzero(~p.repeats & _bit(repeated.value, p.key))
                if len(some):
                    mine, start = h[p.row[some]], p.start[some]
                    yield _found(signed(p.key[some]), signed(p.content[some]), _salts(hot.value, p.key[some], mine, salts), p.id[some], mine,
                                 start + p.offset[some], start, start + p.n[some] + (LENGTH - 1))
                gone = np.flatnonzero(p.repeats)
                if len(gone):
                    # neighbours of a document join
                    row, start, stop = p.row[gone], p.start[gone], p.start[gone] + p.n[gone] + (LENGTH - 1)
                    new = np.ones(len(gone), bool)
                    new[1:] = (row[1:] != row[:-1]) | (start[1:] > stop[:-1])
                    lead = np.flatnonzero(new)
                    stop = stop[np.append(lead[1:], len(gone)) - 1]
                    mine = h[row[lead]]
                    yield _found(signed(mix(mine.view(_U))), None, np.zeros(len(lead), np.int64), p.id[gone][lead], mine, None, start[lead], stop)
    return run


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by class and place: all but a class's first pieces become removed spans (without a place)."""
    before = None   # key, content, salt, id and at of the class's first piece
    for batch in batches:
        if not batch.num_rows:
            continue
        settled = batch.column("at").is_null().to_numpy(zero_copy_only=False)
        if settled.any():
            yield batch.filter(pa.array(settled))
            batch = batch.filter(pa.array(~settled))
            if not batch.num_rows:
                continue
        key, content, salt, ids, at = (batch.column(c).to_numpy() for c in ("key", "content", "salt", "id", "at"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1]) | (salt[1:] != salt[:-1])
        new[0] = before is None or (key[0], content[0], salt[0]) != before[:3]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        first_id, first_at = np.where(lead < 0, before[3] if before else 0, ids[lead]), np.where(lead < 0, before[4] if before else 0, at[lead])
        before = key[-1], content[-1], salt[-1], first_id[-1], first_at[-1]
        later = pa.array((ids != first_id) | (at != first_at))
        place = pc.if_else(later, pa.scalar(None, pa.int64()), batch.column("at"))
        yield batch.set_column(batch.schema.get_field_index("at"), "at", place)


#: key, salt: the group. at: place of the minimizer in the document; offset: in the piece. Rows without a piece are removed spans.
_SCHEMA = "key long, salt long, id long, h long, at long, offset int, piece binary, start long, stop long"


def _batch(key, salt, ids, h, at=None, offset=None, piece=None, start=None, stop=None) -> pa.RecordBatch:
    n = len(ids)
    return pa.record_batch([pa.array(key, pa.int64()), pa.array(salt, pa.int64()), pa.array(ids, pa.int64()), pa.array(h, pa.int64()),
                            pa.nulls(n, pa.int64()) if at is None else pa.array(at, pa.int64()), pa.nulls(n, pa.int32()) if offset is None else pa.array(offset.astype(np.int32)),
                            pa.nulls(n, pa.binary()) if piece is None else piece, pa.nulls(n, pa.int64()) if start is None else pa.array(start, pa.int64()),
                            pa.nulls(n, pa.int64()) if stop is None else pa.array(stop, pa.int64())],
                           names=["key", "salt", "id", "h", "at", "offset", "piece", "start", "stop"])


def _shipped(mixed, firsts, hot, salts: int):
    """The bytes of the classes' first pieces, for minimizers that have several classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            for p in _of(batch):
                some = np.flatnonzero(~p.repeats & _bit(mixed.value, p.key))
                some = some[_bit(firsts.value, _place(p.id[some], h[p.row[some]], p.start[some] + p.offset[some]))]
                if len(some):
                    mine = h[p.row[some]]
                    yield _batch(signed(p.key[some]), _salts(hot.value, p.key[some], mine, salts), p.id[some], mine,
                                 p.start[some] + p.offset[some], p.offset[some], p.texts(some))
    return run


def _place_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([signed(_place(*(batch.column(c).to_numpy() for c in ("id", "h", "at"))))], names=["key"])


def rounds(columns: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each column from the last to the first: it, the order of the rows by their symbols from there on, and the common prefix
    of each with the one before. ``columns`` has a row of symbols per column; ties keep the order of the rows."""
    count, n = columns.shape
    order, prefix = np.arange(n), np.zeros(n, np.uint8)
    for c in range(count - 1, -1, -1):
        transform = columns[c][order]                    # symbols before the sorted suffixes
        moved = np.argsort(transform, kind="stable")
        symbol = transform[moved]
        same = np.flatnonzero(symbol[1:] == symbol[:-1])
        low, high = moved[same] + 1, moved[same + 1]
        span = high - low + 1
        power = np.frexp(span)[1] - 1
        least = [prefix]                                 # least common prefixes of 1, 2, 4, ... neighbours
        for j in range(int(power.max()) if len(power) else 0):
            least.append(np.minimum(least[-1], np.append(least[-1][1 << j:], np.zeros(min(1 << j, n), np.uint8))))
        table = np.concatenate(least)
        new = np.zeros(n, np.uint8)
        new[same + 1] = 1 + np.minimum(table[power * n + low], table[power * n + high - (1 << power) + 1])
        order, prefix = order[moved], new
        yield c, order, prefix


def _constructed(key, salt, ids, h, at, offset, pieces: pa.Array, again: bool) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated strings in whole groups of pieces. ``again``: the first strings of salted groups, as pieces, come along."""
    order = np.lexsort((at, ids))
    key, salt, ids, h, at, offset = (x[order] for x in (key, salt, ids, h, at, offset))
    _, ends, data = pieces.buffers()
    ends = np.frombuffer(ends, np.int32)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
    starts, sizes = ends[:-1][order], np.diff(ends)[order]
    data = np.frombuffer(data, np.uint8)
    n, lead = len(ids), LENGTH - GRAM
    columns = np.zeros((lead + LENGTH, n), np.uint8)
    for a in range(0, n, FILL):
        some = sizes[a:a + FILL]
        run = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        columns[np.repeat(lead - offset[a:a + FILL], some) + run, np.repeat(np.arange(a, a + len(some)), some)] = data[np.repeat(starts[a:a + FILL], some) + run]
    left, right = lead - offset, lead - offset + sizes
    rank = np.cumsum(np.append(0, (ids[1:] != ids[:-1]) | (at[1:] != at[:-1])))
    gone = np.zeros((n, lead + 2), bool)                 # a last column of False ends every run
    for c, by_suffix, prefix in rounds(columns):
        if c > lead:
            continue
        # of other minimizers' pieces, or in another salt, an equal string is settled elsewhere
        mine = (left[by_suffix] <= c) & (c + LENGTH <= right[by_suffix])
        some = by_suffix[mine]
        if not len(some):
            continue
        group = np.cumsum(prefix < LENGTH)[mine]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        earliest = np.repeat(np.minimum.reduceat(rank[some], first), np.diff(np.append(first, len(some))))
        gone[some[rank[some] > earliest], c] = True
    edges = np.diff(np.hstack([np.zeros((n, 1), np.int8), gone.astype(np.int8)]), axis=1)
    row, begin = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    if len(row):
        start, stop = at[row] + begin - lead, at[row] + end - 1 - lead + LENGTH
        yield _batch(signed(mix(h[row].view(_U))), np.zeros(len(row), np.int64), ids[row], h[row], start=start, stop=stop)
    if again and (salt > 0).any():
        for c in range(lead + 1):
            some = np.flatnonzero((salt > 0) & (left <= c) & (c + LENGTH <= right) & ~gone[:, c])
            for part in np.array_split(some, len(some) // PIECES + 1):
                if not len(part):
                    continue
                text = np.ascontiguousarray(columns[c:c + LENGTH, part].T)
                with np.errstate(over="ignore"):
                    own = np.zeros(len(part), _U)
                    for j in range(LENGTH):
                        own = own * _STEPS[3] + _BYTE[text[:, j]]
                yield _batch(signed(mix(own)), np.zeros(len(part), np.int64), ids[part], h[part], at[part] + (c - lead), np.zeros(len(part)),
                             _binary(np.arange(len(part) + 1) * LENGTH, text.reshape(-1)))


def _construct(again: bool):
    """Rows come sorted by group; whole groups are gathered up to a number of pieces."""
    names = ["key", "salt", "id", "h", "at", "offset"]

    def work(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        if rows.num_rows > 1:
            yield from _constructed(*(rows.column(c).to_numpy() for c in names), rows.column("piece").combine_chunks(), again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            is_piece = pc.is_valid(batch.column("piece"))
            spans = batch.filter(pc.invert(is_piece))
            if spans.num_rows:
                yield spans
            batch = batch.filter(is_piece)
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < PIECES:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key, salt = rows.column("key").to_numpy(), rows.column("salt").to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))
            if not len(cuts):
                continue
            at = int(cuts[-1]) + 1
            yield from work(rows.slice(0, at).to_batches())
            held, size = rows.slice(at).to_batches(), rows.num_rows - at
        if held:
            yield from work(held)
    return run


def repeats(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """id, h, start, stop: spans of bytes to remove from the texts of ``rows`` (id, h, text); they may overlap."""
    ship_package(spark)
    rows, context = rows.select("id", "h", "text"), spark.sparkContext
    counts = rows.select("id", "text").mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = written(spark, counts, "repeats-counts")
    most = counts.agg(F.max("n").alias("most")).first()["most"] or 0
    none = np.zeros(1 << BITS - 3, np.uint8)
    repeated = context.broadcast(_bitmap(counts.select("key")))
    hot = context.broadcast(_bitmap(counts.filter(F.col("n") > HOT).select("key")) if most > HOT else none)
    # as many salts as first pieces of a class may meet again: both stay near the root of the group's size
    salts = max(2, 2 * most // HOT + 1)
    # classes, the earliest piece of each, and spans of the others
    found = rows.mapInArrow(_places(repeated, hot, salts), _FOUND)
    if most > HOT:
        found = found.repartition("key", "content", "salt").sortWithinPartitions("key", "content", "salt", "id", "at").mapInArrow(_earliest, _FOUND)
        found = found.withColumn("salt", F.lit(0).cast("long"))
    found = found.repartition("key", "content").sortWithinPartitions("key", "content", "salt", "id", "at").mapInArrow(_earliest, _FOUND)
    found = written(spark, found.select("key", "content", "id", "h", "at", "start", "stop", F.col("at").isNull().cast("int").alias("gone")), "repeats-found", by="gone")
    spans, classes = found.filter("gone = 1").select("id", "h", "start", "stop"), found.filter("gone = 0")
    # minimizers of several classes
    several = written(spark, classes.groupBy("key").agg(F.min("content").alias("lo"), F.max("content").alias("hi"), F.count("*").alias("n"))
                      .filter("lo <> hi").select("key", "n"), "repeats-several")
    total = several.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if total["n"]:
        mixed = context.broadcast(_bitmap(several.select("key")))
        is_hot = total["most"] > HOT
        crowded = context.broadcast(_bitmap(several.filter(F.col("n") > HOT).select("key")) if is_hot else none)
        firsts = context.broadcast(_bitmap(classes.join(several, "key", "left_semi").select("id", "h", "at").mapInArrow(_place_of, "key long")))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total["n"] * (LENGTH * 3 // 2) // PART_BYTES))
        pieces = rows.mapInArrow(_shipped(mixed, firsts, crowded, max(2, 2 * total["most"] // HOT + 1)), _SCHEMA)
        pieces = pieces.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt").mapInArrow(_construct(is_hot), _SCHEMA)
        if is_hot:
            pieces = pieces.repartition(parts, "key").sortWithinPartitions("key", "salt").mapInArrow(_construct(False), _SCHEMA)
        spans = spans.unionByName(written(spark, pieces.select("id", "h", "start", "stop"), "repeats-spans"))
        for b in (mixed, crowded, firsts):
            b.unpersist()
    for b in (repeated, hot):
        b.unpersist()
    return spans


_CUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their spans."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        spans = pc.fill_null(batch.column("spans"), pa.scalar([], batch.column("spans").type))
        number = pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = spans.flatten()
        start, stop = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
        upto = np.append(0, np.cumsum(number))
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "").cast(pa.large_binary())
        ids, out, size = batch.column("doc_id").to_pylist(), [], 0
        for i, text in enumerate(texts):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            a, b = start[upto[i]:upto[i + 1]], stop[upto[i]:upto[i + 1]]
            if len(a):
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.append(True, a[1:] > b[:-1])
                a, b = a[new], b[np.append(np.flatnonzero(new)[1:], len(b)) - 1]
                keep = np.ones(len(data), bool)
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    keep[x:y] = False
                kept = data[keep].tobytes()
            else:
                kept = data.tobytes()
            out.append((ids[i], len(data), int((b - a).sum()), [{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)], kept))
            size += len(kept)
            if size > 1 << 24 or i == batch.num_rows - 1:
                d, n, r, s, k = zip(*out, strict=True)
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, span), pa.array(k, pa.binary())],
                                      names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
                out, size = [], 0


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs: start, stop) and kept (remaining bytes) for each row of ``docs``."""
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")
    spans = repeats(spark, rows).groupBy("id", "h").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows.join(spans, ["id", "h"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, _CUT)


def oracle() -> str:
    """Every string of every document by its digest; the earliest of each digest stays."""
    return f"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x, octet_length(encode(coalesce(text, ''))) as n from documents),
c as (select doc_id, base, substr(x, 2 * base + 1, {2 * (400 + LENGTH - 1)}) as x from (select doc_id, x, unnest(range(0, n - {LENGTH - 1}, 400)) as base from d)),
w as (select doc_id, base + p as p, md5_number(substr(x, 2 * p + 1, {2 * LENGTH})) as m
      from (select doc_id, base, x, unnest(range(len(x) // 2 - {LENGTH - 1})) as p from c)),
r as (select doc_id, p from w qualify row_number() over (partition by m order by doc_id, p) > 1),
e as (select doc_id, p, case when p > lag(p) over (partition by doc_id order by p) + {LENGTH} then 1 else 0 end as jump from r),
i as (select doc_id, p, sum(jump) over (partition by doc_id order by p) as run from e),
s as (select doc_id, min(p) as start, max(p) + {LENGTH} as stop from i group by doc_id, run),
k as (select d.doc_id, x, n, start, stop, coalesce(lag(stop) over (partition by d.doc_id order by start), 0) as before
      from d left join s on d.doc_id = s.doc_id)
select doc_id, cast(any_value(n) as bigint) as n_bytes, cast(coalesce(sum(stop - start), 0) as bigint) as n_removed, count(start) as n_spans,
       sha256(unhex(coalesce(string_agg(substr(x, 2 * before + 1, 2 * (start - before)), '' order by start), '')
                    || substr(any_value(x), 2 * coalesce(max(stop), 0) + 1))) as kept_sha256
from k group by doc_id"""
