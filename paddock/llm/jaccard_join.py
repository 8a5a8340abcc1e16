"""N-gram Jaccard join by a token-group matrix.

Documents are sets of distinct word shingles. Two link when their Jaccard similarity is at least
``THRESHOLD`` percent. The join returns connected components and is exact:

1. Documents with equal sets are one *class* (by a 64-bit fingerprint of the set); from here on only classes count.
2. Any two linked sets share one of their first ``n - ceil(0.75 n) + 1`` tokens under any common
   order of the tokens (prefix filter). The order used goes from rare to frequent tokens in levels,
   by counts over all documents, so that repeated passages stay out of the prefixes and a token
   of a prefix has few classes. The counts are kept as a fixed number of bits, whatever the corpus.
3. Each prefix token points its classes to the first of them (a star, not all pairs); every class is
   compared with the one it is pointed to most often, if that often enough. What links forms *groups* of similar
   documents. Tokens of frequent buckets are dealt over salts, and the salts' first classes are
   compared in turn.
4. A token all of whose classes are in one group needs no more work. For the others the token-group
   matrix decides, first over prefixes (the common tokens there bound those of the whole sets), then
   over whole sets: a class Q can link to a member of group G only if ``|Q and union(G)| >= 0.75 |Q|``
   where ``union(G)`` is the group's token union. Only groups that qualify are opened and their
   members compared.
5. Components over all links; a document's component is the smallest doc_id in it.

Sets are never shuffled whole for the candidate search, and a comparison moves texts (smaller than
sets of hashes), whose shingles are computed where they are compared.

Nulls: a null text has the empty set and links with nothing. A row whose doc_id is null keeps its
row and joins the component of its class, if a row with a doc_id has the same set.
Repeated rows are returned as often as they come. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import ship_package, written
from paddock.llm.components import connected
from paddock.llm.textnum import fingerprint, mix, signed, slices

WORDS = 5
THRESHOLD = 75           # percent
BUCKETS = 1 << 23        # hash buckets of the frequency order: a bitmap of 1 MB
FREQUENT = 0.0005        # a bucket in more than this share of the documents is frequent
LEAST_FREQUENT = 8       # and in at least so many; a prefix token in so many is moved back, too
NEEDED_BITS = 1 << 23    # bitmap of the documents whose texts are compared: 1 MB
MEMBERS = 1024           # members of an opened group that a task holds, ...
BLOCK_TOKENS = 1 << 20   # ... and about so many tokens
ASKING = 4096            # classes that ask one such block
STAR_SALTS = 64          # a frequent token's classes are dealt over so many tasks


def needed(n):
    """ceil(THRESHOLD % of n) for integers or integer arrays."""
    return (n * THRESHOLD + 99) // 100


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: doc_id, set size, class. kind 1: bucket (in class) and number of documents here (in n)."""
    counts, docs, tokens_here = np.zeros(BUCKETS, np.int32), 0, 0
    for batch in batches:
        n, cls = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for part in slices(batch.column("text")):
            for i, tokens in part.shingles(WORDS):
                n[i], cls[i] = len(tokens), fingerprint(tokens)
                tokens_here += len(tokens)
                np.add.at(counts, (tokens & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        docs += batch.num_rows
        yield pa.record_batch([batch.column("doc_id"), pa.array(n), pa.array(cls), pa.array(np.zeros(len(n), np.int32))],
                              names=["doc_id", "n", "cls", "kind"])
    # what chance puts into a bucket stays out; the order may be any, so this costs at most time
    often = np.flatnonzero(counts >= max(FREQUENT / 2 * docs, 3 + 6 * tokens_here / BUCKETS))
    for at in range(0, len(often), 100_000):
        some = often[at:at + 100_000]
        yield pa.record_batch([pa.nulls(len(some), pa.int64()), pa.array(counts[some].astype(np.int64)),
                               pa.array(some.astype(np.int64)), pa.array(np.ones(len(some), np.int32))],
                              names=["doc_id", "n", "cls", "kind"])


def _bitmap(buckets: DataFrame, size: int) -> np.ndarray:
    """Bits of the ``bucket`` numbers: at most size / 64 numbers reach the driver."""
    rows = (buckets.groupBy(F.shiftright("bucket", 6).alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bucket & 63 as int)))").alias("bits")).toPandas())
    words = np.zeros(size // 64, np.int64)
    words[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words


def _bits(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at >> 6] >> (at & 63)) & 1


def _order(levels: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """Tokens (by bucket, in the order of their hashes) from the rarest level to the most frequent."""
    return np.argsort(sum(_bits(words, at) for words in levels), kind="stable")


def _prefixes(levels, hot):
    """token, salt, class and set size (with the token's place, as size * 2 ** 32 + place) of each class's prefix;
    classes that a task meets again are left out.

    ``levels`` are bitmaps of the buckets of ever more frequent tokens; tokens of the buckets ``hot`` are salted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch.column("text")):
                out: list[tuple] = []
                for _, tokens in part.shingles(WORDS):
                    n = len(tokens)
                    if not n or (cls := fingerprint(tokens)) in seen:
                        continue
                    seen.add(cls)
                    at = (tokens & np.uint64(BUCKETS - 1)).astype(np.int64)
                    order = _order(levels.value, at)[:n - needed(n) + 1]
                    salt = _bits(hot.value, at[order]) * (1 + cls % STAR_SALTS)
                    out.append((tokens[order], salt, np.full(len(order), cls), (n << 32) + np.arange(len(order))))
                if out:
                    token, salt, cls, size = map(np.concatenate, zip(*out, strict=True))
                    yield pa.record_batch([signed(token), salt, cls, size], names=["token", "salt", "cls", "size"])
    return run


def _thresholds(counts: DataFrame) -> list[int]:
    """LEAST_FREQUENT and its multiples by powers of 4, from the first that at most BUCKETS / 8 tokens' counts reach."""
    power = F.floor(F.log(4.0, F.col("n") / LEAST_FREQUENT + 1e-9)).cast("int")
    rows = counts.groupBy(power.alias("power")).agg(F.count("*").alias("tokens")).collect()
    by_power = {r["power"]: r["tokens"] for r in rows}
    first, total = 16, 0
    while first > 0 and total + by_power.get(first - 1, 0) <= BUCKETS // 8:
        first -= 1
        total += by_power.get(first, 0)
    return [LEAST_FREQUENT * 4 ** k for k in range(first, max([*by_power, first]) + 1)]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, salt, place, class): each class with the first one of its token; that one itself only if salted."""
    run = None  # token, salt, first class, its size, last class
    for batch in batches:
        token, salt, cls, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "salt", "cls", "size"))
        if not len(token):
            continue
        first = np.empty(len(token), bool)
        first[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        first[0] = run is None or (token[0], salt[0]) != run[:2]
        start = np.maximum.accumulate(np.where(first, np.arange(len(token)), -1))
        lead, lead_size = cls[start], size[start]
        if not first[0]:
            lead, lead_size = np.where(start < 0, run[2], lead), np.where(start < 0, run[3], lead_size)
        again = np.zeros(len(token), bool)
        again[1:] = ~first[1:] & (cls[1:] == cls[:-1])
        again[0] = not first[0] and cls[0] == run[4]
        keep = ~again & ((cls != lead) | (salt > 0))  # a salted token's other classes may be under other salts
        run = (token[-1], salt[-1], lead[-1], lead_size[-1], cls[-1])
        if keep.any():
            yield pa.record_batch([x[keep] for x in (token, salt, cls, size, lead, lead_size)],
                                  names=["token", "salt", "cls", "size", "lead", "lead_size"])


def _n(size: str):
    """The set's size."""
    return F.shiftright(size, 32)


def _place(size: str):
    """The token's place among the set's tokens."""
    return F.col(size).bitwiseAND(0xFFFFFFFF)


def _left(size: str):
    """Tokens of the set from this one on."""
    return F.shiftright(size, 32) - F.col(size).bitwiseAND(0xFFFFFFFF)


def _needed(n: str):
    return F.floor((F.col(n) * THRESHOLD + 99) / 100)


def _sizes_fit(a, b):
    return (a * 100 >= b * THRESHOLD) & (b * 100 >= a * THRESHOLD)


def _maybe_needed(bitmap):
    """Rows whose doc_id is in the bitmap: all that are needed, and few others while the bitmap is sparse."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = signed(mix(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(NEEDED_BITS - 1))
            yield batch.filter(pa.array(_bits(bitmap.value, bucket) == 1))
    return run


def _buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.record_batch([signed(mix(ids.view(np.uint64)) & np.uint64(NEEDED_BITS - 1))], names=["bucket"])


def _texts(spark: SparkSession, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text), written, once for each class in ``wanted`` (cls, doc_id, k: rows that have both)."""
    bitmap = spark.sparkContext.broadcast(_bitmap(wanted.select("doc_id").mapInArrow(_buckets_of, "bucket long"), NEEDED_BITS))
    some = docs.filter("doc_id is not null").mapInArrow(_maybe_needed(bitmap), docs.schema)

    def of(which: str) -> DataFrame:
        return some.join(wanted.filter(which).select("cls", "doc_id"), "doc_id").select("cls", "text").mapInArrow(_with_class, "cls long, text string")

    once = of("k = 1")
    found = written(spark, once if wanted.filter("k > 1").isEmpty() else once.unionByName(of("k > 1").dropDuplicates(["cls"])), "jaccard-texts")
    bitmap.unpersist()
    return found


def _with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of text that really have the set they were fetched for."""
    for batch in batches:
        wanted, keep = batch.column("cls").to_numpy(zero_copy_only=False), np.zeros(batch.num_rows, bool)
        for part in slices(batch.column("text")):
            for i, tokens in part.shingles(WORDS):
                keep[i] = fingerprint(tokens) == wanted[i]
        yield batch.filter(pa.array(keep))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes whose texts have the similarity asked for."""
    kept: dict[int, np.ndarray] = {}
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
        keep = np.zeros(batch.num_rows, bool)
        left = (tokens for part in slices(batch.column("text_a")) for _, tokens in part.shingles(WORDS))
        texts = batch.column("text_b")
        for i, x in enumerate(left):
            if (y := kept.get(b[i])) is None:
                (_, y), = (s for part in slices(texts.slice(i, 1)) for s in part.shingles(WORDS))
                if len(kept) >= 64:
                    kept.clear()
                kept[b[i]] = y
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * common >= THRESHOLD * (len(x) + len(y) - common)
        yield pa.record_batch([a[keep], b[keep]], names=["a", "b"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, token) rows of the texts; ``also`` is carried along."""
    for batch in batches:
        grp, also = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "also"))
        for part in slices(batch.column("text")):
            out = [(np.full(len(t), grp[i]), np.full(len(t), also[i]), signed(t)) for i, t in part.shingles(WORDS)]
            g, k, t = map(np.concatenate, zip(*out, strict=True))
            yield pa.record_batch([g, k, t], names=["grp", "also", "token"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_compare, "a long, b long")


def _label(df: DataFrame, groups: DataFrame, cls: str, as_: str) -> DataFrame:
    """The group of a class; a class without any link is its own group."""
    g = groups.select(F.col("node").alias(cls), F.col("label").alias("_g"))
    return df.join(g, cls, "left").withColumn(as_, F.coalesce("_g", cls)).drop("_g")


def _open_groups(spark: SparkSession, posts: DataFrame, groups: DataFrame, known: DataFrame, sizes: DataFrame, fetch) -> DataFrame:
    """Links between classes of different groups, from the groups that the token-group matrix doesn't exclude.

    ``known`` has pairs compared before; ``sizes`` (cls, n) the classes' set sizes; ``fetch`` gives the texts of classes.
    """
    first = posts.select("token", F.col("lead").alias("cls"), F.col("lead_size").alias("size")).distinct()
    many_of = groups.groupBy(F.col("label").alias("grp")).agg(F.count("*").alias("many"))
    members = _label(posts.select("token", "cls", "size").union(first).distinct(), groups, "cls", "grp").join(many_of, "grp", "left")
    members = members.withColumn("many", F.coalesce("many", F.lit(1)))
    split = (members.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
             .filter("lo <> hi").select("token"))
    members = written(spark, members.join(split, "token"), "jaccard-members")
    matrix_prefix = members.groupBy("token", "grp", "many").agg(
        F.min(_n("size")).alias("n_min"), F.max(_n("size")).alias("n_max"), F.max(_left("size")).alias("left_max"))
    # of two groups the smaller one's classes ask
    q = members.select("token", "cls", F.col("grp").alias("own"), F.col("many").alias("own_many"), _n("size").alias("n"), _left("size").alias("left"))
    smaller = (F.col("own_many") < F.col("many")) | ((F.col("own_many") == F.col("many")) & (F.col("own") < F.col("grp")))
    # lengths, and what is left of either set from its first common token on, bound the similarity
    low, high = F.greatest("n_min", F.col("n") * THRESHOLD / 100), F.least("n_max", F.col("n") * 100 / THRESHOLD)
    least = (F.col("n") + low) * THRESHOLD
    met = q.join(matrix_prefix, "token").filter(
        smaller & (F.col("n_min") * THRESHOLD <= F.col("n") * 100) & (F.col("n_max") * 100 >= F.col("n") * THRESHOLD)
        & (F.least("left", "left_max") * (100 + THRESHOLD) >= least)).select("cls", "grp").distinct()
    # common tokens of the prefixes; beyond the shorter prefix there are at most what it leaves of its set
    met = (written(spark, met, "jaccard-met").join(q.select("cls", "token", "n"), "cls")
           .join(matrix_prefix.drop("left_max", "many"), ["token", "grp"]).groupBy("cls", "n", "grp")
           .agg(F.count("*").alias("common"), F.min("n_min").alias("n_min"), F.max("n_max").alias("n_max")))
    at_most = F.col("common") + F.greatest(_needed("n"), F.ceil(high * THRESHOLD / 100)) - 1
    reach = written(spark, met.filter(at_most * (100 + THRESHOLD) >= least).select("cls", "n", "grp"), "jaccard-reach")
    # a group of one class: its union is the class, the comparison is the bound
    reach = reach.join(many_of, "grp", "left")
    single = reach.filter("many is null").select(F.col("cls").alias("a"), F.col("grp").alias("b"))
    many = reach.filter("many is not null").select("cls", "n", "grp")
    # the matrix: token unions of the groups reached
    reached = many.select("grp").distinct()
    inside = written(spark, groups.select(F.col("node").alias("cls"), F.col("label").alias("grp")).join(reached, "grp"), "jaccard-inside")
    back = known.select(F.col("a").alias("b"), F.col("b").alias("a"))
    single = written(spark, single.join(known, ["a", "b"], "left_anti").join(back, ["a", "b"], "left_anti"), "jaccard-single")
    texts = fetch(single.select(F.col("a").alias("cls")).union(single.select("b")).union(many.select("cls")).union(inside.select("cls")).distinct())
    matrix = (texts.join(inside, "cls").select("grp", F.lit(0).cast("long").alias("also"), "text")
              .mapInArrow(_tokens, "grp long, also long, token long").select("grp", "token").distinct())
    asked = (texts.join(many, "cls").select(F.col("grp"), F.col("cls").alias("also"), "text")
             .mapInArrow(_tokens, "grp long, also long, token long"))
    bound = asked.join(matrix, ["grp", "token"]).groupBy("also", "grp").agg(F.count("*").alias("common"))
    opened = (bound.withColumnRenamed("also", "cls").join(many, ["cls", "grp"])
              .filter(F.col("common") * 100 >= F.col("n") * THRESHOLD).select("cls", "grp"))
    return _links(single, texts).unionByName(_opened(spark, opened, inside, texts, sizes))


def _opened(spark: SparkSession, opened: DataFrame, inside: DataFrame, texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """A link from each asking class (cls, grp) to every block of the group's members that has one.

    Members of a group are linked already, so one link says all. They are dealt over blocks of bounded size, and many
    asking classes over salts; a block's members meet all that ask as an index of tokens, without a row for each pair.
    """
    asking = opened.groupBy("grp").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("salts"))
    blocks = (inside.join(sizes, "cls").groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks")))
    plan = written(spark, asking.join(blocks, "grp"), "jaccard-blocks")
    spread = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    members = inside.join(plan, "grp").select("grp", F.pmod(F.xxhash64("cls"), "blocks").cast("int").alias("block"), spread, "cls", F.lit(0).alias("asks"))
    queries = opened.join(plan, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                              F.pmod(F.xxhash64("cls"), "salts").cast("int").alias("salt"), "cls", F.lit(1).alias("asks"))
    met = members.unionByName(queries).join(texts, "cls").repartition("grp", "block", "salt").sortWithinPartitions("grp", "block", "salt", "asks")
    return met.select("grp", "block", "salt", "asks", "cls", "text").mapInArrow(_against, "a long, b long")


def _against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a block, then the classes that ask: each with the first member it links to, if any."""
    at, members, index = None, [], None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "salt")), strict=True))
        asks, cls, found = batch.column("asks").to_pylist(), batch.column("cls").to_pylist(), []
        for i, tokens in (s for part in slices(batch.column("text")) for s in part.shingles(WORDS)):
            if keys[i] != at:
                at, members, index = keys[i], [], None
            if not asks[i]:
                members.append((cls[i], tokens))
                continue
            if index is None:
                index = _index(members)
            member, sizes, every, starts, owner = index
            place = np.searchsorted(every, tokens)
            place = place[(place < len(every)) & (every[np.minimum(place, len(every) - 1)] == tokens)] if len(every) else place[:0]
            if not len(place):
                continue
            a, many = starts[place], starts[place + 1] - starts[place]
            rows = owner[np.repeat(a - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            common = np.bincount(rows, minlength=len(member))
            linked = np.flatnonzero(100 * common >= THRESHOLD * (sizes + len(tokens) - common))
            if len(linked):
                found.append((cls[i], int(member[linked[0]])))
        if found:
            a, b = zip(*found, strict=True)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _index(members: list) -> tuple:
    """Classes and their sizes; distinct tokens, where each one's members start, and the members (by number)."""
    sizes = np.array([len(t) for _, t in members], np.int64)
    tokens = np.concatenate([t for _, t in members]) if members else np.zeros(0, np.uint64)
    order = np.argsort(tokens, kind="stable")
    every, starts = np.unique(tokens[order], return_index=True)
    return np.array([c for c, _ in members], np.int64), sizes, every, np.append(starts, len(tokens)), np.repeat(np.arange(len(members)), sizes)[order]


def _best_star(stars: DataFrame) -> DataFrame:
    return (stars.filter("cls <> lead").filter(_sizes_fit(F.col("n"), F.col("lead_n")))
            .groupBy("cls", "lead", "n").agg(F.count("*").alias("k")).filter(F.col("k") * 3 > F.col("n") - _needed("n"))
            .groupBy(F.col("cls").alias("a")).agg(F.max_by("lead", F.struct("k", "lead")).alias("b")))


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``; also cls and label, which rows with
    equal sets and rows of one component have in common."""
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    digest = written(spark, docs.mapInArrow(_digest, "doc_id long, n long, cls long, kind int"), "jaccard-digest", by="kind")
    rows = digest.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "cls")
    # the order of the tokens: first what many documents have by counts of all tokens' buckets, ...
    many = (digest.filter("kind = 1").groupBy(F.col("cls").alias("bucket")).agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= max(LEAST_FREQUENT, FREQUENT * rows.count())))
    words = _bitmap(many, BUCKETS)
    hot = spark.sparkContext.broadcast(words)
    schema = "token long, salt long, cls long, size long"
    # ... then what several have, by counts of the prefixes' tokens under that order
    one = spark.sparkContext.broadcast([words])
    counts = written(spark, docs.mapInArrow(_prefixes(one, hot), schema).groupBy("token").agg(F.count("*").alias("n"))
                     .filter(F.col("n") >= LEAST_FREQUENT), "jaccard-counts")
    bucket = F.col("token").bitwiseAND(BUCKETS - 1).alias("bucket")
    levels = [_bitmap(counts.filter(F.col("n") >= least).select(bucket), BUCKETS) for least in _thresholds(counts)]
    levels = spark.sparkContext.broadcast([words | (levels[0] if levels else 0), *levels[1:], words])
    posts = written(spark, docs.mapInArrow(_prefixes(levels, hot), schema).repartition("token", "salt").sortWithinPartitions("token", "salt", _place("size"), "cls").mapInArrow(
        _stars, schema + ", lead long, lead_size long"), "jaccard-posts")
    for b in (hot, one, levels):
        b.unpersist()
    # each class with the first class that it shares the most tokens with, if these are a third of its prefix
    stars = posts.select("token", "salt", "cls", _n("size").alias("n"), "lead", _n("lead_size").alias("lead_n"), _place("lead_size").alias("lead_place"))
    salted = stars.filter("salt > 0").select("token", F.col("lead").alias("cls"), F.col("lead_n").alias("n"), "lead_place").distinct()
    first = F.struct("lead_place", "cls")
    across = salted.join(salted.groupBy("token").agg(F.min_by("cls", first).alias("lead"), F.min_by("n", first).alias("lead_n")), "token")
    pairs = written(spark, _best_star(stars).unionByName(_best_star(across)).distinct(), "jaccard-pairs")
    classes = (rows.filter("n_shingles > 0").groupBy("cls", "doc_id").agg(F.count("*").alias("k"), F.max("n_shingles").alias("n"))
               .groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min_by("k", "doc_id").alias("k"), F.max("n").alias("n")))
    classes = written(spark, classes, "jaccard-classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        needed_rows = written(spark, classes.drop("n").join(wanted, "cls").filter("doc_id is not null"), "jaccard-wanted")
        return _texts(spark, docs, needed_rows)

    links = written(spark, _links(pairs, fetch(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct())), "jaccard-links")
    groups = connected(spark, links)
    more = written(spark, _open_groups(spark, posts, groups, pairs, classes.select("cls", "n"), fetch), "jaccard-more")
    whole = groups if more.isEmpty() else connected(spark, links.unionByName(more))
    labelled = _label(classes, whole, "cls", "label")
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_class = labelled.select("cls", "label").join(smallest, "label").select("cls", "label", "component_id")
    out = rows.filter("n_shingles > 0").join(by_class, "cls", "left")
    empty = rows.filter("n_shingles = 0").select("*", F.lit(None).cast("long").alias("label"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty).select("doc_id", "n_shingles", "component_id", "cls", "label")


def keep_one_per_component(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component: the one whose doc_id names it, once, with all its columns.

    Empty texts are components of their own and stay, as do rows whose doc_id is null.
    """
    found = written(spark, jaccard_components(spark, docs), "jaccard-found")
    kept = (found.filter("doc_id = component_id").groupBy("doc_id", "label").agg(F.min("cls").alias("cls"))
            .join(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("k")), "doc_id"))
    once = docs.join(kept.filter("k = 1").select("doc_id"), "doc_id", "left_semi")
    # a doc_id of several rows: the row with the right set, once
    columns = docs.columns
    again = (docs.select("doc_id", "text", F.struct(*columns).alias("_row")).join(kept.filter("k > 1").select("doc_id", "cls"), "doc_id"))
    again = again.mapInArrow(_with_class, again.schema).dropDuplicates(["doc_id", "cls"]).select("_row.*")
    return once.select(*columns).unionByName(again).unionByName(docs.filter("doc_id is null"))
