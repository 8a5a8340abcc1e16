"""License scan by diagonal voting. DataFrame operations only.

Words are lower-cased runs of digits, ASCII letters and non-ASCII characters. Every pair of
neighbouring words of a text is joined, by hash and then word by word, with the pairs of the
templates. A hit at document word p and template word q votes for the diagonal p - q. A template that
stands in the text gathers its votes on one diagonal; words added or left out shift the rest to a
neighbouring one. So votes are summed by diagonal, neighbouring diagonals (at most ``GAP`` apart) of
a template are merged into a span, and a span is verified by its share of the template's word pairs (each pair counts once).

Short phrases are templates whose places must be exact: all their pairs on one diagonal.

The joined template table is a fixed list (broadcast: its size doesn't depend on the data). Each
document also sends one row of its own through the join, which carries its number of words, so that texts
are read once and documents without hits stay. Rows are told apart by an own number: repeated
rows stay apart. A null text is empty; a null doc_id is kept as it is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases that are licenses marks wherever their words stand one after the other.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices looked for as a whole, with words changed, added or left out.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
GAP = 2                 # diagonals of one span are at most so far apart
LEAST_SHARE = 0.7       # of a notice's word pairs
MARK = "\x01"           # no word holds it: the row that carries a document's number of words


def words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def templates() -> list[tuple[str, str, bool, list[str]]]:
    """label, name, whether it is a phrase, words."""
    return ([(label, phrase, True, words(phrase)) for phrase, label in PHRASES.items()]
            + [(label, label, False, words(text)) for label, text in NOTICES.items()])


def _pairs(spark: SparkSession) -> DataFrame:
    rows = [(-1, -1, 0, "", False, MARK, MARK)]
    for t, (label, _, phrase, w) in enumerate(templates()):
        rows += [(t, q, len(w) - 1, label, phrase, w[q], w[q + 1]) for q in range(len(w) - 1)]
    return spark.createDataFrame(rows, "t int, q int, pairs int, label string, phrase boolean, w1 string, w2 string").withColumn("gram", F.xxhash64("w1", "w2"))


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.concat(F.array(F.lit(MARK), F.lit(MARK)), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("w"))
    # a pair at place p of this array begins at word p - 2
    grams = rows.select("row", "doc_id", (F.size("w") - 2).alias("n"), F.posexplode(
        F.arrays_zip(F.col("w").alias("w1"), F.slice("w", 2, F.size("w")).alias("w2"))).alias("p", "g"))
    grams = grams.select("row", "doc_id", "n", (F.col("p") - 2).alias("p"), F.col("g.w1").alias("d1"), F.col("g.w2").alias("d2"), F.xxhash64("g.w1", "g.w2").alias("gram"))
    hits = grams.join(F.broadcast(_pairs(spark)), "gram").filter((F.col("d1") == F.col("w1")) & (F.col("d2") == F.col("w2")))
    # the document's own row stands at -2 and meets only the mark
    hits = hits.select("row", "doc_id", "n", "t", "label", "phrase", "pairs", "q", (F.col("p") - F.col("q")).alias("diagonal"))
    votes = (hits.repartition("row").groupBy("row", "t", "diagonal")
             .agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("label").alias("label"), F.first("phrase").alias("phrase"),
                  F.first("pairs").alias("pairs"), F.expr("bit_or(shiftleft(1L, q))").alias("voted")))
    by_template = Window.partitionBy("row", "t").orderBy("diagonal")
    fresh = F.col("phrase") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_template) > GAP, F.lit(True))
    votes = votes.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(by_template))
    spans = votes.groupBy("row", "t", "span").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("label").alias("label"), F.first("phrase").alias("phrase"),
        F.first("pairs").alias("pairs"), F.expr("bit_or(voted)").alias("voted"), F.min("diagonal").alias("start"))
    spans = spans.withColumn("share", F.when(F.col("t") < 0, 0.0).otherwise(F.bit_count("voted") / F.col("pairs")))
    base = F.col("phrase") & (F.col("share") == 1)
    found = base | (~F.col("phrase") & (F.col("share") >= LEAST_SHARE))
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").cast("long").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start").cast("long"))).alias("first_word"), F.max(F.when(base, F.col("start").cast("long"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score")).drop("row")


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    rows = ", ".join(f"({t}, {q}, {len(w) - 1}, '{label}', {phrase}, '{w[q]}', '{w[q + 1]}')"
                     for t, (label, _, phrase, w) in enumerate(templates()) for q in range(len(w) - 1))
    return f"""
with pairs(t, q, pairs, label, phrase, w1, w2) as (values {rows}),
docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from documents),
places as (select r, w, unnest(range(1, len(w))) as i from docs),
hits as (
  select r, t, label, phrase, pairs, i - 1 - q as diagonal, bit_or(1::bigint << q) as voted
  from (select r, i, w[i] as d1, w[i + 1] as d2 from places) join pairs on d1 = w1 and d2 = w2
  group by all),
marked as (
  select *, case when phrase then 1 when diagonal - lag(diagonal) over (partition by r, t order by diagonal) <= {GAP} then 0 else 1 end as fresh
  from hits),
numbered as (select *, sum(fresh) over (partition by r, t order by diagonal) as span from marked),
spans as (
  select r, t, span, any_value(label) as label, any_value(phrase) as phrase, min(diagonal) as start,
         bit_count(bit_or(voted)) / any_value(pairs)::double as share
  from numbered group by r, t, span),
judged as (
  select *, phrase and share = 1 as base, (phrase and share = 1) or (not phrase and share >= {LEAST_SHARE}) as found from spans),
per_doc as (
  select r, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word, max(start) filter (where base) as last_word,
         list_sort(list(distinct label) filter (where base)) as base_labels, list_sort(list(distinct label) filter (where found)) as labels,
         max(share) filter (where found) as score
  from judged group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
       coalesce(array_to_string(base_labels, ','), '') as base_labels, coalesce(array_to_string(labels, ','), '') as labels, coalesce(score, 0)::double as score
from docs left join per_doc using (r)"""
