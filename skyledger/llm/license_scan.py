"""Licence scan by diagonal voting.

Templates (bare phrases and the opening lines of licences) are cut into word pairs with their positions. Every rolling word
pair of every document is joined to them by hash, and a hit is confirmed on the words themselves. A hit votes for its
diagonal, the difference of document and template position; votes are counted per document, template and diagonal,
neighbouring diagonals of a template are merged (words were added or lost), and a merged span is verified by the share of the
template that it covers. A bare phrase (the base phrases, and texts too short to lose a pair) must be covered entirely on one
diagonal.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import documents, public_id, stored

# The pattern of a word and the letters that are lowered.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    whole: bool = False


# The base phrases.
BASE = [Template("mit", "mit license", True, True), Template("apache", "apache license", True, True), Template("gpl", "general public license", True, True)]
# Short characteristic lines of public licences.
TEXTS = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    Template("proprietary", "All rights reserved", whole=True),
]
END = " "  # stands behind the last word of every document and in the template of document ends; no word contains it


def words_of(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(str.maketrans(UPPER, LOWER)))


def template_pairs(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``(template, at, pair, first, second)``; template -1 marks the end of a document. As many rows as templates have words."""
    rows = [(-1, 0, END, "")]
    for number, template in enumerate(templates):
        words = words_of(template.text)
        rows += [(number, at, a, b) for at, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    table = spark.createDataFrame(rows, "template int, at int, first string, second string")
    return table.withColumn("pair", F.xxhash64("first", "second"))


def scan(docs: DataFrame, templates: list[Template]) -> tuple[DataFrame, dict[int, int]]:
    """Votes ``(doc_id, text_key, template, diagonal, ats, low, high)`` and the pairs of every template; ``ats`` are the pairs hit.

    Template -1 is the end of a document: its only vote stands at the number of words.
    """
    spark = docs.sparkSession
    needed = {n: len(words_of(t.text)) - 1 for n, t in enumerate(templates)}
    words = F.concat(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), 0), F.array(F.lit(END), F.lit("")))
    rolling = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words.alias("words")).select(
        "*", F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("pos"))
    first, second = F.get("words", F.col("pos")), F.get("words", F.col("pos") + 1)
    # Templates are a fixed, small table; the words go along only to confirm the few hits.
    seeds = template_pairs(spark, templates).withColumnsRenamed({"first": "first_word", "second": "second_word"})
    hits = rolling.withColumn("pair", F.xxhash64(first, second)).join(F.broadcast(seeds), "pair").where(
        (first == F.col("first_word")) & ((second == F.col("second_word")) | (F.col("template") == -1)))
    votes = hits.groupBy("doc_id", "text_key", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    return votes, needed


def chained(rows: Iterable[tuple], drift: int, gap: int) -> Iterator[tuple]:
    """Spans ``(key, start, pairs)`` of diagonals ``(key, diagonal, low, high, ats)`` that lie in order of key and ``low``.

    A diagonal joins every span that has one within ``drift`` words of it that ended at most ``gap`` words before. A pair that
    several diagonals hit counts once. No more than the diagonals around one place are held: each is as long as its template.
    """
    current, held = None, []  # spans: start, pairs, diagonals that a later one may still join
    for key, diagonal, low, high, ats in rows:
        if key != current:
            yield from ((current, start, len(pairs)) for start, pairs, _ in held)
            current, held = key, []
        mine, others = (low, set(ats), [(diagonal, high)]), []
        for start, pairs, members in held:
            members = [m for m in members if low - m[1] <= gap]
            if not members:
                yield current, start, len(pairs)
            elif any(abs(diagonal - m[0]) <= drift for m in members):
                mine = (min(start, mine[0]), pairs | mine[1], members + mine[2])
            else:
                others.append((start, pairs, members))
        held = [*others, mine]
    yield from ((current, start, len(pairs)) for start, pairs, _ in held)


def spans(votes: DataFrame, templates: list[Template], needed: dict[int, int], coverage: float, drift: int, gap: int) -> DataFrame:
    """Verified spans ``(doc_id, text_key, template, label, base, start, covered)``; ``start`` is a word from 0.

    A phrase needs all its pairs on one diagonal. For texts, diagonals that differ by at most ``drift`` words and follow each
    other within ``gap`` words become one span, whatever lies between them, which stands if it holds ``coverage`` of the
    template's pairs.
    """
    table = votes.sparkSession.createDataFrame(
        [(n, needed[n], t.base, t.whole, t.label) for n, t in enumerate(templates)],
        "template int, needed int, base boolean, whole boolean, label string")
    known = votes.join(F.broadcast(table), "template")
    whole = known.where(F.col("whole") & (F.size("ats") == F.col("needed"))).select(
        "doc_id", "text_key", "template", "label", "base", F.col("diagonal").alias("start"), F.lit(1.0).alias("covered"))
    key = ["doc_id", "text_key", "template"]
    # Where all diagonals of a template together have too few pairs, no span of them has enough.
    enough = F.sum(F.size("ats")).over(W.partitionBy(*key)) / F.col("needed") >= coverage
    rows = known.where("NOT whole").repartition(*key).withColumn("enough", enough).where("enough").select(
        *key, "diagonal", "low", "high", "ats").sortWithinPartitions(*key, "low", "diagonal")

    def run(batches):
        values = (row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in range(7)), strict=True))
        out = []
        for (doc, text, template), start, pairs in chained(((row[:3], *row[3:]) for row in values), drift, gap):
            if pairs / needed[template] >= coverage:
                out.append((doc, text, template, start, pairs / needed[template]))
            if len(out) == 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                          names=[*key, "start", "covered"])

    merged = rows.mapInArrow(run, "doc_id long, text_key long, template int, start int, covered double")
    return whole.unionByName(merged.join(F.broadcast(table), "template").select(*whole.columns))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = 0.7, drift: int = 4,
           gap: int = 12) -> DataFrame:
    """Base places, labels and a score per document: 0 without a licence, the coverage of the best text, or 0.8 for a base phrase.

    A row repeated whole (same id and text) is one document; a document without words has no places and a score of 0.
    """
    templates = BASE + TEXTS
    votes, needed = scan(documents(docs, id_col, text_col), templates)
    votes = stored(votes, "votes")  # few: read once for the lengths and once for the spans
    ends = votes.where("template = -1").groupBy("doc_id", "text_key").agg(F.max("high").cast("long").alias("n_words"))
    found = spans(votes.where("template >= 0"), templates, needed, coverage, drift, gap).groupBy("doc_id", "text_key").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max(F.when(F.col("base"), 0.8).otherwise(F.col("covered"))).alias("score"))
    listed = lambda name: F.coalesce(F.array_join(name, ","), F.lit("")).alias(name)
    return ends.join(found, ["doc_id", "text_key"], "left").select(
        public_id(), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        listed("base_labels"), listed("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
