"""License scan: an exact set-similarity join of text blocks with license notices.

A notice is a set of words with a label.  A text block is a run of ``W`` consecutive words, a new one
starting every ``W / 2``; ``W`` is the power of two from twice the words of a notice, so a notice that
is quoted as it stands lies whole in one block of its width.  A block meets a notice if it holds at least
``CONTAINED`` of the notice's words, in any order.  Every such block is found:

1. The words of all notices are counted over all texts, and ordered by that: rarest first.
2. A notice of ``n`` words needs ``c`` of them in a block.  So one of its ``n - c + 1`` rarest words must be
   there (prefix filter): these are indexed, and a block without any of them is given up at once.
   So is one with fewer than ``c`` words of notices at all (length filter).
3. Spark joins the words of the remaining blocks with the indexed ones.  If a word stands at place ``i`` of the
   notice and ``j`` of the block in that order, at most ``min(n - i, m - j)`` words can be common from
   there on (positional filter); for the first common word of a pair that meets the threshold this is at least ``c``.
4. What is left is verified on the whole sets.

Texts are read by Python workers, a batch at a time, and only words of notices go on, as numbers.
The notices that a pass knows are bounded by ``PART_BYTES``; a larger table is taken in several
passes, and their matches are united.  Matches are joined to rows by a digest of the text, so
copies of a text share them; the rows themselves are not shuffled where Spark can broadcast the matches.

Besides, ``PHRASES`` are looked for as they stand, word by word (``n_base`` and so on).

Defined results: NULL or empty text, or text without words, has no words, no labels, and score 0;
repeated rows each keep their row; notices without words, or with a NULL label, are passed over;
no notices, or an empty table, is no error.  The score is 1 where a phrase stands, else the best share of a notice's
words in a block that meets it, else 0.  Other columns are kept; columns with the names of the results
and ``__text_key`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm.common import pass_through, schema_with
from statflow.llm.words import fold, hashed_words, word_spans

#: Share of a notice's words that a block must hold.
CONTAINED = 0.8
#: Bytes of notices that one pass over the texts looks for.
PART_BYTES = 4 << 20
#: Words of the narrowest block.
NARROWEST = 8

# Phrases that are looked for word by word, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Usual wording of public licenses.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

RESULTS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, score double, matches array<struct<label:string,start:bigint,end:bigint,score:double>>"
)
_BASE = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>"
_BLOCKS = "array<struct<width:int,at:bigint,words:array<int>>>"
_BLOCKS_ARROW = pa.list_(pa.struct([("width", pa.int32()), ("at", pa.int64()), ("words", pa.list_(pa.int32()))]))


def notices(spark: SparkSession) -> DataFrame:
    """The usual notices as ``label, text``."""
    return spark.createDataFrame(list(NOTICES), "label string, text string")


def needed(words: int, contained: float = CONTAINED) -> int:
    """Common words that meet a notice of so many different ones."""
    return max(1, math.ceil(contained * words - 1e-9))


def width(words: int) -> int:
    """Words of the blocks in which a notice of so many words is sought."""
    return max(NARROWEST, 1 << (2 * words - 1).bit_length())


@dataclass
class Part:
    """Notices of one pass: their words by hash, and each notice as numbers of words, rarest first."""

    hashes: np.ndarray
    labels: list[str]
    sets: list[np.ndarray]
    widths: list[int]
    contained: float

    @classmethod
    def of(cls, rows: Sequence[tuple[str, str]], contained: float) -> Part | None:
        found, sizes = hashed_words([text.encode() for _, text in rows])
        hashes, numbers = np.unique(found, return_inverse=True)
        ends = np.cumsum(sizes)
        sets = [np.unique(numbers[end - size : end]) for end, size in zip(ends, sizes)]
        used = [n for n, size in enumerate(sizes) if size]
        if not used:
            return None
        return cls(hashes, [rows[n][0] for n in used], [sets[n] for n in used], [width(int(sizes[n])) for n in used], contained)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those of no notice."""
        spot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[spot] == hashes, spot, -1)

    def ordered(self, often: dict[int, int]) -> Part:
        """The same notices with words numbered from the rarest on; ties by hash."""
        counts = np.array([often.get(n, 0) for n in range(len(self.hashes))])
        order = np.lexsort((self.hashes, counts))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return RankedPart(self.hashes, self.labels, [np.sort(rank[one]) for one in self.sets], self.widths, self.contained, rank)

    def needs(self, n: int) -> int:
        return needed(len(self.sets[n]), self.contained)

    def prefix(self, n: int) -> np.ndarray:
        """The rarest words, of which a block that meets the notice has one."""
        return self.sets[n][: len(self.sets[n]) - self.needs(n) + 1]


@dataclass
class RankedPart(Part):
    rank: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        found = super().find(hashes)
        return np.where(found < 0, -1, self.rank[found])

    def filters(self) -> dict[int, tuple[np.ndarray, int]]:
        """By width of blocks: which words are indexed, and the fewest words that any notice needs."""
        out = {}
        for n, size in enumerate(self.widths):
            indexed, least = out.get(size, (np.zeros(len(self.hashes), bool), 1 << 30))
            indexed[self.prefix(n)] = True
            out[size] = indexed, min(least, self.needs(n))
        return out


def _texts(column: pa.Array) -> list[bytes]:
    return [value or b"" for value in column.to_pylist()]


def _counter(part):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = part.value
        total = np.zeros(len(known.hashes), np.int64)
        for batch in batches:
            found = known.find(hashed_words(_texts(batch.column(0)))[0])
            total += np.bincount(found[found >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["word", "n"])

    return run


def blocks_of(words: np.ndarray, filters: dict[int, tuple[np.ndarray, int]]) -> list[dict]:
    """Blocks of a text that pass the prefix and the length filter; -1 is a word of no notice."""
    places = np.flatnonzero(words >= 0)
    words, out = words[places], []
    for size, (indexed, least) in filters.items():
        step = size // 2
        rare = places[indexed[words]] // step
        starts = np.unique(np.concatenate([rare, rare - 1])) * step
        starts = starts[starts >= 0]
        ends = np.searchsorted(places, starts + size)
        for start, first, after in zip(starts.tolist(), np.searchsorted(places, starts).tolist(), ends.tolist()):
            own = np.unique(words[first:after])
            if len(own) >= least:
                out.append({"width": size, "at": start, "words": own})
    return out


def _blocker(part):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = part.value
        filters = known.filters()
        for batch in batches:
            hashes, sizes = hashed_words(_texts(batch.column(1)))
            found, after = known.find(hashes), np.cumsum(sizes)
            blocks = [blocks_of(found[end - size : end], filters) if size else [] for end, size in zip(after, sizes)]
            some = pa.array([n for n, one in enumerate(blocks) if one], pa.int32())
            column = pa.array([one for one in blocks if one], _BLOCKS_ARROW)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), column], ["__text_key", "blocks"])

    return run


def _matches(docs: DataFrame, rows: list[tuple[str, str]], contained: float) -> DataFrame | None:
    """``__text_key, label, start, end, score`` of the blocks that meet one of the notices ``rows``."""
    spark = docs.sparkSession
    part = Part.of(rows, contained)
    if part is None:
        return None
    # bounded: notices of at most PART_BYTES
    plain = spark.sparkContext.broadcast(part)
    often = docs.select("text").mapInArrow(_counter(plain), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ranked = part.ordered({row.word: row.n for row in often.collect()})
    known = spark.sparkContext.broadcast(ranked)
    plain.unpersist()

    indexed = [
        (int(word), ranked.widths[n], i, len(one), ranked.needs(n), n)
        for n, one in enumerate(ranked.sets)
        for i, word in enumerate(ranked.prefix(n))
    ]
    wholes = [(n, ranked.labels[n], one.tolist()) for n, one in enumerate(ranked.sets)]
    index = spark.createDataFrame(indexed, "word int, width int, i int, n int, c int, notice int")
    whole = spark.createDataFrame(wholes, "notice int, label string, whole array<int>")

    found = docs.select("__text_key", "text").mapInArrow(_blocker(known), f"__text_key binary, blocks {_BLOCKS}")
    block = found.select("__text_key", F.explode("blocks").alias("block"))
    words = block.select("__text_key", "block", F.posexplode("block.words").alias("j", "word")).withColumn("width", F.col("block.width"))
    m = F.size("block.words")
    pairs = words.join(index, ["word", "width"]).where(F.least(F.col("n") - F.col("i"), m - F.col("j")) >= F.col("c"))
    common = F.size(F.array_intersect("whole", "block.words"))
    met = pairs.join(whole, "notice").withColumn("common", common).where(F.col("common") >= F.col("c"))
    return met.select(
        "__text_key", "label", F.col("block.at").alias("start"), (F.col("block.at") + F.col("width")).alias("end"), (F.col("common") / F.col("n")).alias("score")
    )


def phrase_places(hashes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand one after the other."""
    count = len(hashes) - len(phrase) + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    places = np.flatnonzero(hashes[:count] == phrase[0])
    for n in range(1, len(phrase)):
        places = places[hashes[places + n] == phrase[n]]
    return places


def _base(names: list[str], text: str, phrases: Sequence[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [(fold(phrase.encode()).split(), label) for phrase, label in phrases]
        hashed = [hashed_words([phrase.encode()])[0] for phrase, _ in phrases]
        for batch in batches:
            texts = [(value or "").encode() for value in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            hashes, sizes = hashed_words(texts)
            after = np.cumsum(sizes)
            counts, first, last, labels = [], [], [], []
            for data, end, size in zip(texts, after, sizes):
                own, found, of = hashes[end - size : end], [], set()
                spans = None
                for (words, label), key in zip(wanted, hashed):
                    for at in phrase_places(own, key).tolist():
                        starts, ends = spans = spans or word_spans(data)
                        here = fold(data[starts[at] : ends[at + len(words) - 1]]).split()
                        if here == words:  # equal hashes are not yet equal words
                            found.append(at)
                            of.add(label)
                counts.append(len(found))
                first.append(min(found, default=None))
                last.append(max(found, default=None))
                labels.append(sorted(of))
            yield pass_through(
                batch,
                names,
                n_words=pa.array(sizes, pa.int64()),
                n_base=pa.array(counts, pa.int64()),
                first_word=pa.array(first, pa.int64()),
                last_word=pa.array(last, pa.int64()),
                base_labels=pa.array(labels, pa.list_(pa.string())),
                __text_key=batch.column(batch.schema.get_field_index("__text_key")),
            )

    return run


def scan(
    docs: DataFrame,
    known: DataFrame | None = None,
    text: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    contained: float = CONTAINED,
    part_bytes: int = PART_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``RESULTS``; ``known`` are notices as ``label, text``.

    ``matches`` are the blocks that meet a notice: label, first and behind the last word, share."""
    spark = docs.sparkSession
    known = notices(spark) if known is None else known
    known = known.select("label", "text").where("label is not null and text is not null").distinct()
    size = known.agg(F.coalesce(F.sum(F.octet_length("text") + 50), F.lit(0))).first()[0]
    parts = -(-size // part_bytes)
    # 128 bits of the text; one value for NULL and empty
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    read = docs.select(key.alias("__text_key"), F.col(text).cast("binary").alias("text"))
    found = None
    for part in range(parts):
        rows = known.where(F.pmod(F.xxhash64("label", "text"), F.lit(parts)) == part).collect()
        more = _matches(read, [(row.label, row.text) for row in sorted(rows)], contained)
        found = more if found is None else found if more is None else found.unionByName(more)
    if found is None:
        found = spark.createDataFrame([], "__text_key binary, label string, start long, end long, score double")
    match = F.struct("label", "start", "end", "score")
    found = found.groupBy("__text_key").agg(F.sort_array(F.collect_set(match)).alias("matches"))

    results = [part.split()[0] for part in _BASE.split(", ")] + ["labels", "score", "matches"]
    names = [name for name in (keep or docs.columns) if name not in (*results, "__text_key")]
    asked = docs.withColumn("__text_key", key).select("__text_key", *dict.fromkeys([*names, text]))
    base = asked.mapInArrow(_base(names, text, phrases), schema_with(docs.select(*names), f"{_BASE}, __text_key binary"))
    joined = base.join(found, "__text_key", "left")
    best = F.coalesce(F.array_max(F.transform("matches", lambda match: match["score"])), F.lit(0.0))
    of = F.coalesce(F.transform("matches", lambda match: match["label"]), F.array().cast("array<string>"))
    return joined.select(
        *names,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        F.array_sort(F.array_union("base_labels", of)).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.coalesce("matches", F.array().cast("array<struct<label:string,start:bigint,end:bigint,score:double>>")).alias("matches"),
    )
