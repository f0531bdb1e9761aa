"""Packing documents into sequences of a fixed number of tokens with lexical neighbours.

Documents become token ids, each closed by an end id; they are stored and from then on read back.
Document frequencies and the mean length are those of all documents (terms are token ids).  A tree
of spherical k-means over sketches of the BM25 vectors, grown on a sample, gives each document its
leaf; inside a leaf, documents follow by their weighted samples of terms, so that near copies meet.
This order is cut into ranges of about ``TASK_TOKENS`` ids, one for a task, by a shuffle.

A task builds, over blocks of about ``SHARD_TOKENS`` ids or ``SHARD_DOCUMENTS`` documents, one shard
of a BM25 index.  A sequence starts with a seed document; its best unused neighbours fill the
sequence, the last one is cut at its end, and what is left of that document is the next seed.  A
sequence that is open when a shard ends goes on with neighbours from the next one, so only the last
sequence of a task can be short.  A seed does not ask the shards of other tasks: neighbours that the
tree puts elsewhere are missed (the README gives the share that is found).

The sequence ids of a task are those of its partition, so a repeated task gives the same rows.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed once each;
equal scores go to the earlier row of the order; documents that share no term with the seed follow
in that order; an empty table gives no pieces.  Only ``key`` and ``text`` are read, and NULL keys are
kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statflow.llm import tokens
from statflow.llm.common import scratch_path
from statflow.llm.words import mix

SEQUENCE, END_ID = 1024, 0
#: A shard of the index is closed by whichever it reaches first.
SHARD_TOKENS, SHARD_DOCUMENTS = 1 << 20, 4096
#: About so many ids go to one task.
TASK_TOKENS = 1 << 21
#: The usual constants of BM25.
K1, B = 1.2, 0.75
#: Left out of the index: terms of more than this share of the documents.
COMMON = 0.25
#: A term in at least one of so many unused documents of a shard has a row of weights instead of a postings
#: list: to sum rows costs less an entry than to gather lists, and rows hold at most so many times the entries.
DENSE = 8
#: Cells of a sketch; documents that the tree is grown on, its branches, rounds, and the least of a node.
CELLS, SAMPLE, BRANCHES, ROUNDS, LEAST = 256, 20_000, 8, 8, 16
_ARROW = {"start": pa.int64(), "length": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(), "ids": pa.binary()}


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces: ``key, start, length, doc_tokens, sequence_id, offset, ids``; ids are little-endian
    unsigned 32-bit numbers, ``start`` counts ids of the document before the piece."""
    largest = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values())
    kind = "<u2" if largest < 1 << 16 else "<u4"
    held = _encoded(docs, tokenizer, key, text, end_id, kind)
    corpus = _count(held, largest + 1, kind)
    placed, parts = _placed(held, corpus, kind)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(sequence, TaskContext.get().partitionId() << 40, corpus)
        of = None
        names: list = []
        block: list[np.ndarray] = []
        for batch in batches:
            of = batch.schema.field("name").type
            names += batch["name"].to_pylist()
            block += [ids.astype(np.int64) for ids in _documents(batch, kind)]
            if len(block) >= SHARD_DOCUMENTS or sum(map(len, block)) >= SHARD_TOKENS:
                yield from packer.add(names, block, key, of)
                names, block = [], []
        if block:
            yield from packer.add(names, block, key, of)

    schema = f"`{key}` {key_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    ordered = placed.repartitionById(parts, "part").sortWithinPartitions("place", "row")
    return ordered.select("name", "ids").mapInArrow(run, schema)


def _encoded(docs: DataFrame, tokenizer: str, key: str, text: str, end_id: int, kind: str) -> DataFrame:
    """``name, ids, row``, stored; ``row`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            found = encode([one or "" for one in batch["text"].to_pylist()])
            ids = pa.array([np.append(one, end_id).astype(kind).tobytes() for one in found], pa.binary())
            rows = pa.array(np.arange(row, row + len(found)))
            row += len(found)
            yield pa.RecordBatch.from_arrays([batch["name"], ids, rows], ["name", "ids", "row"])

    schema = f"name {docs.schema[key].dataType.simpleString()}, ids binary, row long"
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "packing")
    rows = docs.select(F.col(key).alias("name"), F.col(text).alias("text")).mapInArrow(run, schema)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _documents(batch: pa.RecordBatch, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(ids.as_buffer(), kind) for ids in batch["ids"]]


class _Corpus(NamedTuple):
    """What BM25 needs of all documents; terms outside the index have the weight 0."""

    idf: np.ndarray
    mean: float
    count: int
    tokens: int

    @classmethod
    def of(cls, spread: np.ndarray, count: int, total: int) -> _Corpus:
        kept = (spread > 1) & (spread <= max(2, COMMON * count))
        idf = np.where(kept, np.log1p((count - spread + 0.5) / (spread + 0.5)), 0)
        return cls(idf, max(1.0, total / max(1, count)), count, total)


def _terms(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, document) pairs in order, and how often each occurs."""
    count = len(documents)
    owner = np.repeat(np.arange(count), [len(ids) for ids in documents])
    flat = np.concatenate(documents)
    narrow = np.int32 if (int(flat.max()) + 1) * count < 1 << 31 else np.int64
    keys, times = np.unique(flat.astype(narrow) * narrow(count) + owner.astype(narrow), return_counts=True)
    return *np.divmod(keys.astype(np.int64), count), times


def _weighted(documents: list[np.ndarray], corpus: _Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indexed terms in order, their documents, and the BM25 weights."""
    terms, owner, times = _terms(documents)
    inside = corpus.idf[terms] > 0
    terms, owner, times = terms[inside], owner[inside], times[inside]
    norm = K1 * (1 - B + B * np.array([len(ids) for ids in documents]) / corpus.mean)
    return terms, owner, times * (K1 + 1) / (times + norm[owner]) * corpus.idf[terms]


def _count(held: DataFrame, size: int, kind: str) -> _Corpus:
    """Document frequencies over all documents; at most one row for each id of the tokenizer is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread, count, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            documents = _documents(batch, kind)
            if documents:
                spread += np.bincount(_terms(documents)[0], minlength=size)
                count, total = count + len(documents), total + sum(map(len, documents))
        terms = np.flatnonzero(spread)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(terms, [-1, -2])), pa.array(np.append(spread[terms], [count, total]))], ["term", "n"])

    rows = held.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {row.term: row.n for row in rows}
    count, total = found.pop(-1, 0), found.pop(-2, 0)
    spread = np.zeros(size, np.int64)
    spread[list(found)] = list(found.values())
    return _Corpus.of(spread, count, total)


def _sketches(documents: list[np.ndarray], corpus: _Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of signed sums of term weights, and for each document a number in [0, 1) that
    depends on two terms drawn by weight, the same ones for like documents."""
    count = len(documents)
    terms, owner, weight = _weighted(documents, corpus)
    hashed = mix(terms.astype(np.uint64) + np.uint64(1))
    sign = 1.0 - 2.0 * (hashed >> np.uint64(63)).astype(float)
    flat = np.bincount(owner * CELLS + (hashed % np.uint64(CELLS)).astype(np.int64), sign * weight, count * CELLS)
    sketches = flat.reshape(count, CELLS).astype(np.float32)
    sketches /= np.maximum(1e-9, np.linalg.norm(sketches, axis=1, keepdims=True))
    drawn = mix(hashed ^ np.uint64(0x9E3779B97F4A7C15))
    clock = -np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weight
    order = np.lexsort((clock, owner))
    code = np.append((hashed[order] >> np.uint64(20)) % np.uint64(1 << 16), np.uint64(0)).astype(float)
    first = np.searchsorted(owner[order], np.arange(count + 1))
    size, first = np.diff(first), first[:-1]
    one = np.where(size > 0, code[first], 0.0)
    two = np.where(size > 1, code[np.minimum(first + 1, len(order))], 0.0)
    return sketches, (one + two / (1 << 16)) / (1 << 16)


class _Tree:
    """Spherical k-means, a node's vectors dealt to its branches; leaves are numbered so that close ones follow each other."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.leaves = 0
        self.root = self._grow(vectors, np.random.default_rng(0))

    def _grow(self, vectors: np.ndarray, draw: np.random.Generator):
        if len(vectors) >= LEAST:
            centres = vectors[draw.choice(len(vectors), BRANCHES, replace=False)]
            for _ in range(ROUNDS):
                near = np.argmax(vectors @ centres.T, axis=1)
                centres = np.array([vectors[near == n].sum(axis=0) if (near == n).any() else centres[n] for n in range(BRANCHES)])
                centres /= np.maximum(1e-9, np.linalg.norm(centres, axis=1, keepdims=True))
            chain, left = [0], set(range(1, BRANCHES))
            while left:
                chain.append(max(sorted(left), key=lambda n: centres[n] @ centres[chain[-1]]))
                left.remove(chain[-1])
            centres = centres[chain]
            near = np.argmax(vectors @ centres.T, axis=1)
            if np.bincount(near, minlength=BRANCHES).max() < len(vectors):
                return centres, [self._grow(vectors[near == n], draw) for n in range(BRANCHES)]
        self.leaves += 1
        return self.leaves - 1

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        found = np.zeros(len(vectors), np.int64)
        waiting = [(self.root, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if isinstance(node, int):
                found[rows] = node
                continue
            near = np.argmax(vectors[rows] @ node[0].T, axis=1)
            waiting += [(branch, rows[near == n]) for n, branch in enumerate(node[1]) if (near == n).any()]
        return found


def _placed(held: DataFrame, corpus: _Corpus, kind: str) -> tuple[DataFrame, int]:
    """``held`` with ``place`` in the order by likeness and ``part``, the range it falls in; and the number of ranges.

    The limits of the ranges come from the sample; rows at a place that fills several ranges are
    spread over them."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                documents = _documents(batch, kind)
                vectors, fine = _sketches(documents, corpus)
                columns = [pa.array([one.astype("<f2").tobytes() for one in vectors], pa.binary()), pa.array(fine), pa.array([len(ids) for ids in documents], pa.int64()), batch["row"]]
                yield pa.RecordBatch.from_arrays(columns, ["sketch", "fine", "tokens", "row"])

    share = min(1.0, SAMPLE / max(1, corpus.count))
    drawn = held.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else held
    rows = sorted(drawn.select("ids", "row").mapInArrow(sketch, "sketch binary, fine double, tokens long, row long").collect(), key=lambda row: row.row)
    vectors = np.frombuffer(b"".join(bytes(row.sketch) for row in rows), "<f2").astype(np.float32).reshape(len(rows), CELLS)
    tree = _Tree(vectors)
    parts = max(1, -(-corpus.tokens // TASK_TOKENS))
    limits = np.zeros(0)
    if rows:
        places = tree.leaf(vectors) + np.array([row.fine for row in rows])
        order = np.argsort(places, kind="stable")
        sums = np.cumsum(np.array([row.tokens for row in rows])[order])
        limits = places[order][np.searchsorted(sums, sums[-1] * np.arange(1, parts) / parts)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, fine = _sketches(_documents(batch, kind), corpus)
            # as the sample was rounded
            places = tree.leaf(vectors.astype("<f2").astype(np.float32)) + fine
            low, high = np.searchsorted(limits, places, "left"), np.searchsorted(limits, places, "right")
            salt = (mix(batch["row"].to_numpy().astype(np.uint64)) >> np.uint64(11)).astype(float) / (1 << 53)
            part = low + (salt * (high - low + 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(part.astype(np.int32))], [*batch.schema.names, "place", "part"])

    schema = f"name {held.schema['name'].dataType.simpleString()}, ids binary, row long, place double, part int"
    return held.mapInArrow(place, schema), parts


class _Packer:
    """Fills sequences in order; keeps the open one from shard to shard."""

    def __init__(self, size: int, first: int, corpus: _Corpus) -> None:
        self.size, self.sequence, self.filled, self.corpus = size, first, 0, corpus
        self.seed: np.ndarray | None = None

    def add(self, names: list, documents: list[np.ndarray], key: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        index, rows = _Shard(documents, self.corpus), []
        waiting = iter(())
        if self.seed is not None:
            waiting = index.neighbours(self.seed)
        while index.left:
            at = next(waiting, None)
            if at is None:
                at = index.first()
            elif not index.unused[at]:
                continue
            index.take(at)
            ids, done = documents[at], 0
            while done < len(ids):
                length = min(len(ids) - done, self.size - self.filled)
                rows.append((at, done, length, len(ids), self.sequence, self.filled, ids[done : done + length].astype("<u4").tobytes()))
                if not self.filled:
                    self.seed = None
                done, self.filled = done + length, self.filled + length
                if self.filled == self.size:
                    self.sequence, self.filled, self.seed = self.sequence + 1, 0, None
                    waiting = iter(())
            if self.filled and self.seed is None:
                self.seed = ids
                waiting = index.neighbours(ids, at)
            if len(rows) >= 4096:
                yield self._batch(rows, names, key, kind)
                rows = []
        if rows:
            yield self._batch(rows, names, key, kind)

    @staticmethod
    def _batch(rows: list[tuple], names: list, key: str, kind: pa.DataType) -> pa.RecordBatch:
        at, *columns = zip(*rows)
        arrays = [pa.array([names[one] for one in at], kind)]
        arrays += [pa.array(values, of) for values, of in zip(columns, _ARROW.values())]
        return pa.RecordBatch.from_arrays(arrays, [key, *_ARROW])


class _Shard:
    """A BM25 inverted index over the documents of a block, weighted as in ``corpus``, by default the block.

    Used documents are left out of it whenever a quarter of those in it have been used."""

    def __init__(self, documents: list[np.ndarray], corpus: _Corpus | None = None) -> None:
        count = self.left = len(documents)
        self.unused, self.next = np.ones(count, bool), 0
        if corpus is None:
            corpus = _Corpus.of(np.bincount(_terms(documents)[0]), count, sum(map(len, documents)))
        self.idf = corpus.idf
        terms, posted, weight = _weighted(documents, corpus)
        new = np.append(1, np.diff(terms))[: len(terms)] > 0
        self.names, terms = terms[new], np.cumsum(new) - 1
        order = np.argsort(posted, kind="stable")
        self.own, self.edges = terms[order], np.searchsorted(posted[order], np.arange(count + 1))
        self.live = np.arange(count)
        self._lay(terms, posted, weight)

    def _lay(self, terms: np.ndarray, posted: np.ndarray, weight: np.ndarray) -> None:
        """``posted`` are numbers in ``live``."""
        self.entries = terms, posted, weight
        size = np.bincount(terms, minlength=len(self.names))
        self.bounds = np.append(0, np.cumsum(size))
        often = np.flatnonzero(size * DENSE >= len(self.live))
        self.row = np.full(len(self.names), -1)
        self.row[often] = np.arange(len(often))
        inside = self.row[terms] >= 0
        self.rows = np.zeros((len(often), len(self.live)))
        self.rows[self.row[terms[inside]], posted[inside]] = weight[inside]

    def _shrink(self) -> None:
        terms, posted, weight = self.entries
        unused = self.unused[self.live]
        kept, number = unused[posted], np.cumsum(unused) - 1
        self.live = self.live[unused]
        self._lay(terms[kept], number[posted[kept]], weight[kept])

    def take(self, at: int) -> None:
        self.unused[at] = False
        self.left -= 1

    def first(self) -> int:
        """The first unused document."""
        while not self.unused[self.next]:
            self.next += 1
        return self.next

    def neighbours(self, ids: np.ndarray, at: int | None = None) -> Iterator[int]:
        """Documents that share terms with ``ids``, those of document ``at`` if it is of this shard, best
        first; the caller skips used ones."""
        if self.left <= 0.75 * len(self.live):
            self._shrink()
        terms = np.flatnonzero(np.isin(self.names, ids)) if at is None else self.own[self.edges[at] : self.edges[at + 1]]
        rows = self.row[terms]
        scores = np.take(self.rows, rows[rows >= 0], axis=0).sum(axis=0)
        terms = terms[(rows < 0) & (self.bounds[terms + 1] > self.bounds[terms])]
        if len(terms):
            # whole postings lists, one after the other: cheaper than single entries
            lists = list(zip(self.bounds[terms].tolist(), self.bounds[terms + 1].tolist()))
            _, posted, weight = self.entries
            found = np.concatenate([posted[a:b] for a, b in lists])
            scores += np.bincount(found, np.concatenate([weight[a:b] for a, b in lists]), len(scores))
        if not len(scores):
            return
        live = self.live
        scores[~self.unused[live]] = 0
        while scores[best := int(np.argmax(scores))] > 0:
            scores[best] = 0
            yield int(live[best])


def padding(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``sequences, tokens, padded``: a sequence is padded to full length unless its length is a power of two."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    whole = F.pow(2.0, F.round(F.log2("filled"))) == F.col("filled")
    pad = F.when(whole, 0).otherwise(sequence - F.col("filled"))
    return filled.agg(F.count("*").alias("sequences"), F.sum("filled").alias("tokens"), F.sum(pad).alias("padded"))
