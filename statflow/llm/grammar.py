"""Token ids in compressed files: Re-Pair grammars, one for each shard.

Documents are put in ascending order of their key by a range partitioning and encoded.  A task
writes its documents as shards of about ``SHARD_TOKENS`` ids.  In a shard, frequent pairs of
neighbouring symbols are replaced by nonterminals, round after round, each round as many pairs as
pay.  Pairs never cross documents, and a shard stores the rules and the expansion length of each
nonterminal, so any range of ids of any document can be decoded alone.

Rounds go on until one saves less than ``GAIN`` of the symbols.  A rule costs two symbols and a length, so a
pair pays from ``LEAST`` occurrences on; while the vocabulary leaves room in 16 bits, rules stay within it, because
wider symbols would double the stream.

A shard is one row of a Parquet table (Spark's writer commits it, so a lost executor leaves
nothing half-written): ``part, shard, first, keys, sizes, symbols, vocabulary, stream, width, rules, lengths``.
``keys`` are the documents in order, ``sizes`` their ids, ``symbols`` their symbols; ``stream`` has
the symbols of ``width`` bytes; ``rules`` are pairs of 32-bit symbols; the nonterminal of rule n is
the vocabulary's size plus n, and ``lengths`` counts the ids it stands for.  ``first`` is the
number of ids in earlier shards of the same part; parts follow each other in order.

Defined results: a NULL or empty text is the end id alone; NULL keys come first; equal keys keep
one entry per row, in order of their texts; an empty table gives no shards and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import tokens

END_ID, SHARD_TOKENS = 2, 1 << 20
#: The share of the symbols that a round must save for another one, and the least occurrences of a pair.
GAIN, LEAST = 0.01, 8
_SLOT_BITS = 17
SHARD = (
    "part int, shard int, first long, {key} array<{kind}>, sizes array<int>, symbols array<int>, vocabulary int, width int, "
    "stream binary, rules binary, lengths binary"
)


def compress(ids: np.ndarray, sizes: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``stream, symbols of each document, rules, lengths`` of documents that lie one after the other."""
    stream = ids.astype(np.int64)
    ends = np.cumsum(sizes)
    rules: list[np.ndarray] = []
    lengths = [np.ones(vocabulary, np.int64)]
    room = max(0, (1 << 16) - vocabulary) if vocabulary < 1 << 16 else 1 << 20
    saved = GAIN
    while saved >= GAIN and len(stream) > 1:
        keys = stream[:-1] << 32 | stream[1:]
        keys[ends[:-1] - 1] = -1  # pairs that cross documents
        chosen, rank = _frequent(keys, (room + 1) // 2)
        if not len(chosen):
            break
        at = _without_overlap(rank, len(chosen))
        used = np.bincount(rank[at], minlength=len(chosen)) >= LEAST  # others lost too many places to them
        if not used.any():
            break
        at, number = at[used[rank[at]]], np.cumsum(used) - 1
        base = vocabulary + sum(map(len, rules))
        chosen = chosen[used]
        pairs = np.stack([chosen >> 32, chosen & 0xFFFFFFFF], 1)
        rules.append(pairs)
        known = np.concatenate(lengths)
        lengths.append(known[pairs[:, 0]] + known[pairs[:, 1]])
        room -= len(chosen)
        stream[at] = base + number[rank[at]]
        kept = np.ones(len(stream), bool)
        kept[at + 1] = False
        ends = np.cumsum(kept)[ends - 1]
        saved = len(at) / len(stream)
        stream = stream[kept]
    found = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return stream, np.diff(ends, prepend=0), found, np.concatenate(lengths)[vocabulary:]


def _without_overlap(rank: np.ndarray, none: int) -> np.ndarray:
    """Places to replace: of overlapping pairs the most frequent, and every second one in a run of one id."""
    places = np.arange(len(rank))
    left, right = np.append(none, rank[:-1]), np.append(rank[1:], none)
    begin = np.maximum.accumulate(np.where(rank == left, 0, places))
    return np.flatnonzero((rank < none) & (rank <= left) & (rank <= right) & ((places - begin) % 2 == 0))


def _frequent(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` pairs with at least ``LEAST`` occurrences, most frequent first, and for each
    key its place among them (their number for the others).  One pair for each slot of a hash table
    is counted; a pair that shares its slot with another may wait for the next round."""
    slots = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).view(np.int64)
    holder = np.full(1 << _SLOT_BITS, -1)
    holder[slots] = keys
    own = (holder[slots] == keys) & (keys >= 0)
    times = np.bincount(slots[own], minlength=len(holder))
    often = np.flatnonzero(times >= LEAST)
    often = often[np.argsort(-times[often], kind="stable")[:most]]
    place = np.full(len(holder), len(often), np.int32)
    place[often] = np.arange(len(often))
    return holder[often], np.where(own, place[slots], len(often))


def expand(stream: np.ndarray, rules: np.ndarray, lengths: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids that symbols stand for."""
    if not len(rules):
        return stream.astype(np.int64)
    bounds = np.concatenate([np.arange(vocabulary + 1), vocabulary + np.cumsum(lengths)])
    flat = np.arange(bounds[-1])  # ids of every symbol, in order
    for at, (left, right) in enumerate(rules.tolist()):
        start, half = bounds[vocabulary + at], bounds[left + 1] - bounds[left]
        flat[start : start + half] = flat[bounds[left] : bounds[left + 1]]
        flat[start + half : bounds[vocabulary + at + 1]] = flat[bounds[right] : bounds[right + 1]]
    size = np.diff(bounds)[stream]
    after = np.cumsum(size)
    return flat[np.repeat(bounds[stream] - after + size, size) + np.arange(size.sum())]


def decode_range(stream: np.ndarray, rules: np.ndarray, lengths: np.ndarray, start: int, stop: int, vocabulary: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a document, decoded from the symbols that cover them alone."""
    size = np.append(np.ones(vocabulary, np.int64), lengths)[stream]
    after = np.cumsum(size)
    first, last = np.searchsorted(after, start, "right"), np.searchsorted(after, stop, "left")
    inside = expand(stream[first : last + 1], rules, lengths, vocabulary)
    skipped = start - (after[first] - size[first] if first < len(size) else start)
    return inside[skipped : skipped + stop - start]


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, parts: int = 0) -> None:
    """Encodes ``docs`` in ascending order of ``key`` into files at ``path``."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = docs.select(key, text).repartitionByRange(parts, key, F.xxhash64(text)).sortWithinPartitions(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        vocabulary = 1 + max(end_id, *encode.tokenizer.get_vocab().values())
        names, held, shard, first = [], [], 0, 0
        for batch in batches:
            kind = batch.schema.field(key).type
            names += batch[key].to_pylist()
            held += [np.append(ids, end_id) for ids in encode([one or "" for one in batch[text].to_pylist()])]
            if sum(map(len, held)) >= SHARD_TOKENS:
                yield _row(part, shard, first, key, kind, names, held, vocabulary)
                first, shard, names, held = first + sum(map(len, held)), shard + 1, [], []
        if held:
            yield _row(part, shard, first, key, kind, names, held, vocabulary)

    schema = SHARD.format(key=f"`{key}`", kind=docs.schema[key].dataType.simpleString())
    laid.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def _row(part: int, shard: int, first: int, key: str, kind: pa.DataType, names: list, held: list, vocabulary: int) -> pa.RecordBatch:
    sizes = np.array([len(ids) for ids in held])
    stream, symbols, rules, lengths = compress(np.concatenate(held), sizes, vocabulary)
    width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int32()),
            "shard": pa.array([shard], pa.int32()),
            "first": pa.array([first], pa.int64()),
            key: pa.array([names], pa.list_(kind)),
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "symbols": pa.array([symbols], pa.list_(pa.int32())),
            "vocabulary": pa.array([vocabulary], pa.int32()),
            "width": pa.array([width], pa.int32()),
            "stream": pa.array([stream.astype(f"<u{width}").tobytes()], pa.binary()),
            "rules": pa.array([rules.astype("<u4").tobytes()], pa.binary()),
            "lengths": pa.array([lengths.astype("<u4").tobytes()], pa.binary()),
        }
    )


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of every document; ids are little-endian unsigned 32-bit numbers."""
    files = spark.read.parquet(path)
    kind = files.schema[key].dataType.elementType.simpleString()
    # one row for each part
    totals = files.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("size"))
    before, starts = 0, {}
    for part, size in sorted((row.part, row["size"]) for row in totals.collect()):
        starts[part] = before
        before += size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                shard = {name: row[name][0].as_py() for name in ("part", "first", "vocabulary", "width", "stream", "rules", "lengths")}
                stream = np.frombuffer(shard["stream"], f"<u{shard['width']}")
                rules, lengths = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), np.frombuffer(shard["lengths"], "<u4")
                data = memoryview(expand(stream, rules, lengths.astype(np.int64), shard["vocabulary"]).astype("<u4").tobytes())
                sizes = np.array(row["sizes"][0].values)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_pydict(
                    {
                        key: row[key][0].values,
                        "start": pa.array(starts[shard["part"]] + shard["first"] + ends - sizes, pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()),
                        "ids": pa.array([bytes(data[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), sizes.tolist())], pa.binary()),
                    }
                )

    columns = files.select("part", "first", "vocabulary", "width", "stream", "rules", "lengths", "sizes", key)
    return columns.mapInArrow(run, f"`{key}` {kind}, start long, n_tokens long, ids binary")
