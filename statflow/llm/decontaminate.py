"""Benchmark decontamination with an Aho-Corasick automaton.

Items of the benchmark are normalised to words and cut into windows of ``WINDOW`` consecutive
words; an item with fewer words, but not none, is one window.  All windows form one automaton.
A document is normalised in the same way and scanned once; offsets are mapped back to the text.

The automaton is bounded by ``AUTOMATON_BYTES`` of windows.  A larger benchmark is split into
that many automata, and the documents pass through them one after the other, without a shuffle.

Defined results: NULL or empty text, or text without words, has no words and no hits; items
without words or with a NULL id have no windows; a window of several items counts for each of
them; overlapping windows hit the union of their words; repeated rows each keep their row; an
empty benchmark leaves every document clean.  Other columns are kept; columns of the same names
as the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import pass_through, schema_with
from statflow.llm.words import fold, word_spans

WINDOW = 10
AUTOMATON_BYTES = 2 << 20
RESULTS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hits array<struct<start:long,end:long>>"
_FOUND = "array<struct<first:long,last:long,item:string>>"
_FOUND_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("item", pa.string())]))
_HITS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``shard, window, items``: each normalised window once, with the ids of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for name, one in zip(batch[item].to_pylist(), batch[text].to_pylist()):
                words = fold((one or "").encode()).split()
                for at in range(max(1, len(words) - WINDOW + 1) if words else 0):
                    ids.append(name)
                    found.append(b" ".join(words[at : at + WINDOW]).decode())
            yield pa.RecordBatch.from_pydict({"item": pa.array(ids, pa.string()), "window": pa.array(found, pa.string())})

    known = benchmark.select(F.col(item).cast("string").alias(item), text).where(f"{item} is not null and {text} is not null")
    cut = known.mapInArrow(run, "item string, window string")
    return cut.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``docs`` with ``RESULTS``; ``hits`` are the runs of hit words as code points of the text."""
    context = docs.sparkSession.sparkContext
    names = [name for name in docs.columns if name not in {part.split()[0] for part in RESULTS.split(", ")}]
    held = windows(benchmark, item)
    size = held.agg(F.coalesce(F.sum(F.octet_length("window") + 20 * F.size("items")), F.lit(0))).first()[0]
    shards = -(-size // limit) or 1
    out = docs.select(*names, F.lit(None).cast(_FOUND).alias("__found"))
    for shard in range(shards):
        mine = held.where(F.pmod(F.xxhash64("window"), F.lit(shards)) == shard)
        # bounded: about ``limit`` bytes
        patterns = context.broadcast([(row.window, row.items) for row in mine.collect()])
        last = shard + 1 == shards
        schema = schema_with(docs.select(*names), RESULTS if last else f"__found {_FOUND}")
        out = out.mapInArrow(_scanner(patterns, names, text, last), schema)
    return out


def _automaton(patterns: list) -> ahocorasick.Automaton | None:
    """Over bytes read as Latin-1, so that offsets are those of UTF-8; windows are closed by spaces."""
    if not patterns:
        return None
    machine = ahocorasick.Automaton()
    for window, items in patterns:
        machine.add_word(f" {window} ".encode().decode("latin-1"), (window.count(" ") + 1, items))
    machine.make_automaton()
    return machine


def _scanner(patterns, names: list[str], text: str, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(patterns.value)
        for batch in batches:
            rows = []
            for one, before in zip(batch[text], batch["__found"]):
                one, before = one.as_py(), before.as_py() or []
                words = fold((one or "").encode()).split()
                found = before + (_occurrences(machine, words) if machine and words else [])
                rows.append(_summary(one, len(words), found) if last else found)
            if not last:
                yield pass_through(batch, names, __found=pa.array(rows, _FOUND_ARROW))
                continue
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), _HITS_ARROW)
            new = {part.split()[0]: pa.array(values, kind) for part, values, kind in zip(RESULTS.split(", "), columns, kinds)}
            yield pass_through(batch, names, **new)

    return run


def _occurrences(machine, words: list[bytes]) -> list[dict]:
    """Windows in a document: numbers of the first and last word, and the item."""
    line = b" " + b" ".join(words) + b" "
    found, spaces, counted = [], 0, 0
    for end, (length, items) in machine.iter(line.decode("latin-1")):
        spaces += line.count(b" ", counted, end)
        counted = end
        found += [{"first": spaces - length, "last": spaces - 1, "item": item} for item in items]
    return found


def _summary(text: str | None, count: int, found: list[dict]) -> tuple:
    items = sorted({one["item"] for one in found})
    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
    if not found:
        return count, 0, 0, digest, False, []
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, [one["first"] for one in found], 1)
    np.add.at(change, [one["last"] + 1 for one in found], -1)
    hit = np.cumsum(change[:-1]) > 0
    data = text.encode()
    starts, ends = word_spans(data)
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # code points up to and with each byte
    spans = [
        {"start": int(points[starts[first]]) - 1, "end": int(points[ends[after - 1] - 1])}
        for first, after in zip(edges[::2], edges[1::2])
    ]
    return count, int(hit.sum()), len(items), digest, True, spans
