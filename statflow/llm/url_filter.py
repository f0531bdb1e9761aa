"""URL filters: host and path rules as nested intervals, applied in one sorted sweep.

A rule names a host and a path.  It fits that host and all its subdomains if the path of the
URL starts with the rule's path.  The canonical key of a host is its labels in reverse order,
each closed by U+0001, so a host and its subdomains lie in one interval of sorted keys and the
intervals of any two hosts are either nested or apart.

The sweep is a sort-merge range join.  Keys are cut into ranges by a bounded sample; a URL goes
to the range of its key, a rule to every range its interval touches.  A key so frequent that
several cuts are equal is spread over the ranges between them.  In each range rows are sorted
by key and read once, with a stack of the rules whose interval holds the current key.

Defined results: a NULL URL, or one without ``://``, has host and path ``''`` and gets the
default verdict with a NULL rule.  Rules with the same host and path keep the smallest verdict.
Of the rules that fit, the one with the longest ``host + path`` wins, then the longer host.
Repeated URLs each keep their row.  An empty rule table gives every URL the default verdict.
Other columns of the input are kept; those named ``host, path, rule, verdict`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import pass_through, schema_with

END = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    found = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by U+0001; ``''`` for no host."""
    labels = F.array_join(F.reverse(F.split(host, "[.]")), "\u0001")
    return F.when(host == "", "").otherwise(F.concat(labels, F.lit("\u0001")))


def judge(
    urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", ranges: int = 0, sample: int = 50
) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``.

    rules: ``host, path, verdict``.  ranges: number of key ranges, by default the number of
    shuffle partitions.  sample: sampled keys per range, which bounds what the driver sees.
    """
    ranges = ranges or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [name for name in urls.columns if name not in ADDED]
    keyed = urls.select(*own, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    key = F.concat(host_key(F.col("host")), F.lit("\u0000"), "path")
    keyed = keyed.withColumns({"__key": key, "__to": key, "__verdict": F.lit(None).cast("string")})

    held = rules.where("host <> '' and path is not null").groupBy("host", "path")
    held = held.agg(F.min("verdict").alias("__verdict")).withColumn("__key", host_key(F.col("host")))
    held = held.withColumn("__to", F.concat("__key", F.lit(END)))
    held = held.select(*[F.lit(None).cast(keyed.schema[name].dataType).alias(name) for name in own], "host", "path", "__key", "__to", "__verdict")

    cuts = _cuts(keyed.select("__key"), ranges, sample)
    schema = schema_with(keyed, "__kind int, __part int")
    placed = keyed.mapInArrow(_place(cuts, 1), schema).unionByName(held.mapInArrow(_place(cuts, 0), schema))
    # a rule precedes the keys of its interval, an outer rule an inner one
    laid = placed.repartition(ranges, "__part").sortWithinPartitions("__part", "__key", "__kind")
    kept = [*own, "host", "path"]
    return laid.mapInArrow(_sweep(kept, default), schema_with(keyed.select(*kept), "rule string, verdict string"))


def _cuts(keys: DataFrame, ranges: int, sample: int) -> list[str]:
    """At most ``ranges - 1`` sorted keys that split the rows evenly; equal ones mark a frequent key."""
    wanted, rows = ranges * sample, keys.count()
    drawn = keys.sample(fraction=min(1.0, wanted / max(rows, 1)), seed=7).limit(2 * wanted)
    drawn = sorted(row[0] for row in drawn.collect())
    return [drawn[len(drawn) * n // ranges] for n in range(1, ranges)] if drawn else []


def _place(cuts: list[str], kind: int):
    """Adds the range: one of those a URL's key may lie in, all that a rule's interval touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, turn = np.array(cuts, dtype=object), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            low = np.searchsorted(bounds, np.array(batch["__key"].to_pylist(), dtype=object), "left")
            high = np.searchsorted(bounds, np.array(batch["__to"].to_pylist(), dtype=object), "right")
            if kind:  # rows of a key that holds several cuts take turns
                part = low + (turn + np.arange(len(low))) % (high - low + 1)
                turn += len(low)
            else:
                part = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)])
                batch = batch.take(pa.array(np.repeat(np.arange(len(low)), high - low + 1)))
            kinds = pa.array(np.full(len(part), kind, np.int32))
            yield pass_through(batch, batch.schema.names, __kind=kinds, __part=part.astype(np.int32))

    return run


def _sweep(kept: list[str], default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # of (end of the interval, host, lengths of its paths, verdict of each path)
        for batch in batches:
            wanted = ("__part", "__key", "__kind", "host", "path", "__to", "__verdict")
            keep, rules, verdicts = [], [], []
            for at, (where, key, kind, host, path, to, verdict) in enumerate(
                zip(*(batch[name].to_pylist() for name in wanted))
            ):
                if where != part:
                    part, stack = where, []
                while stack and stack[-1][0] < key:
                    stack.pop()
                if kind:
                    rule, found = _winner(stack, path) or (None, default)
                    keep.append(at)
                    rules.append(rule)
                    verdicts.append(found)
                    continue
                if not stack or stack[-1][1] != host:
                    stack.append((to, host, [], {}))
                lengths, known = stack[-1][2:]
                known[path] = verdict
                lengths[:] = sorted({*lengths, len(path)}, reverse=True)
            yield pass_through(
                batch.take(pa.array(keep, pa.int64())), kept,
                rule=pa.array(rules, pa.string()), verdict=pa.array(verdicts, pa.string()),
            )

    return run


def _winner(stack: list, path: str) -> tuple[str, str] | None:
    """The longest fitting rule and its verdict: each level of the stack offers its longest path."""
    best = None
    for _, host, lengths, known in stack:
        length = next((n for n in lengths if path[:n] in known), None)
        if length is not None and (best is None or len(host) + length >= best[0]):
            best = (len(host) + length, host + path[:length], known[path[:length]])
    return best and best[1:]
