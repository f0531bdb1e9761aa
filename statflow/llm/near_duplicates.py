"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

1. Equal texts (by a 128-bit hash) form one class each; only one text of each goes on.
2. A text is a set of shingles of five words, each with a weight: its frequency in the text, damped,
   times the inverse document frequency.  Document frequencies are counted over all texts in hashed
   cells, a table of fixed size.  The inverse frequency is held between 1 and ``1 + RARE``, because
   in a large group of copies the shared shingles are frequent and the edits rare.
3. ``BANDS * ROWS`` consistent samples of the weighted set make ``BANDS`` keys.  Texts that share a
   key are candidates.
4. In each bucket every text is compared with one pivot, not with all others.  Where the texts of a
   bucket are then not all in one class, those outside its largest class are compared with all texts
   of the bucket, in cells of bounded size, each by an inverted index of its own shingles: no link
   between different classes is lost.
5. A pair is a link if its weighted Jaccard similarity, or that of the plain sets, is at least 0.8.
6. Links are joined to classes by passing smallest ids along links and over labels.

Defined results: a NULL text is a class of its own; equal texts share a class also when empty or
shorter than five words; texts of one to four words have one shingle, all their words; texts without
words are only compared for equality.  A class is named by its smallest id, which is the one to
keep.  Repeated rows belong to one class; of different texts under one id one is compared.  Rows
with a NULL id join the class of an equal text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import blocks, pass_through, schema_with, stored
from statflow.llm.words import hashed_words, mix

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 12, 3
#: Cells in which document frequencies are counted, parts in which they travel, the spread of weights.
CELL_BITS, PARTS, RARE = 18, 16, 0.25
#: Texts of a bucket that meet in one cell, on either side.
CELL = 512
#: Bytes of text and shingles that are worked on at once.
TEXT_BYTES, BLOCK = 1 << 19, 1 << 13


# --- shingles and weights ---------------------------------------------------------------------


def shingles(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each text, as sorted 64-bit hashes, and how often each occurs."""
    data = [(text or "").encode() for text in texts]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for first, after in blocks(map(len, data), TEXT_BYTES):
        words, counts = hashed_words(data[first:after])
        turned = [mix(words + np.uint64(0x9E3779B97F4A7C15 * (place + 1) & (2**64 - 1))) for place in range(WORDS)]
        size = max(0, len(words) - WORDS + 1)
        runs = np.zeros(size, np.uint64)
        for place in range(WORDS):
            runs += turned[place][place : place + size]
        runs = mix(runs)
        ends = np.cumsum(counts)
        for end, count in zip(ends.tolist(), counts.tolist()):
            start = end - count
            if count >= WORDS:
                found = runs[start : end - WORDS + 1]
            elif count:
                found = mix(sum(turned[place][start + place : start + place + 1] for place in range(count)) + np.uint64(count))
            else:
                found = runs[:0]
            out.append(np.unique(found, return_counts=True))
    return out


def cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Documents whose shingles fall into each cell: a table of fixed size over all rows."""
    width = (1 << CELL_BITS) // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            sets = [found for found, _ in shingles(batch[text].to_pylist())]
            if sets:
                total += np.bincount(cells(np.concatenate(sets)), minlength=len(total))
        yield _parts(total, width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(data, np.int64)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(list(sums), pa.int32()), "counts": pa.array([one.tobytes() for one in sums.values()], pa.binary())}
        )

    partial = docs.select(text).mapInArrow(count, "part int, counts binary")
    rows = partial.repartition(PARTS, "part").mapInArrow(add, "part int, counts binary").collect()
    total = np.zeros((PARTS, width), np.int64)
    for row in rows:
        total[row.part] += np.frombuffer(row.counts, np.int64)
    return total.ravel()


def _parts(total: np.ndarray, width: int) -> pa.RecordBatch:
    numbers = pa.array(range(PARTS), pa.int32())
    data = pa.array([total[at * width : (at + 1) * width].tobytes() for at in range(PARTS)], pa.binary())
    return pa.RecordBatch.from_pydict({"part": numbers, "counts": data})


def rarity(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """The factor of each cell, from 1 for a cell of all documents to ``1 + RARE`` for a usual one."""
    used = frequencies[frequencies > 0]
    usual = np.log(max(2.0, documents / max(1.0, float(np.median(used)) if len(used) else 1.0)))
    inverse = np.log(np.maximum(documents, 1) / np.maximum(frequencies, 1))
    return (1 + RARE * np.clip(inverse / usual, 0, 1)).astype(np.float32)


def weights(found: np.ndarray, times: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return (1 + np.log(times)).astype(np.float32) * factor[cells(found)]


# --- consistent weighted samples ---------------------------------------------------------------


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), their inverse, and their logarithm: two uniform bytes draw one."""
    grid = np.concatenate([[0], np.geomspace(1e-4, 40, 200_000)])
    below = 1 - (1 + grid) * np.exp(-grid)
    gamma = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), below, grid)
    return gamma.astype(np.float32), (1 / gamma).astype(np.float32), np.log(gamma).astype(np.float32)


GAMMA, INVERSE, LOGARITHM = _tables()
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def samples(found: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each set (they begin at ``starts`` and are not empty) the hash of every consistent sample.

    A sample is the shingle k with the least ``ln a = ln c - r (t - b + 1)``, where
    ``t = floor(ln w / r + b)``, r and c are Gamma(2, 1) and b is uniform, all drawn by shingle."""
    out = np.full((len(starts), len(_SEEDS)), np.iinfo(np.uint64).max, np.uint64)
    log_weight = np.log(weight)
    for begin in range(0, len(found), BLOCK):
        end = min(begin + BLOCK, len(found))
        first, last = np.searchsorted(starts, begin, "right") - 1, np.searchsorted(starts, end, "left")
        cuts = np.maximum(starts[first:last], begin) - begin
        log_part, part = log_weight[begin:end], found[begin:end]
        for k, seed in enumerate(_SEEDS):
            drawn = (part ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
            drawn ^= drawn >> np.uint64(29)
            drawn *= np.uint64(0x94D049BB133111EB)
            drawn ^= drawn >> np.uint64(32)
            low = drawn & np.uint64(0xFFFF)
            r = GAMMA[low]
            b = ((drawn >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
            t = np.floor(log_part * INVERSE[low] + b)
            a = LOGARITHM[(drawn >> np.uint64(16)) & np.uint64(0xFFFF)] - r * (t - b + 1)
            bits = a.view(np.int32)
            key = (bits ^ ((bits >> 31) | np.int32(-(2**31)))).view(np.uint32).astype(np.uint64) << np.uint64(32)
            key |= ((drawn >> np.uint64(24)) + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
            out[first:last, k] = np.minimum(out[first:last, k], np.minimum.reduceat(key, cuts))
    return out & np.uint64(0xFFFFFFFF)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, from the samples in it."""
    rows = found.reshape(len(found), BANDS, ROWS)
    keys = np.zeros(rows.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for at in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, at])
    return keys


def signatures(docs: DataFrame, key: str, text: str, factor: np.ndarray) -> DataFrame:
    """``key, hash, bands``: the hash of the text and its band keys; a text without words has no bands."""
    shared = docs.sparkSession.sparkContext.broadcast(factor)  # of fixed size

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingles(batch[text].to_pylist())
            sizes = np.array([len(found) for found, _ in sets], np.int64)
            full = np.flatnonzero(sizes)
            bands: list = [None] * len(sets)
            if len(full):
                found = np.concatenate([sets[at][0] for at in full])
                times = np.concatenate([sets[at][1] for at in full])
                starts = np.cumsum(sizes[full]) - sizes[full]
                keys = band_keys(samples(found, weights(found, times, shared.value), starts)).view(np.int64)
                for at, one in zip(full.tolist(), keys):
                    bands[at] = one
            yield pass_through(batch, [key, "hash"], bands=pa.array(bands, pa.list_(pa.int64())))

    hashed = docs.select(key, F.md5(text).alias("hash"), text)
    return hashed.mapInArrow(sign, schema_with(hashed.select(key, "hash"), "bands array<long>"))


# --- links -------------------------------------------------------------------------------------


def similarities(pairs: DataFrame, factor: np.ndarray) -> DataFrame:
    """``a, b, weighted, plain`` of ``a, b, text_a, text_b``."""
    shared = pairs.sparkSession.sparkContext.broadcast(factor)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                left, right = shingles(part["text_a"].to_pylist()), shingles(part["text_b"].to_pylist())
                found += [_similar(one, other, shared.value) for one, other in zip(left, right)]
            weighted, plain = zip(*found) if found else ((), ())
            yield pass_through(batch, ["a", "b"], weighted=pa.array(weighted, pa.float64()), plain=pa.array(plain, pa.float64()))

    return pairs.mapInArrow(compare, "a long, b long, weighted double, plain double")


def _similar(left: tuple, right: tuple, factor: np.ndarray) -> tuple[float, float]:
    if not len(left[0]) or not len(right[0]):
        return 0.0, 0.0
    at = np.minimum(np.searchsorted(right[0], left[0]), len(right[0]) - 1)
    common = right[0][at] == left[0]
    one, other = weights(*left, factor), weights(*right, factor)
    shared = np.minimum(one[common], other[at[common]]).sum(dtype=np.float64)
    total = one.sum(dtype=np.float64) + other.sum(dtype=np.float64) - shared
    count = int(common.sum())
    return float(shared / total), count / (len(left[0]) + len(right[0]) - count)


LINKED = f"weighted >= {SIMILAR} or plain >= {SIMILAR}"


def links(bands: DataFrame, docs: DataFrame, key: str, text: str, factor: np.ndarray) -> DataFrame:
    """``a, b`` of similar texts among those of ``bands`` (``id, bucket``), enough to join all that belong together."""
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("id", F.xxhash64("id", "bucket")).alias("pivot")).where("n > 1")
    buckets = stored(bands.join(shared, "bucket").select("bucket", "id", "pivot", "n"), "buckets")
    # only texts that share a bucket are compared
    sources = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).dropDuplicates(["id"])
    sources = stored(sources.join(buckets.select("id").distinct(), "id", "left_semi"), "texts")
    asked = buckets.where("id <> pivot").select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b")).distinct()
    left = asked.join(sources.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    both = left.join(sources.withColumnsRenamed({"id": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    stars = stored(similarities(both, factor).where(LINKED).select("a", "b"), "stars")
    rest = _unsettled(buckets.where("n > 2"), components(stars))
    met = rest.join(sources, "id")
    more = met.groupBy("bucket", "asking", "asked").applyInArrow(_cell(factor), "a long, b long")
    return stars.unionByName(stored(more, "cells"))


def _unsettled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets whose texts are not all in one class yet, dealt out to cells of bounded size.

    Texts outside the largest class of a bucket ask all others: each block of those that ask meets
    each block of all texts.  ``bucket, asking, asked, id, label, asks``."""
    named = buckets.select("bucket", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    counted = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    split = counted.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    split = split.where("most < all").select(
        "bucket", "largest", F.ceil(F.col("all") / CELL).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("most")) / CELL).cast("int").alias("askers"),
    )
    rows = stored(named.join(split, "bucket").withColumn("asks", F.col("label") != F.col("largest")), "unsettled")
    block = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    asked = rows.withColumns({"asked": block("blocks"), "asks": F.lit(False)}).withColumn("asking", every("askers"))
    asking = rows.where("asks").withColumn("asking", block("askers")).withColumn("asked", every("blocks"))
    columns = ("bucket", "asking", "asked", "id", "label", "asks")
    return asked.select(*columns).unionByName(asking.select(*columns))


def _cell(factor: np.ndarray):
    """Links from the asking texts of a cell to texts of other classes, through an inverted index of its shingles."""

    def meet(rows: pa.Table) -> pa.Table:
        ids, labels = rows["id"].to_pylist(), rows["label"].to_pylist()
        asks = np.array(rows["asks"].to_pylist(), bool)
        sets = shingles(rows["text"].to_pylist())
        sizes = np.array([len(found) for found, _ in sets])
        weight = [weights(*one, factor).astype(np.float64) for one in sets]
        total = np.array([one.sum() for one in weight])
        held = np.flatnonzero(~asks)
        owner = np.repeat(held, sizes[held])
        flat = np.concatenate([sets[at][0] for at in held]) if len(held) else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        posted = np.concatenate([weight[at] for at in held])[order] if len(held) else np.zeros(0)
        parent: dict[int, int] = {}
        found = []
        for at in np.flatnonzero(asks):
            first, last = np.searchsorted(flat, sets[at][0], "left"), np.searchsorted(flat, sets[at][0], "right")
            count = last - first
            after = np.cumsum(count)
            places = np.repeat(first - after + count, count) + np.arange(after[-1] if len(after) else 0)
            near = owner[places]
            common = np.bincount(near, minlength=len(ids))
            least = np.bincount(near, np.minimum(posted[places], np.repeat(weight[at], count)), len(ids))
            plain = common / np.maximum(1, sizes[at] + sizes - common)
            weighted = least / np.maximum(1e-9, total[at] + total - least)
            for other in np.flatnonzero((plain >= SIMILAR) | (weighted >= SIMILAR)).tolist():
                one, two = _root(parent, labels[at]), _root(parent, labels[other])
                if one != two:
                    parent[max(one, two)] = min(one, two)
                    found.append((min(ids[at], ids[other]), max(ids[at], ids[other])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return meet


def _root(parent: dict[int, int], label: int) -> int:
    while label in parent:
        label = parent[label]
    return label


# --- classes -----------------------------------------------------------------------------------


def components(pairs: DataFrame) -> DataFrame:
    """``id, label``: the smallest id each id of ``a, b`` is connected to."""
    edges = stored(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    before = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        before = total
        spread = edges.join(labels.withColumnRenamed("id", "a"), "a").groupBy(F.col("b").alias("id")).agg(F.min("label").alias("seen"))
        nearer = labels.join(spread, "id").select("id", F.least("label", "seen").alias("label"))
        # a label is an id itself: take over its label
        beyond = nearer.select(F.col("id").alias("label"), F.col("label").alias("beyond"))
        labels = stored(nearer.join(beyond, "label").select("id", F.least("label", "beyond").alias("label")), "labels")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, cluster_id, copies, cluster_size, kept``, one row for each row of ``docs``.

    copies: rows with an equal text.  kept: whether the id is that of the class."""
    factor = rarity(document_frequencies(docs, text), docs.count())
    signed = stored(signatures(docs, key, text, factor), "signatures")
    equal = signed.where("hash is not null").groupBy("hash").agg(F.min(key).alias("id"), F.count("*").alias("copies"), F.min_by("bands", key).alias("bands"))
    equal = stored(equal, "equal")
    # one text of each class of equal ones
    bands = stored(equal.where("id is not null").select("id", F.explode("bands").alias("bucket")), "bands")
    labels = components(links(bands, docs, key, text, factor))
    named = equal.join(labels, "id", "left").select("hash", "copies", F.coalesce("label", "id").alias("cluster_id"))
    sizes = named.groupBy("cluster_id").agg(F.sum("copies").alias("cluster_size"))
    known = signed.select(key, "hash").join(named, "hash", "left").withColumn("cluster_id", F.coalesce("cluster_id", key))
    known = known.join(sizes, "cluster_id", "left")
    one = F.lit(1).cast("long")
    return known.select(
        key, "cluster_id", F.coalesce("copies", one).alias("copies"), F.coalesce("cluster_size", one).alias("cluster_size"),
        F.col(key).eqNullSafe(F.col("cluster_id")).alias("kept"),
    )
