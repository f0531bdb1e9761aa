"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree.

Vectors get one more component that makes all norms equal to the largest one, so the largest inner
product is the smallest distance.  The tree is fitted on a bounded sample and every row is put into
its leaf.  A query walks the tree best bin first with a priority queue.  How many leaves it visits
is calibrated: for a bounded set of test queries the true neighbours are found by brute force over
all rows, and visits are widened until the mean recall reaches ``recall``.

Rows of a leaf and the queries that visit it meet in blocks of bounded size (a leaf may hold a third
of all rows: equal vectors share a leaf), and each block keeps the best of each query.

Defined results: vectors that are NULL, zero, hold a NULL or non-finite component, or have another
number of components than most, take no part.  Rows with the id of the query are its own.  Repeated
candidates count each; of repeated queries the smallest vector is taken.  Equal scores go to the
smaller id.  With fewer candidates than wanted all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import pass_through, schema_with, stored

#: Rows the tree is fitted on, test queries, most leaves, children of a node.
FIT_ROWS, TESTS, MOST_LEAVES, CHILDREN, ROUNDS = 20_000, 200, 16_384, 12, 8
#: Rows and queries that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096
#: The share of the leaves, one in so many, that is visited before the others.
FIRST = 8
_FLOATS = "array<float>"


def taking_part(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` of the vectors that take part."""
    known = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(_FLOATS).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = known.where("id is not null and vector is not null").where(finite & F.exists("vector", lambda x: x != 0))
    sizes = known.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return known.where(F.size("vector") == (sizes["size"] if sizes else 0))


class Tree:
    """Nodes as arrays: centre, first child and number of children; a leaf has none."""

    def __init__(self, points: np.ndarray, leaves: int, seed: int = 5) -> None:
        self.random = np.random.default_rng(seed)
        self.centres, self.children, self.leaf = [points.mean(0) if len(points) else np.zeros(1)], [()], [-1]
        self.leaves = 0
        self._split(0, points, leaves)
        self.matrix = np.array(self.centres)
        self.half = (self.matrix**2).sum(1) / 2
        self.random = None

    def _split(self, node: int, points: np.ndarray, leaves: int) -> None:
        parts = min(CHILDREN, leaves)
        owner, centres = _kmeans(points, parts, self.random) if parts > 1 and len(points) > parts else (None, ())
        if len(centres) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return
        first = len(self.centres)
        self.children[node] = range(first, first + len(centres))
        for centre in centres:
            self.centres.append(centre)
            self.children.append(())
            self.leaf.append(-1)
        for at in range(len(centres)):
            mine = points[owner == at]
            self._split(first + at, mine, max(1, round(leaves * len(mine) / len(points))))

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: the nearest child, level by level."""
        out = np.zeros(len(points), np.int32)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            kids = self.children[node]
            if not len(kids):
                out[rows] = self.leaf[node]
                continue
            owner = np.argmax(points[rows] @ self.matrix[kids.start : kids.stop].T - self.half[kids.start : kids.stop], 1)
            waiting += [(kid, rows[owner == at]) for at, kid in enumerate(kids) if (owner == at).any()]
        return out

    def visits(self, queries: np.ndarray, most: int) -> list[list[int]]:
        """The first ``most`` leaves of each query, best bin first."""
        near = queries @ self.matrix.T - self.half
        out = []
        for scores in near:
            heap, found = [(-scores[0], 0)], []
            while heap and len(found) < most:
                node = heapq.heappop(heap)[1]
                if self.leaf[node] >= 0:
                    found.append(self.leaf[node])
                for kid in self.children[node]:
                    heapq.heappush(heap, (-scores[kid], kid))
            out.append(found)
        return out


def _kmeans(points: np.ndarray, parts: int, random) -> tuple[np.ndarray, np.ndarray]:
    centres = points[random.choice(len(points), parts, replace=False)]
    for _ in range(ROUNDS):
        owner = np.argmax(points @ centres.T - (centres**2).sum(1) / 2, 1)
        used = np.unique(owner)
        centres = np.array([points[owner == at].mean(0) for at in used])
    owner = np.argmax(points @ centres.T - (centres**2).sum(1) / 2, 1)
    used, owner = np.unique(owner, return_inverse=True)
    return owner, centres[used]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long vectors in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _wide(points: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm**2 - (points**2).sum(1), 0))
    return np.column_stack([points, rest])


def best(query: np.ndarray, own: int, ids: np.ndarray, points: np.ndarray, scores: np.ndarray, count: int, least: float) -> list[tuple[int, float]]:
    """The ``count`` best of a block for one query, at least ``least``: ids and exact scores."""
    fit = np.flatnonzero((scores >= least) & (ids != own))
    if len(fit) > count:
        edge = np.partition(scores[fit], len(fit) - count)[len(fit) - count]
        fit = fit[scores[fit] >= edge - 1e-9 * (1 + abs(edge))]
    exact = (points[fit] * query).sum(1)  # the same order of sums for equal vectors
    order = np.lexsort((ids[fit], -exact))[:count]
    return list(zip(ids[fit][order].tolist(), exact[order].tolist()))


def search(rows: DataFrame, queries: DataFrame, key: str, vector: str, count: int = 20, recall: float = 0.95) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each query among all ``rows``."""
    context = rows.sparkSession.sparkContext
    known = stored(taking_part(rows, key, vector), "vectors")
    asked = taking_part(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    total, norm2 = known.agg(F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    if not total:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = float(norm2) ** 0.5
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").toArrow()
    tree = Tree(_wide(matrix(drawn["vector"]), norm), min(MOST_LEAVES, max(1, round(total**0.5))))
    shared = context.broadcast(tree)  # at most MOST_LEAVES leaves

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.place(_wide(matrix(batch["vector"]), norm)) if batch.num_rows else np.zeros(0, np.int32)
            yield pass_through(batch, ["id", "vector"], leaf=pa.array(leaf, pa.int32()))

    placed = stored(known.mapInArrow(place, schema_with(known, "leaf int")), "leaves")
    tests = asked.orderBy(F.xxhash64("id"), "id").limit(TESTS).toArrow()
    most = _calibrate(placed, tree, matrix(tests["vector"]), tests["id"].to_numpy(), count, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch["vector"])
            leaves = shared.value.visits(np.column_stack([vectors, np.zeros(len(vectors))]), most)
            counts = [len(found) for found in leaves]
            yield pass_through(
                batch.take(pa.array(np.repeat(np.arange(len(vectors)), counts))), ["id", "vector"],
                leaf=pa.array(np.concatenate(leaves), pa.int32()),
                turn=pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int32()),
            )

    visits = stored(asked.mapInArrow(visit, "id long, vector array<float>, leaf int, turn int"), "visits")
    # the first leaves set a score that rows of the others have to reach
    start = max(1, most // FIRST)
    first = visits.where(F.col("turn") < start).withColumn("least", F.lit(float("-inf")))
    found = stored(_ranked(_meet(placed, first, count), "query_id", "vec_id", count), "found")
    edge = found.where(F.col("rank") == count).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    rest = visits.where(F.col("turn") >= start).join(edge, "id", "left").fillna(float("-inf"), ["least"])
    both = _meet(placed, rest, count).unionByName(found.drop("rank"))
    return _ranked(both, "query_id", "vec_id", count).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, query: str, key: str, count: int) -> DataFrame:
    order = f"row_number() over (partition by {query} order by score desc, {key})"
    return found.withColumn("rank", F.expr(order)).where(F.col("rank") <= count)


def _meet(placed: DataFrame, visits: DataFrame, count: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of each query in each block of a leaf that it visits."""
    # one row for each leaf: how many blocks its rows and its queries make
    shares = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("r"))
    asked_of = visits.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("q"))
    shares = F.broadcast(shares.join(asked_of, "leaf"))
    own_part = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    all_parts = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = placed.join(shares, "leaf").withColumn("at", own_part("r")).withColumn("of", all_parts("q")).drop("r", "q")
    right = visits.join(shares, "leaf").withColumn("of", own_part("q")).withColumn("at", all_parts("r")).drop("r", "q")

    def meet(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asking.num_rows:
            points, ids = matrix(candidates["vector"]), candidates["id"].to_numpy()
            vectors, own = matrix(asking["vector"]), asking["id"].to_numpy()
            for start in range(0, len(own), 256):
                near = vectors[start : start + 256] @ points.T
                for scores, query, mine, least in zip(near, vectors[start:], own[start:], asking["least"].to_numpy()[start:]):
                    found += [(mine, *one) for one in best(query, mine, ids, points, scores, count, least)]
        query_id, vec_id, score = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(query_id, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.float64())})

    by = ("leaf", "at", "of")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, "query_id long, vec_id long, score double")

def _calibrate(placed: DataFrame, tree: Tree, vectors: np.ndarray, own: np.ndarray, count: int, recall: float) -> int:
    """How many leaves to visit so that the mean recall of the test queries reaches ``recall``."""
    if not len(own):
        return 1
    shared = placed.sparkSession.sparkContext.broadcast((vectors, own))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, own = shared.value
        kept: list[list] = [[] for _ in own]
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids, leaf = matrix(batch["vector"]), batch["id"].to_numpy(), batch["leaf"].to_numpy()
            leaves = dict(zip(ids.tolist(), leaf.tolist()))
            for at, scores in enumerate(vectors @ points.T):
                new = [(-score, one, leaves[one]) for one, score in best(vectors[at], own[at], ids, points, scores, count, -np.inf)]
                kept[at] = sorted(kept[at] + new)[:count]
        rows = [(at, -score, one, leaf) for at, found in enumerate(kept) for score, one, leaf in found]
        at, score, one, leaf = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_pydict(
            {"test": pa.array(at, pa.int32()), "score": pa.array(score, pa.float64()), "id": pa.array(one, pa.int64()), "leaf": pa.array(leaf, pa.int32())}
        )

    nearest = placed.mapInArrow(brute, "test int, score double, id long, leaf int")
    nearest = _ranked(nearest, "test", "id", count)
    order_of = [{leaf: place for place, leaf in enumerate(found)} for found in tree.visits(np.column_stack([vectors, np.zeros(len(own))]), tree.leaves)]
    places: list[list[int]] = [[] for _ in own]
    for row in nearest.select("test", "leaf").collect():  # TESTS times ``count`` rows
        places[row.test].append(order_of[row.test][row.leaf])
    places = [found for found in places if found]
    for most in range(1, tree.leaves + 1):
        if np.mean([np.mean(np.array(found) < most) for found in places] or [1]) >= recall:
            return most
    return tree.leaves  # all
