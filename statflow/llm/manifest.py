"""A Merkle manifest of a dataset whose parents keep the hash states before each child slot.

Each row is a leaf, each group of rows (a language) a tree of parents with up to ``ARITY`` children,
and the groups' subroots are the leaves of one more tree, which gives the root.  A node is the hex
SHA-256 of its children's hex digests, and a hex digest is as long as one block of that hash.  So the
state before child ``n`` is what the compression function gives after ``n`` blocks: 32 bytes, which
the parent keeps.  To fold a replaced leaf, the state before its slot is resumed with the
replacement and the siblings to its right only; those to its left are never read again.

A tree is built in bands of ``STEPS`` levels.  Rows are numbered in their order (range
partitioning, no global window), and each run of ``ARITY ** STEPS`` of them is one group of a
shuffle, however many rows a language has.  The tops of the runs are the rows of the next band, so a
corpus of 10^11 rows takes three bands.  Folding goes down again: each run gets the path above it
(at most some KB), and finishes its own leaves with it.

Defined results: rows of a group ascend by the order column, NULL first, ties by digest, so equal
rows stand side by side and each is a leaf; a NULL group is a group of its own, before all others; a
lone leaf is its own subroot, a lone subroot the root; with no siblings anywhere the proof is the
hash of the empty text.  An empty table has no rows, and no root.  A NULL order column is no crc32,
so such a leaf is never tampered with.  Input columns beside those named are not read; none can
clash, because the results hold the order column and the results' own names alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stored
from statflow.plans.numbering import number_rows

#: Children of a parent, and levels that one group of a shuffle builds.
ARITY, STEPS = 8, 4
#: Digests that are compressed at once.
_LANES = 16384
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<state:binary,slot:int,left:binary,right:binary>>"
_PATH_ARROW = pa.list_(pa.struct([("state", pa.binary()), ("slot", pa.int32()), ("left", pa.binary()), ("right", pa.binary())]))
_PARENT = "key string, run long, level int, at long, digest binary, children int, states binary"


# --- SHA-256 on many messages at once ---------------------------------------------------------


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle - 1)
    return low


# the standard's constants: 32 bits after the point of square and cube roots of the first primes
_FIRST = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def first_states(count: int) -> np.ndarray:
    """``count`` states before anything is hashed, as rows of eight words."""
    return np.tile(_FIRST, (count, 1))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States after one more block of sixteen words each."""
    out = np.empty_like(states)
    for at in range(0, len(states), _LANES):
        out[at : at + _LANES] = _compress(states[at : at + _LANES].T, blocks[at : at + _LANES].T).T
    return out


def _compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    words = list(np.ascontiguousarray(blocks))
    for n in range(16, 64):
        far, near = words[n - 15], words[n - 2]
        small = _turn(far, 7) ^ _turn(far, 18) ^ (far >> np.uint32(3))
        large = _turn(near, 17) ^ _turn(near, 19) ^ (near >> np.uint32(10))
        words.append(words[n - 16] + small + words[n - 7] + large)
    a, b, c, d, e, f, g, h = np.ascontiguousarray(states)
    for n in range(64):
        chosen = g ^ (e & (f ^ g))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + chosen + _ROUND[n] + words[n]
        most = (a & b) | (c & (a | b))
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + most
        h, g, f, e, d, c, b, a = g, f, e, d + one, c, b, a, one + two
    return states + np.stack([a, b, c, d, e, f, g, h])


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of that many whole blocks, from the states after them."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(states, last)


def as_text(digests: np.ndarray) -> np.ndarray:
    """Digests of eight words as the sixteen words of their hex text: one block each."""
    return np.frombuffer(digests.astype(">u4").tobytes().hex().encode(), ">u4").astype(np.uint32).reshape(-1, 16)


def _words(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), ">u4").astype(np.uint32).reshape(-1, 8)


def _raw(digests: np.ndarray) -> list[bytes]:
    data = digests.astype(">u4").tobytes()
    return [data[at : at + 32] for at in range(0, len(data), 32)]


# --- one run of a tree -------------------------------------------------------------------------


def levels(size: int) -> int:
    """Levels above ``size`` nodes until one is left."""
    count = 0
    while size > 1:
        size, count = -(-size // ARITY), count + 1
    return count


def parents_of(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the parents of consecutive nodes, their numbers of children, and their states
    before each slot (slots without a child repeat the state after the last)."""
    count = -(-len(digests) // ARITY)
    children = np.minimum(ARITY, len(digests) - ARITY * np.arange(count))
    states = np.empty((count, ARITY, 8), np.uint32)
    now, texts = first_states(count), as_text(digests)
    for slot in range(ARITY):
        states[:, slot] = now
        mine = np.flatnonzero(children > slot)
        now[mine] = compress(now[mine], texts[mine * ARITY + slot])
    return finish(now, children), children, states


def resume(states: np.ndarray, slots: np.ndarray, children: np.ndarray, own: np.ndarray, siblings) -> np.ndarray:
    """Parents' digests with ``own`` at ``slots``: from the state before the slot, over the right siblings.

    ``siblings(rows, slot)`` gives the digests at a slot, for those rows only that have one there."""
    now = states.copy()
    for slot in range(ARITY):
        mine = np.flatnonzero((slots <= slot) & (slot < children))
        if len(mine):
            block = as_text(own[mine])
            right = np.flatnonzero(slots[mine] < slot)
            if len(right):
                block[right] = as_text(siblings(mine[right], slot))
            now[mine] = compress(now[mine], block)
    return finish(now, children)


def _grow(table: pa.Table, steps: int) -> pa.Table:
    """All parents of one run, level by level."""
    table = table.sort_by("pos")
    size, key, run = table["size"][0].as_py(), table["key"][0].as_py(), table["run"][0].as_py()
    nodes, out = _words(table["digest"].to_pylist()), []
    for level in range(1, min(steps, levels(size)) + 1):
        nodes, children, states = parents_of(nodes)
        kept = states.astype(">u4").tobytes()
        step = 32 * ARITY
        out += zip(range(len(nodes)), _raw(nodes), children.tolist(), (kept[n : n + step] for n in range(0, len(kept), step)), [level] * len(nodes))
    columns = list(zip(*out)) or [[], [], [], [], []]
    return pa.table(
        {
            "key": pa.array([key] * len(out), pa.string()),
            "run": pa.array([run] * len(out), pa.int64()),
            "level": pa.array(columns[4], pa.int32()),
            "at": pa.array(columns[0], pa.int64()),
            "digest": pa.array(columns[1], pa.binary()),
            "children": pa.array(columns[2], pa.int32()),
            "states": pa.array(columns[3], pa.binary()),
        }
    )


@dataclass
class _Run:
    """Nodes of one run by level, their parents' states, and the path above the run."""

    nodes: list[np.ndarray]
    children: list[np.ndarray]
    states: list[np.ndarray]
    path: list[dict]
    subroot: bytes | None

    @classmethod
    def read(cls, leaves: pa.Table, above: pa.Table) -> _Run:
        nodes, children, states = [_words(leaves["digest"].to_pylist())], [], []
        above = above.sort_by([("level", "ascending"), ("at", "ascending")])
        level = np.array(above["level"])
        for n in range(1, int(level.max()) + 1):
            rows = above.filter(pa.array(level == n))
            nodes.append(_words(rows["digest"].to_pylist()))
            children.append(np.array(rows["children"]))
            states.append(np.frombuffer(b"".join(rows["states"].to_pylist()), ">u4").astype(np.uint32).reshape(-1, ARITY, 8))
        top = above.filter(pa.array(level == 0)).to_pylist()[0]
        return cls(nodes, children, states, top["path"] or [], top["subroot"])

    def siblings(self, at: int) -> Iterator[tuple[bytes, int, bytes, bytes]]:
        """For each level above a leaf: state before its slot, slot, left and right siblings."""
        for n, states in enumerate(self.states):
            slot, parent = at % ARITY, at // ARITY
            raw = self.nodes[n].astype(">u4")
            first = parent * ARITY
            left, right = raw[first:at].tobytes(), raw[at + 1 : first + int(self.children[n][parent])].tobytes()
            yield states[parent, slot].astype(">u4").tobytes(), slot, left, right
            at = parent


def _descend(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """The path above each node of a run."""
    leaves = leaves.sort_by("pos")
    run = _Run.read(leaves, above)
    names = ("state", "slot", "left", "right")
    paths = [[*(dict(zip(names, step)) for step in run.siblings(at)), *run.path] for at in range(leaves.num_rows)]
    return pa.table(
        {
            "key": leaves["key"],
            "run": leaves["pos"],
            "path": pa.array(paths, _PATH_ARROW),
            "subroot": pa.array([run.subroot] * leaves.num_rows, pa.binary()),
        }
    )


def _proofs(run: _Run, count: int) -> list[str]:
    """Hash of the hex digests of all siblings on the way up, left to right."""
    above = b"".join(step["left"] + step["right"] for step in run.path).hex().encode()
    texts = [as_text(nodes).astype(">u4").tobytes() for nodes in run.nodes]
    out = []
    for at in range(count):
        proof = hashlib.sha256()
        for text, children in zip(texts, run.children):
            parent = at // ARITY
            first, after = parent * ARITY * 64, (parent * ARITY + int(children[parent])) * 64
            proof.update(text[first : at * 64])
            proof.update(text[(at + 1) * 64 : after])
            at = parent
        proof.update(above)
        out.append(proof.hexdigest())
    return out


def _fold(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """Roots with each leaf of a run replaced, one at a time, and the proofs of the leaves."""
    leaves = leaves.sort_by("pos")
    run, count = _Run.read(leaves, above), leaves.num_rows
    now = _words(leaves["replacement"].to_pylist())
    at = np.arange(count)
    for nodes, children, states in zip(run.nodes, run.children, run.states):
        slot, parent = at % ARITY, at // ARITY
        now = resume(states[parent, slot], slot, children[parent], now, lambda rows, n: nodes[parent[rows] * ARITY + n])
        at = parent
    for step in run.path:
        right = _words([step["right"]])
        slots = np.full(count, step["slot"])
        states = np.tile(_words([step["state"]]), (count, 1))
        size = np.full(count, step["slot"] + 1 + len(right))
        now = resume(states, slots, size, now, lambda rows, n: np.tile(right[n - step["slot"] - 1], (len(rows), 1)))
    hexes = lambda raw: [None if one is None else one.hex() for one in raw]
    return pa.table(
        {
            "id": leaves["id"],
            "leaf": pa.array(hexes(leaves["digest"].to_pylist()), pa.string()),
            "subroot": pa.array([run.subroot.hex()] * count, pa.string()),
            "proof_sha256": pa.array(_proofs(run, count), pa.string()),
            "folded_root": pa.array(hexes(_raw(now)), pa.string()),
        }
    )


# --- trees over tables -------------------------------------------------------------------------


def leaf(columns: Sequence[Column]) -> Column:
    """Hash of a row, 32 bytes: each value as ``-`` if NULL, else its length in bytes, ``:``, itself."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(value) for value in columns]), 256))


def tampered(order: Column, text: Column) -> Column:
    """``text`` with A-Z in lower case where the crc32 of the decimal ``order`` is divisible by three."""
    return F.when(F.crc32(order.cast("string")) % 3 == 0, F.translate(text, _UPPER, _LOWER)).otherwise(text)


@dataclass
class Manifest:
    """What is kept of a dataset: leaves with their places, and parents band by band.

    ``bands`` holds ``(nodes, parents)`` of the groups' trees from the leaves up, ``tops`` those of the
    tree over ``subroots``, ``root`` 32 bytes (None for an empty table)."""

    bands: list[tuple[DataFrame, DataFrame]]
    tops: list[tuple[DataFrame, DataFrame]]
    subroots: DataFrame
    root: bytes | None


def _bands(nodes: DataFrame, steps: int) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Bands of parents over ``key, pos, size, digest`` until each key has one node; and those nodes."""
    bands: list[tuple[DataFrame, DataFrame]] = []
    length = ARITY**steps
    while True:
        largest = nodes.agg(F.max("size")).first()[0] or 0
        if largest <= 1 and bands:
            return bands, nodes
        many = nodes.where("size > 1").select("key", "run", "pos", "size", "digest")
        parents = stored(many.groupBy("key", "run").applyInArrow(lambda run: _grow(run, steps), _PARENT), "parents")
        bands.append((nodes, parents))
        if largest <= 1:
            return bands, nodes
        sizes = nodes.where((F.col("size") > 1) & (F.col("pos") == F.col("run") * length)).select("key", "run", "size")
        tops = parents.join(sizes, ["key", "run"]).where(F.col("level") == _levels("size", steps))
        up = F.ceil(F.col("size") / length).cast("long")
        tops = tops.select("key", F.col("run").alias("pos"), up.alias("size"), "digest", F.floor(F.col("run") / length).cast("long").alias("run"))
        ready = nodes.where("size = 1").select("key", "pos", "size", "digest", "run")
        nodes = stored(tops.unionByName(ready), "tops")


def _levels(size: str, steps: int) -> Column:
    """As ``levels``, up to ``steps``."""
    found = F.lit(0)
    for n in range(steps):
        found = found + F.when(F.col(size) > ARITY**n, 1).otherwise(0)
    return found


def _numbered(rows: DataFrame, order: Sequence[str], label: str, steps: int) -> DataFrame:
    """Adds ``pos``, ``size`` and ``run`` to rows with a ``key``: place in their key's order."""
    placed = number_rows(rows, ["key", *order], "place")
    sizes = placed.groupBy("key").agg(F.min("place").alias("start"), F.count("*").alias("size"))
    pos = F.col("place") - F.col("start")
    found = placed.join(sizes, "key").withColumn("pos", pos).withColumn("run", F.floor(pos / ARITY**steps).cast("long"))
    return stored(found.drop("place", "start"), label)


def build(rows: DataFrame, steps: int = STEPS) -> Manifest:
    """The manifest of ``key, id, digest, replacement``: a tree per key, rows ascending by ``id``.

    ``key`` is a string that is never NULL, see ``group_key``."""
    leaves = _numbered(rows, ["id", "digest"], "leaves", steps)
    bands, last = _bands(leaves, steps)
    named = last.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest")
    subroots = _numbered(named, ["name"], "subroots", steps)
    tops, end = _bands(subroots, steps)
    root = end.select("digest").first()
    return Manifest(bands, tops, subroots, None if root is None else bytes(root[0]))


def group_key(group: Column) -> Column:
    """A group's name as a string that is never NULL and sorts in the same way, NULL first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _with_path(parents: DataFrame, above: DataFrame) -> DataFrame:
    """Parents of all runs, and one more row for each run: its path."""
    top = above.select("key", "run", F.lit(0).alias("level"), "path", "subroot")
    return parents.unionByName(top, allowMissingColumns=True)


def fold(manifest: Manifest) -> DataFrame:
    """``id, leaf, subroot, proof_sha256, folded_root`` of every leaf, each replaced on its own."""
    top_key = manifest.subroots.where("pos = 0").select("key", F.lit(0).cast("long").alias("run"))
    above = top_key.select("key", "run", F.array().cast(_PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"))
    path = f"key string, run long, path {_PATH}, subroot binary"

    def down(nodes: DataFrame, parents: DataFrame, above: DataFrame) -> DataFrame:
        mine = nodes.select("key", "run", "pos", "digest").groupBy("key", "run")
        return mine.cogroup(_with_path(parents, above).groupBy("key", "run")).applyInArrow(_descend, path)

    for nodes, parents in reversed(manifest.tops):
        above = down(nodes, parents, above)
    placed = manifest.subroots.select(F.col("name").alias("key"), F.col("pos").alias("run"), "digest")
    above = above.select("run", "path").join(placed, "run")
    above = stored(above.select("key", F.lit(0).cast("long").alias("run"), "path", F.col("digest").alias("subroot")), "paths")
    for nodes, parents in reversed(manifest.bands[1:]):
        above = stored(down(nodes, parents, above), "paths")
    leaves, parents = manifest.bands[0]
    mine = leaves.select("key", "run", "pos", "id", "digest", "replacement").groupBy("key", "run")
    out = f"id {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string"
    return mine.cogroup(_with_path(parents, above).groupBy("key", "run")).applyInArrow(_fold, out)


def audit(
    docs: DataFrame,
    group: str = "lang",
    order: str = "doc_id",
    text: str = "text",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    steps: int = STEPS,
) -> DataFrame:
    """``order`` column, ``leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    The root is folded again with the row as it is after tampering (``tampered``)."""
    changed = [tampered(F.col(order), F.col(text)) if name == text else F.col(name) for name in columns]
    rows = docs.select(
        group_key(F.col(group)).alias("key"),
        F.col(order).alias("id"),
        leaf([F.col(name) for name in columns]).alias("digest"),
        leaf(changed).alias("replacement"),
    )
    manifest = build(rows, steps)
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    found = fold(manifest).select(
        F.col("id").alias(order), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root"
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
