"""The hash tree against a plain one, in bands of few levels so that small tables have several."""

import hashlib
import zlib

import numpy as np
import pytest
from compare import connect, difference
from helpers import documents

from statflow.llm import manifest, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: dict) -> str:
    values = [None if row[name] is None else str(row[name]) for name in COLUMNS]
    return sha("".join("-" if value is None else f"{len(value.encode())}:{value}" for value in values))


def climb(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[at : at + 8])) for at in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def up(tree: list[list[str]], at: int, now: str) -> tuple[str, str]:
    """The top with ``now`` in place of a leaf, and all siblings on the way."""
    proof = ""
    for nodes in tree[:-1]:
        first = at // 8 * 8
        run = list(nodes[first : first + 8])
        proof += "".join(run[: at - first] + run[at - first + 1 :])
        run[at - first] = now
        now, at = sha("".join(run)), at // 8
    return now, proof


def plain(rows: list[dict]) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    order = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: climb([one[2] for one in sorted(groups[name], key=lambda one: one[:3])]) for name in order}
    top = climb([trees[name][-1][0] for name in order])
    out = []
    for name in order:
        for at, (_, _, digest, row) in enumerate(sorted(groups[name], key=lambda one: one[:3])):
            changed = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            now, below = up(trees[name], at, leaf(changed))
            root, above = up(top, order.index(name), now)
            out.append((row["doc_id"], digest, trees[name][-1][0], top[-1][0], sha(below + above), root, root == top[-1][0]))
    return sorted(out, key=str)


RESULT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("steps", [1])
def test_trees_of_all_sizes(spark, steps):
    rows, n = [], 0
    sizes = {None: 3, "": 1, "a": 8, "aé": 9, "b": 64, "zz": 65, "Z": 130, **{f"l{k}": 1 for k in range(70)}}
    for lang, size in sizes.items():
        for _ in range(size):
            n += 7
            rows.append({"doc_id": n % 1009, "text": f"Text {n} Ünder" if n % 5 else None, "lang": lang, "source": None if n % 3 else "s", "n_chars": n})
    rows += [dict(rows[5]), {**rows[5], "text": "other"}, {**rows[9], "doc_id": None}]
    docs = spark.createDataFrame([tuple(row[name] for name in COLUMNS) for row in rows], "doc_id long, source string, lang string, n_chars long, text string")
    found = manifest.audit(docs.repartition(5), steps=steps).collect()
    assert sorted((tuple(row[name] for name in RESULT) for row in found), key=str) == plain(rows)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [row.asDict() for row in docs.collect()]
    found = manifest.audit(docs).collect()
    assert sorted((tuple(row[name] for name in RESULT) for row in found), key=str) == plain(rows)
    assert manifest.audit(docs.limit(0)).count() == 0
    clashing = docs.selectExpr("*", "'x' as key", "1 as pos", "'y' as leaf", "2 as run", "3 as digest", "4 as root")
    assert manifest.audit(clashing).count() == len(rows)


def test_states_are_those_of_the_hash():
    draw = np.random.default_rng(1).integers(0, 2**32, (13, 8), dtype=np.uint64).astype(np.uint32)
    digests, children, states = manifest.parents_of(draw)
    texts = [row.astype(">u4").tobytes().hex() for row in draw]
    assert children.tolist() == [8, 5]
    for parent, size in enumerate(children):
        mine = texts[parent * 8 : parent * 8 + size]
        assert digests[parent].astype(">u4").tobytes().hex() == sha("".join(mine))
        for slot in range(size):
            here = manifest.finish(states[[parent], slot], np.array([slot]))
            assert here[0].astype(">u4").tobytes().hex() == sha("".join(mine[:slot]))


def test_left_siblings_are_not_read():
    draw = np.arange(64, dtype=np.uint32).reshape(8, 8)
    digest, children, states = manifest.parents_of(draw)
    asked = []

    def siblings(rows, slot):
        asked.append(slot)
        return draw[[slot] * len(rows)]

    again = manifest.resume(states[[0], 5], np.array([5]), children, draw[[5]], siblings)
    assert (again == digest).all() and asked == [6, 7]


def test_query_against_sql(spark):
    assert difference(queries.op11_manifest(spark, FOLDER), connect(FOLDER), queries.ORACLES["op11_manifest"]) is None
