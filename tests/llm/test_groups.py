"""Operators on many rows at once, and the registered queries."""

import random

import numpy as np
import pytest
from compare import connect, difference
from helpers import TEXTS, documents, near_classes

import corpus_pipeline
from statflow.llm import near_duplicates, neighbours, queries, url_filter

FOLDER = "/root/testdata/sf0.001"


def variants(count, edits, seed, words=60):
    draw = random.Random(seed)
    base = [f"t{draw.randrange(400)}" for _ in range(words)]
    for _ in range(count):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"e{draw.randrange(10_000)}"
        yield " ".join(copy)


def test_near_classes_by_all_pairs(spark):
    texts = [*TEXTS, *TEXTS[5:8], *variants(60, 4, 1), *variants(8, 2, 2, 12), *variants(25, 1, 3)]
    docs = documents(spark, texts, repeat=False)
    found = near_duplicates.classes(docs).collect()
    want = near_classes(list(enumerate(texts)))
    assert {row.doc_id: row.cluster_id for row in found} == want
    sizes = {label: list(want.values()).count(label) for label in want.values()}
    assert all(row.cluster_size == sizes[row.cluster_id] and row.kept == (row.doc_id == row.cluster_id) for row in found)


def test_near_classes_in_cells(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CELL", 7)
    texts = list(variants(80, 5, 4))
    found = near_duplicates.classes(documents(spark, texts, repeat=False)).collect()
    assert {row.doc_id: row.cluster_id for row in found} == near_classes(list(enumerate(texts)))


def test_near_classes_of_odd_rows(spark):
    docs = documents(spark)
    found = near_duplicates.classes(docs).collect()
    assert len(found) == docs.count()
    assert [row.copies for row in found if row.doc_id == 6] == [2, 2]
    assert near_duplicates.classes(docs.limit(0)).count() == 0


def test_samples_estimate_weighted_similarity():
    draw = np.random.default_rng(0)
    shared, left, right = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    one, two = np.concatenate([shared, left]), np.concatenate([shared, right])
    agree = []
    for scale in range(12):
        sets = [near_duplicates.mix(x + np.uint64(scale)) for x in (one, two)]
        weight = np.full(1600, 1.3, np.float32)
        found = near_duplicates.samples(np.concatenate(sets), weight, np.array([0, 800]))
        agree.append((found[0] == found[1]).mean())
    assert abs(np.mean(agree) - 0.6) < 0.08


def test_components_of_a_chain(spark):
    pairs = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(100, 101), (100, 101)], "a long, b long")
    labels = {row.id: row.label for row in near_duplicates.components(pairs).collect()}
    assert labels == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(n, draw.normal(size=8).astype(np.float32).tolist()) for n in range(900)]
    rows += [(n, [1.0] * 8) for n in range(1000, 1400)]  # many equal ones
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (2004, [None] * 8), (2005, [1.0]), (None, [1.0] * 8)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), rows[:1300]


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 10)
    df, rows = vectors(spark)
    found = neighbours.search(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 5).collect()
    ids, points = np.array([key for key, _ in rows]), np.array([v for _, v in rows], np.float64)
    hit = []
    by: dict = {}
    for row in found:
        by.setdefault(row.query_id, []).append(row)
    assert set(by) == {key for key in ids.tolist() if key % 20 == 0}
    for query, own in by.items():
        own.sort(key=lambda row: row.rank)
        assert [row.rank for row in own] == [1, 2, 3, 4, 5] and query not in [row.vec_id for row in own]
        scores = (points * points[ids == query][0]).sum(1)
        assert all(abs(row.score - scores[ids == row.vec_id][0]) < 1e-9 for row in own)
        scores[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -scores))][:5]
        hit.append(len({row.vec_id for row in own} & set(best.tolist())) / 5)
    assert np.mean(hit) >= 0.9
    few = df.where("vec_id < 3")
    assert neighbours.search(few, few, "vec_id", "embedding", 5).count() == 6
    assert neighbours.search(df.limit(0), df, "vec_id", "embedding").count() == 0


URLS = (
    None, "", "no scheme", "http://", "https://example.org", "https://Example.ORG/es/1?x", "http://a.b.example.org/en/12#y", "http://notexample.org/es/",
    "ftp://fr.example.com/fr/x", "http://example.com/de/", "http://com/de/", "x://u@example.org:80/es/", "http://exa..mple.org/", "http://example.net/é",
)


def plain_verdict(url, rules):
    rest = (url or "").partition("://")[2]
    host = rest
    for mark in "/?#":
        host = host.partition(mark)[0]
    path = rest[len(host) :].partition("?")[0].partition("#")[0]
    host = host.translate({n: n + 32 for n in range(65, 91)})
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("ranges", [1, 7])
def test_url_rules(spark, ranges):
    rules = [*queries.URL_RULES, ("example.org", "/", "allow"), ("b.example.org", "/e", "block"), ("net", "", "block")]
    urls = [url for url in URLS for _ in range(30)]
    df = spark.createDataFrame([(n, url, "mine", n) for n, url in enumerate(urls)], "page_id long, url string, host string, path long").repartition(3)
    held = spark.createDataFrame([*rules, rules[0], (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    found = url_filter.judge(df, held, ranges=ranges).collect()
    assert len(found) == len(urls)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == plain_verdict(urls[row.page_id], rules)
    assert {row.verdict for row in url_filter.judge(df, held.limit(0), ranges=ranges).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0), held).count() == 0


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in queries.ORACLES:
        assert difference(df, connect(FOLDER), queries.ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_native_queries(spark):
    from conftest import plan_of

    for name in ("op3_private_data", "op9_secrets"):
        plan = plan_of(queries.QUERIES[name](spark, FOLDER))
        assert not any(node in plan for node in ("Python", "Arrow", "Pandas"))


def test_pipeline_takes_effect(spark):
    import helpers

    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(row) for row in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    kept = docs
    seen = {row.doc_id: row.text for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = near_duplicates.stored(stage(spark, kept, folder), name)
        assert kept.columns == docs.columns
        now = {row.doc_id: row.text for row in kept.collect()}
        if name == "language_id":
            assert len(now) >= 0.98 * len(seen)
        if name == "near_dedup":
            classes = near_classes([(key, text) for key, text in seen.items()])
            assert set(now) == set(classes.values())
        if name == "decontamination":
            assert set(seen) - set(now) == {key for key, text in seen.items() if helpers.hits(text, items)[1]}
        if name == "private_data":
            assert set(now) == set(seen) and not any(any(helpers.personal(text).values()) for text in now.values())
            assert all(now[key] == text for key, text in seen.items() if not any(helpers.personal(text).values()))
        seen = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    assert {piece.doc_id for piece in pieces} == set(seen)


def test_pipeline_of_odd_rows(spark):
    for docs in (documents(spark), documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = near_duplicates.stored(stage(spark, docs, FOLDER), name)
        docs.count()
