"""License scan against a plain comparison of all blocks with all notices."""

import random

import numpy as np
import pytest
from compare import connect, difference
from helpers import documents, words

from statflow.llm import licenses, queries

FOLDER = "/root/testdata/sf0.001"
RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")


def plain(text, notices, phrases=licenses.PHRASES, contained=licenses.CONTAINED):
    own, places, labels = words(text), [], set()
    for phrase, label in phrases:
        wanted = words(phrase)
        here = [at for at in range(len(own)) if own[at : at + len(wanted)] == wanted]
        places += here
        labels |= {label} if here else set()
    matches = set()
    for label, notice in notices:
        if label is None or not words(notice):
            continue
        wanted, size = set(words(notice)), licenses.width(len(words(notice)))
        for start in range(0, len(own) + 1, size // 2):
            common = len(wanted & set(own[start : start + size]))
            if common >= contained * len(wanted):
                matches.add((label, start, start + size, common / len(wanted)))
    score = 1.0 if places else max((match[3] for match in matches), default=0.0)
    every = sorted(labels | {match[0] for match in matches})
    return (len(own), len(places), min(places, default=None), max(places, default=None), sorted(labels), every, score, sorted(matches))


def found_of(df):
    rows = [tuple(row[name] for name in RESULT) for row in df.collect()]
    return sorted(((*row[:7], [tuple(match) for match in row[7]]) for row in rows), key=str)


def quoting(seed, count):
    draw = random.Random(seed)
    texts = [text for _, text in licenses.NOTICES] + [phrase for phrase, _ in licenses.PHRASES]
    for _ in range(count):
        out = [f"w{draw.randrange(50)}" for _ in range(draw.randrange(40))]
        for text in draw.sample(texts, draw.randrange(3)):
            own = [word for word in text.split() if draw.random() > 0.15]
            if draw.random() < 0.3:
                draw.shuffle(own)
            at = draw.randrange(len(out) + 1)
            out[at:at] = own
        yield " ".join(out)


@pytest.mark.parametrize("part_bytes", [licenses.PART_BYTES, 400])
def test_all_blocks(spark, part_bytes):
    texts = list(quoting(1, 150)) + ["cc by cc by mit license", "MIT   license\nCC-BY", "xmit license", "the GNU General Public Licensex"]
    docs = spark.createDataFrame([(n, text) for n, text in enumerate(texts + texts[:20])], "doc_id long, text string").repartition(3)
    want = sorted((plain(text, licenses.NOTICES) for text in texts + texts[:20]), key=str)
    assert sum(bool(row[7]) for row in want) > 30
    assert found_of(licenses.scan(docs, part_bytes=part_bytes)) == want


def test_own_notices(spark):
    notices = [("a", "x y x y z"), ("a", "..."), (None, "x y"), ("b", None), ("c", "é 中 1"), ("a", "x y x y z"), ("d", "q")]
    known = spark.createDataFrame(notices, "label string, text string")
    texts = ["x z y", "É é 中 1", "é 中", "q " * 50, "x", "y y y y y y y y y x z"]
    docs = spark.createDataFrame([(text,) for text in texts], "text string")
    for contained in (0.5, 1.0):
        found = found_of(licenses.scan(docs, known, phrases=(("x x", "xx"), ("q q", "two")), contained=contained))
        notices_text = [(label, text) for label, text in notices if text]
        assert found == sorted((plain(text, notices_text, (("x x", "xx"), ("q q", "two")), contained) for text in texts), key=str)
    none = found_of(licenses.scan(docs, known.limit(0), phrases=()))
    assert none == sorted((plain(text, [], ()) for text in texts), key=str)


def test_filters_lose_nothing():
    """Prefix, length and positional filter let every pair through that meets the threshold."""
    draw = np.random.default_rng(3)
    for _ in range(300):
        sizes = draw.integers(1, 12, 3)
        notices = [("l", " ".join(f"t{n}" for n in draw.integers(0, 25, size))) for size in sizes]
        part = licenses.Part.of(notices, 0.7).ordered(dict(enumerate(draw.integers(0, 9, 25).tolist())))
        own = np.where(draw.random(40) < 0.6, draw.integers(0, len(part.hashes), 40), -1)
        kept = {(block["width"], block["at"]): block["words"] for block in licenses.blocks_of(own, part.filters())}
        for n, whole in enumerate(part.sets):
            size = part.widths[n]
            for start in range(0, 40, size // 2):
                block = np.unique(own[start : start + size])
                block = block[block >= 0]
                if len(np.intersect1d(block, whole)) >= part.needs(n):
                    assert (kept[size, start] == block).all()
                    passed = [
                        min(len(whole) - i, len(block) - int(np.searchsorted(block, word))) >= part.needs(n)
                        for i, word in enumerate(part.prefix(n))
                        if word in block
                    ]
                    assert any(passed)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [row.text for row in docs.collect()]
    assert found_of(licenses.scan(docs)) == sorted((plain(text, licenses.NOTICES) for text in rows), key=str)
    assert licenses.scan(docs.limit(0)).count() == 0
    clashing = docs.selectExpr("*", "'x' as text_key", "1 as label", "'y' as block", "2 as word", "3 as labels", "4 as notice")
    found = licenses.scan(clashing)
    assert found.count() == len(rows) and {"text_key", "label", "block", "word", "notice"} <= set(found.columns)


def test_query_against_sql(spark):
    assert difference(queries.op12_licenses(spark, FOLDER), connect(FOLDER), queries.ORACLES["op12_licenses"]) is None
