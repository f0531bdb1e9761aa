"""Divergence of sources against a plain count of everything."""

import random
import re
from collections import Counter

import pytest
from compare import connect, difference
from helpers import documents

from statflow.llm import divergence, queries

FOLDER = "/root/testdata/sf0.001"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def kept_terms(rows, least=3):
    docs = {}
    for text, lang, _ in rows:
        docs.setdefault(lang or "", Counter()).update(set(terms(text)))
    return {lang: sorted(term for term, n in found.items() if n >= least) for lang, found in docs.items()}


def plain(rows, least=3, ranks=200):
    kept, counts = kept_terms(rows, least), {}
    for text, lang, source in rows:
        counts.setdefault((lang or "", source or ""), Counter()).update(terms(text))
    out = []

    def shares(found, words):
        total = sum(found[word] for word in words)
        return {word: 1 + 10**9 * (found[word] + 1) // (total + len(words)) for word in words}

    for (lang, source), own in counts.items():
        words = kept[lang]
        p = shares(own, words)
        whole = sum((found for (of, _), found in counts.items() if of == lang), Counter())
        q = shares(whole, words)
        listed = []
        for (of, other), found in counts.items():
            if of == lang and other != source:
                theirs = shares(found, words)
                listed.append(("pair", other, sum((p[w] - theirs[w]) ** 2 // theirs[w] for w in words)))
        listed += [("term", w, (p[w] - q[w]) ** 2 // q[w]) for w in words if own[w] and p[w] > q[w]]
        for part in ("pair", "term"):
            mine = sorted((one for one in listed if one[0] == part), key=lambda one: (-one[2], one[1].encode()))
            out += [(lang, source, *one, n + 1) for n, one in enumerate(mine) if part == "pair" or n < ranks]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)


def made(seed, count):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("a", "ab", "éé", "Zz", "中", "longer prefix"[:6], "abcdefghijklmnop" * 3) for b in ("", "x", "yy", "zzzzzz", "ß" * 9)]
    for _ in range(count):
        text = " ".join(draw.choices(words, range(1, len(words) + 1), k=draw.randrange(30)))
        yield (text + " 12-3", draw.choice(["en", "fr", None, ""]), draw.choice(["s1", "s2", "s3", None]))


@pytest.mark.parametrize("seed", [1])
def test_all_values(spark, seed):
    rows = [*made(seed, 120), ("only here", "xx", "s1"), ("", "xx", "s2"), (None, "xx", None), ("a a a", "one", "s")]
    found = divergence.audit(frame(spark, rows), ranks=7).collect()
    assert sorted(map(tuple, found)) == plain(rows, ranks=7)


def test_kept_terms_are_those_of_a_plain_count(spark):
    rows = list(made(5, 200)) + [("q" * 5000 + " " + "q" * 5001, "en", "s")] * 3
    found = divergence.kept_counts(divergence.counts(frame(spark, rows))).collect()
    kept = {(row.lang, bytes(row.term).decode()) for row in found}
    assert kept == {(lang, term) for lang, all_of in kept_terms(rows).items() for term in all_of}


def test_prefix_of_many_documents_but_no_common_term(spark):
    rows = [("same" + "abcdefgh"[n] * 3, "en", "s") for n in range(8)]
    assert divergence.audit(frame(spark, rows)).count() == 0


def test_written_out_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "ENTRIES", 5)
    rows = [(lang, source, (text or "").encode()) for text, lang, source in made(3, 50)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary())], ["lang", "source", "text"])
    docs, count = Counter(), Counter()
    parts = list(divergence._count(iter([batch])))
    assert len(parts) > 20
    for part in parts:
        for row in part.to_pylist():
            if row["level"] < 0:
                docs[row["lang"], row["source"], row["piece"]] += row["docs"]
                count[row["lang"], row["source"], row["piece"]] += row["count"]
    want_docs, want = Counter(), Counter()
    for lang, source, text in rows:
        found = [term.encode() for term in terms(text.decode())]
        want.update((lang, source, term) for term in found)
        want_docs.update((lang, source, term) for term in set(found))
    assert docs == want_docs and count == want


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [(row.text, row.lang, row.source) for row in docs.collect()]
    assert sorted(map(tuple, divergence.audit(docs).collect())) == plain(rows)
    assert divergence.audit(docs.limit(0)).count() == 0
    clashing = docs.selectExpr("*", "'x' as piece", "1 as level", "'y' as item", "2 as rank", "3 as term", "4 as total")
    assert sorted(map(tuple, divergence.audit(clashing).collect())) == plain(rows)


def test_query_against_sql(spark):
    assert difference(queries.op13_divergence(spark, FOLDER), connect(FOLDER), queries.ORACLES["op13_divergence"]) is None
