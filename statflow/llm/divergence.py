"""How far the sources of a language diverge in their terms: an audit by iceberg prefix refinement.

Terms are runs of letters, A-Z in lower case.  A language keeps the terms that stand in at least
``LEAST`` of its documents.  They are found by refinement: the byte prefixes of terms are extended level
by level (4, 8, 16, … bytes); a prefix that stands in fewer than ``LEAST`` documents is discarded, and
only what extends a prefix that is left is looked at on the next level, until complete terms remain.
Most terms of a large corpus are rare; they are given up as short prefixes.

The texts are read once.  A task counts its own documents by prefix, and by source and complete term,
in tables of bounded size which it writes out; a document lies in one task, so distinct documents
add up.  The levels then work on those counts: each joins its prefixes to those left over
(by Spark, with whatever join their measured size allows), adds them up, and discards.

Every group (language, source) and every language gives each kept term ``p``, the smoothed share of
the term in units of 10^-9 (``share``), and ``f = (p - q)^2 div q`` says how far ``p`` is from another
``q``.  ``pairs`` sums ``f`` over all kept terms for each ordered pair of sources.  It does not visit
each term for each pair: a term that a source lacks has one and the same ``p`` there, so all terms are
first taken as lacking on one side, by how many of a source's terms have the same count; what is joined
are the terms that two sources have in common, which put right the difference.

Defined results: NULL text, language or source reads as ``''``; every row is a document, repeated rows
too; a group without kept terms has ``count`` 0 for all; without any kept term the values of ``pairs``
are 0; a language with one source has no pairs; an empty table gives no rows.  Other columns are
not read.  All arithmetic is in whole numbers: decimals of 38 digits where 64 bits could overflow.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import stored

#: Documents that a kept term or prefix stands in, ranks kept of a group's terms.
LEAST, RANKS = 3, 200
#: Bytes of the prefixes on the first level; each level doubles them.
FIRST = 4
#: Entries and bytes that a task counts in memory before it writes them out.
ENTRIES, ENTRY_BYTES = 400_000, 32 << 20
_LETTERS = {*range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _LETTERS else 32 for c in range(256))
#: Rows of level n are prefixes of n bytes; complete terms, by source, are at -n, the level on which they end.
_COUNTS = "level int, lang string, source string, piece binary, docs long, count long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split()


def _rows(key: tuple, docs: Counter, found: Counter) -> Iterator[pa.RecordBatch]:
    level, lang, source = key
    pieces, numbers = list(docs), list(docs.values())
    for at in range(0, len(pieces), 20_000):
        part = pieces[at : at + 20_000]
        n = len(part)
        yield pa.RecordBatch.from_pydict(
            {
                "level": pa.repeat(pa.scalar(level, pa.int32()), n),
                "lang": pa.repeat(pa.scalar(lang, pa.string()), n),
                "source": pa.repeat(pa.scalar(source, pa.string()), n),
                "piece": pa.array(part, pa.binary()),
                "docs": pa.array(numbers[at : at + n], pa.int64()),
                "count": pa.array([found[piece] for piece in part] if found else numbers[at : at + n], pa.int64()),
            }
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of complete terms and of prefixes over the documents of a task."""
    found: dict[tuple, Counter] = defaultdict(Counter)  # occurrences by language and source
    docs: dict[tuple, Counter] = defaultdict(Counter)  # documents by level, language and source
    held = size = 0

    def add(key: tuple, pieces, longest: int) -> None:
        nonlocal held, size
        counts = docs[key]
        before = len(counts)
        counts.update(pieces)
        grown = len(counts) - before
        held += grown
        size += grown * longest

    def emit() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        for key, counts in docs.items():
            yield from _rows(key, counts, found[key[1:]] if key[0] < 0 else None)
        found.clear()
        docs.clear()
        held = size = 0

    for batch in batches:
        for lang, source, text in zip(*(batch.column(n).to_pylist() for n in range(3))):
            words = terms(text)
            found[lang, source].update(words)
            left, level = set(words), FIRST
            while left:
                longer = [term for term in left if len(term) > level]
                add((-level, lang, source), left.difference(longer), level)
                add((level, lang, None), {term[:level] for term in longer}, level)
                left, level = set(longer), level * 2
            if held > ENTRIES or size > ENTRY_BYTES:
                yield from emit()
    yield from emit()


def counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Counts by task of prefixes and complete terms, written down; see ``_COUNTS``."""
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    read = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).cast("binary").alias("text"))
    return stored(read.mapInArrow(_count, _COUNTS), "terms", ["level"])


def kept_counts(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, source, term, count, often, head`` of the terms that stand in ``least`` documents of their language:
    occurrences in the source and the language; ``head`` marks one row of each term."""
    alive, found, level = None, None, FIRST

    def of_living(at: int) -> DataFrame:
        rows = counted.where(F.col("level") == at)
        if alive is None:
            return rows
        rows = rows.withColumn("prefix", F.substring("piece", 1, level // 2))
        return rows.join(alive.withColumnRenamed("piece", "prefix"), ["lang", "prefix"], "left_semi").drop("prefix")

    while True:
        ended = of_living(-level).drop("level")
        found = ended if found is None else found.unionByName(ended)
        longer = of_living(level).groupBy("lang", "piece").agg(F.sum("docs").alias("docs"))
        alive = stored(longer.where(F.col("docs") >= least).select("lang", "piece"), "prefixes")
        if alive.isEmpty():
            break
        level *= 2
    # one shuffle by term serves the sums by source and those of the language
    dealt = found.repartition("lang", "piece")
    sums = dealt.groupBy("lang", "piece", "source").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    whole = Window.partitionBy("lang", "piece")
    spread = sums.select(
        "lang",
        "source",
        F.col("piece").alias("term"),
        "count",
        F.sum("count").over(whole).alias("often"),
        (F.col("source") == F.min("source").over(whole)).alias("head"),
        F.sum("docs").over(whole).alias("docs"),
    )
    return stored(spread.where(F.col("docs") >= least).drop("docs"), "kept")


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(10^9 (count + 1) / (total + kept))``: what a group gives a term."""
    wide = lambda value: value.cast("decimal(28,0)")
    exact = F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * wide(count + 1), wide(total + kept))
    # most products fit 64 bits
    return F.when(count < 9 * 10**9, F.call_function("div", F.lit(10**9).cast("long") * (count + 1), total + kept)).otherwise(exact) + 1


def apart(p: Column, q: Column) -> Column:
    """``(p - q)^2 div q``; both lie between 1 and 10^9 + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def groups(docs: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Every group that occurs: ``lang, source, total, had, all, kept, none`` with the occurrences and number of kept
    terms it has, those of its language, and its share for a term that it lacks."""
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    occurring = docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("had"), F.count_if("head").alias("heads"))
    whole = own.groupBy("lang").agg(F.sum("heads").alias("kept"), F.sum("total").alias("all"))
    found = occurring.join(own.drop("heads"), ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["total", "had", "kept", "all"])
    nothing = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    return stored(found.withColumn("none", nothing), "groups")


def shares(kept: DataFrame, group: DataFrame) -> DataFrame:
    """``lang, source, term, p, q, none``: shares of a term in a source that has it, in the language, and of a lacking term."""
    of = group.select("lang", "source", "total", "all", "kept", "none")
    p, q = share(F.col("count"), F.col("total"), F.col("kept")), share(F.col("often"), F.col("all"), F.col("kept"))
    return stored(kept.join(of, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"), "none"), "shares")


def _exact_sum(value: Column) -> Column:
    """Sum of 64-bit numbers as a decimal: upper and lower halves are added up apart, so neither overflows."""
    wide = lambda half: F.sum(half).cast("decimal(38,0)")
    return wide(F.shiftright(value, 32)) * F.lit(1 << 32).cast("decimal(10,0)") + wide(value.bitwiseAND(F.lit((1 << 32) - 1)))


def pairs(own: DataFrame, group: DataFrame) -> DataFrame:
    """``lang, source, item, value``: ``f`` summed over the kept terms for each other source of the language."""
    one = group.select("lang", *[F.col(name).alias(f"a_{name}") for name in ("source", "had", "none")], "kept")
    two = group.select("lang", *[F.col(name).alias(f"b_{name}") for name in ("source", "had", "none")])
    # each ordered pair of sources is a row of the result
    both = one.join(two, "lang").where("a_source <> b_source")
    wide = lambda value: value.cast("decimal(38,0)")

    # all terms of one source, as if the other lacked them; few different shares each
    few = own.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    mine = few.select("lang", F.col("source").alias("a_source"), "p", "terms")
    theirs = few.select("lang", F.col("source").alias("b_source"), F.col("p").alias("q"), "terms")
    key = ["lang", "a_source", "b_source"]
    ends = both.select(*key, "a_none", "b_none")
    left = ends.join(mine, ["lang", "a_source"]).select(*key, wide(apart(F.col("p"), F.col("b_none"))).alias("f"), "terms")
    right = ends.join(theirs, ["lang", "b_source"]).select(*key, wide(apart(F.col("a_none"), F.col("q"))).alias("f"), "terms")
    rest = both.where("kept > 0").select(
        *key, wide(apart(F.col("a_none"), F.col("b_none"))).alias("f"), (F.col("kept") - F.col("a_had") - F.col("b_had")).alias("terms")
    )
    # terms that both have: their f in place of what the parts above took for them
    own = own.select("lang", "term", "source", "p", "none")
    a, b = own.alias("a"), own.alias("b")
    shared = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source")))

    def put_right(p: str, q: str) -> Column:
        f = lambda x, y: apart(F.col(x), F.col(y))
        # each f is at most 10^18
        return f(f"{p}.p", f"{q}.p") - f(f"{p}.p", f"{q}.none") - f(f"{p}.none", f"{q}.p") + f(f"{p}.none", f"{q}.none")

    ordered = shared.groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("one"), F.col("b.source").alias("two")).agg(
        _exact_sum(put_right("a", "b")).alias("there"), _exact_sum(put_right("b", "a")).alias("back")
    )
    ways = F.explode(F.array(F.struct("one", "two", F.col("there").alias("f")), F.struct(F.col("two").alias("one"), F.col("one").alias("two"), F.col("back").alias("f"))))
    mended = ordered.select("lang", ways.alias("way")).select(
        "lang", F.col("way.one").alias("a_source"), F.col("way.two").alias("b_source"), wide(F.col("way.f")).alias("f"), F.lit(1).cast("long").alias("terms")
    )
    parts = left.unionByName(right).unionByName(rest).unionByName(mended)
    summed = parts.groupBy(*key).agg(F.sum(F.col("f") * F.col("terms")).cast("long").alias("value"))
    every = both.select(*key).join(summed, key, "left")
    return every.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def distinctive(own: DataFrame) -> DataFrame:
    """``lang, source, item, value``: terms that a source has more often than its language."""
    return own.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources (``pair``), and the ``ranks`` most distinctive terms (``term``)."""
    kept = kept_counts(counts(docs, lang, source, text), least)
    group = groups(docs, kept, lang, source)
    own = shares(kept, group)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
    terms = ranked(distinctive(own), "term").where(F.col("rank") <= ranks)
    out = ranked(pairs(own, group), "pair").unionByName(terms)
    return out.select("lang", "source", "part", "item", "value", "rank")
