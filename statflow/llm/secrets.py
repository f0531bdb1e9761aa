"""Secrets in texts, found through a trigram inverted index.

Every rule is a regular expression.  From its syntax a Boolean query over trigrams is derived: an
OR of ANDs of lower-cased trigrams that any match must contain.  The index holds a posting
(trigram, document) for each trigram that some query names and each document that contains it.
Postings are intersected by document, and only documents that satisfy the query of a rule are read
with its expression.  A rule without mandatory trigrams is run over all texts.

Everything is DataFrame expressions.  Postings are combined per document before they are shuffled.

Defined results: a NULL text counts as empty; rows with a NULL key are read with every rule; equal
keys share candidates, which the expressions verify row by row; repeated rows each keep their row;
matches that fail a rule's least length are dropped without a retry.  Other columns are kept;
result columns of the same name are replaced.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stored
from statflow.llm.matching import let, listed, matches, where


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``value`` is the pattern that cuts the part of a match whose length counts."""

    kind: str
    pattern: str
    least: int = 0
    value: str = ""


# The base rules.
BASE = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+", 8, r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
# Further rules, by the documented shapes of keys.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"sk_live_[0-9A-Za-z]{24,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
#: Exact strings that are followed at once while a query is derived.
_MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The ANDs of an OR: each match of ``pattern``, lower-cased, contains all trigrams of one of them.

    An empty AND means that nothing is mandatory."""
    exact, queries = _derive(parser.parse(pattern))
    if exact is not None:
        queries = _and(queries, [_trigrams(one) for one in exact])
    shortest = sorted(set(queries), key=len)
    return [one for at, one in enumerate(shortest) if not any(other <= one for other in shortest[:at])]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[at : at + 3] for at in range(len(text) - 2))


def _and(left: list[frozenset], right: list[frozenset]) -> list[frozenset]:
    return [one | other for one, other in product(left, right)]


def _derive(items) -> tuple[set[str] | None, list[frozenset]]:
    """Strings that are all a part can match (None if unknown), and the query of what came before them."""
    exact, queries = {""}, [frozenset()]

    def cut() -> None:
        nonlocal exact, queries
        queries = _and(queries, [_trigrams(one) for one in exact])
        exact = {""}

    for op, value in items:
        inner, more = None, [frozenset()]
        if op is C.LITERAL:
            inner = {chr(value).lower()}
        elif op is C.SUBPATTERN:
            inner, more = _derive(value[-1])
        elif op is C.BRANCH:
            parts = [_derive(part) for part in value[1]]
            if all(found is not None and asked == [frozenset()] for found, asked in parts):
                inner = set().union(*(found for found, _ in parts))
            else:
                more = [one for found, asked in parts for one in (asked if found is None else _and(asked, [_trigrams(x) for x in found]))]
        elif op is C.IN and all(kind is C.LITERAL for kind, _ in value):
            inner = {chr(one).lower() for _, one in value}
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, part = value
            found, asked = _derive(part)
            if (least, most) == (0, 1) and found is not None and asked == [frozenset()]:
                inner = {"", *found}
            elif least == most == 1:
                inner, more = found, asked
            elif least:
                more = asked if found is None else _and(asked, [_trigrams(x) for x in found])
        elif op is C.AT:
            continue
        if inner is not None and more == [frozenset()] and len(exact) * len(inner) <= _MOST_STRINGS:
            exact = {a + b for a, b in product(exact, inner)}
        else:
            cut()
            queries = _and(queries, more)
            if inner is not None:
                exact = inner
    return exact, queries


def index(docs: DataFrame, trigrams: list[str], key: str, text: str) -> DataFrame:
    """Postings ``trigram, key`` of the named trigrams."""
    wanted = F.array(*map(F.lit, trigrams))
    held = let(F.lower(F.coalesce(F.col(text), F.lit(""))), lambda t: F.filter(wanted, lambda one: F.contains(t, one)))
    return docs.where(F.col(key).isNotNull()).select(key, F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]], key: str) -> DataFrame:
    """``key, rules``: the rules whose query the postings of a document satisfy."""
    both = postings.groupBy(key).agg(F.collect_set("trigram").alias("has"))
    # the number of trigrams in common decides an AND
    fits = [
        F.when(
            F.greatest(F.lit(0), *[
                (F.size(F.array_intersect("has", F.array(*map(F.lit, sorted(one))))) == len(one)).cast("int") for one in asked
            ]) == 1,
            F.lit(kind),
        )
        for kind, asked in queries.items()
    ]
    return both.select(key, F.array_compact(F.array(*fits)).alias("rules")).where(F.size("rules") > 0)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *MORE), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: ``array<struct<kind, start, end>>`` by start, then order of the rules."""
    asked = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in asked.items() if all(query)}
    trigrams = sorted({one for query in indexed.values() for group in query for one in group})
    own = [name for name in docs.columns if name != "secrets"]
    if not trigrams:
        return docs.select(*own).withColumn("secrets", _verified(rules, F.coalesce(F.col(text), F.lit("")), lambda rule: F.lit(True)))
    postings = stored(index(docs.select(key, text), trigrams, key, text), "postings")
    chosen = candidates(postings, indexed, key).withColumnRenamed(key, "__key")
    joined = docs.select(*own).join(chosen, F.col(key) == F.col("__key"), "left")

    def meant(rule: Rule) -> Column:
        if rule.kind not in indexed:
            return F.lit(True)
        return F.col(key).isNull() | F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))

    found = _verified(rules, F.coalesce(F.col(text), F.lit("")), meant)
    return joined.withColumn("secrets", found).select(*own, "secrets")


def _verified(rules: tuple[Rule, ...], text: Column, meant) -> Column:
    parts = []
    for at, rule in enumerate(rules):
        spans = where(meant(rule), matches(text, rule.pattern))
        if rule.value:
            spans = F.filter(spans, _long_enough(rule))
        elif rule.least:
            spans = F.filter(spans, _long_match(rule.least))
        parts.append(F.transform(spans, _placed(at, rule.kind)))
    by_start = F.array_sort(F.concat(*parts))
    return F.transform(by_start, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _long_enough(rule: Rule):
    return lambda m: F.length(F.regexp_extract(m["found"], rule.value, 1)) >= rule.least


def _long_match(least: int):
    return lambda m: F.length(m["found"]) >= least


def _placed(at: int, kind: str):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(at).alias("at"), m["end"].alias("end"), F.lit(kind).alias("kind"))


def digests(found: str = "secrets") -> dict[str, Column]:
    """Counts of the base kinds, their spans as a hash, and all spans as a string."""
    of = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(found, lambda s: s["kind"].isin([rule.kind for rule in BASE]))
    counts = {f"n_{rule.kind}": of(rule.kind) for rule in BASE}
    return {**counts, "base_sha256": F.sha2(listed(base), 256), "spans": listed(F.col(found))}
