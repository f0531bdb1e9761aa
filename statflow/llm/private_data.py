"""Personal data in texts: fixed patterns, and a weakly supervised classifier for looser candidates.

Strict patterns give the base spans, which always stay.  Looser patterns give candidates.  Labelers
vote on both (yes 1, no -1, silent 0): *form* by a strict regular expression, *list* by a gazetteer
(top-level domains, issuer prefixes, given names ...), *before* by the words ahead, *edge* by the
characters around.  Expectation-maximisation on the counts of vote patterns estimates how reliable
each labeler is for each kind; its posteriors are the soft labels of the final span classifier, a
naive Bayes over votes, length and shape.  Candidates that reach ``ACCEPT`` become spans.

Everything is DataFrame expressions.  Texts are read twice: once for the counts of vote patterns,
of which there are at most ``3**4`` for each kind and feature, and once for the result; there is no
shuffle but that of the counts.

Defined results: a NULL text counts as empty; overlapping spans of different kinds all stay, a
candidate that overlaps a base span is dropped; repeated rows each keep their row; without any
candidate no classifier is needed; other columns are kept, result columns of the same name replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.matching import let, listed, matches, where

BASE = ("email", "ip", "card", "phone")
LOOSE = ("local", "ssn", "person")
LABELERS = ("form", "list", "before", "edge")
#: Least probability of an added span, rounds of expectation-maximisation.
ACCEPT, ROUNDS = 0.9, 12
#: Characters ahead of a span in which context words count.
AHEAD = 32

# The base patterns. A run of one class is read as a whole and only from its start
# (or where the match before ended), so the time is linear in the text. Groups repeat possessively:
# Java loops over those, but calls itself for each round of others, until its stack is full.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9][0-9 -]*+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# The looser patterns.
LOCAL = r"(?<![0-9+])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PERSON = r"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Madame|Monsieur|Señora|Señor)\.? [A-Z][a-z]{1,30}\b"
# Words ahead of a span that speak for its kind, and against all kinds.
BEFORE = {
    "email": "mail|contact|write|reach|address", "ip": "ip|host|server|address|client|from", "card": "card|visa|mastercard|amex|credit|debit|pay",
    "phone": "call|tel|phone|mobile|cell|fax|reach|whatsapp", "local": "call|tel|phone|mobile|cell|fax|reach|whatsapp",
    "ssn": "ssn|social security|tax id|national id", "person": "dear|signed|sincerely|patient|customer|name|attn|by|from",
}
AGAINST = r"version|release|section|chapter|isbn|order|invoice|build|figure|table|page"
# Gazetteers, as patterns of the span.
LISTED = {
    "email": r"\.(com|org|net|edu|gov|int|mil|info|io|co|de|fr|es|it|nl|uk|us|eu|ch|at|be|pl|ru|jp|cn|br|in|ca|au)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.|22[4-9]|2[3-5][0-9])",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)",
    "phone": r"^\+(1|7|2[07]|3[0-69]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[0-9]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|97[0-9])",
    "local": r"^\(?[2-9][0-8][0-9]", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "person": r" (James|John|Robert|Michael|David|Mary|Patricia|Jennifer|Linda|Elizabeth|Anna|Maria|Peter|Paul|Hans|Karl|Jean|Pierre|Marie|José|Juan|Carmen|Luis|Sofia|Emma|Olivia|Lucas|Thomas|Laura|Sarah|Daniel)",
}
FORM = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(\.[A-Za-z0-9-]{1,63}){0,5}\.[A-Za-z]{2,24}$",
    "ip": r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$", "card": r"^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$",
    "phone": r"^\+[0-9]{1,3}[ .-]?(\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}([ .-]?[0-9]{2,4}){1,4}$",
    "local": r"^(\([2-9][0-9]{2}\) |[2-9][0-9]{2}([ .-]))[2-9][0-9]{2}[ .-][0-9]{4}$", "ssn": r"^[0-9-]{11}$",
    "person": r"^(Mr|Mrs|Ms|Dr|Prof)\. ",
}

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_VALID_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
_CANDIDATE = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,key:string>>"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    doubled = lambda n: F.when(n > 4, n * 2 - 9).otherwise(n * 2)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(c.cast("int"), lambda n: F.when(i % 2 == 1, doubled(n)).otherwise(n)))
    return F.aggregate(values, F.lit(0), lambda a, n: a + n) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind; ``text`` is not NULL."""
    digit, bare = text.rlike("[0-9]"), lambda x: F.translate(x, " -", "")
    # a separator that no digit follows ends a number; it is masked, so that lengths stay
    numbers = F.filter(
        matches(F.regexp_replace(text, "[ -](?![0-9])", "\u0001"), DIGITS),
        lambda m: let(bare(m["found"]), lambda d: F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)),
    )
    called = lambda m: F.length(F.regexp_replace(m["found"], "[^0-9]", "")).between(9, 15)
    return {
        "email": where(text.contains("@"), matches(text, EMAIL)),
        "ip": where(digit & text.rlike(r"[0-9]\.[0-9]"), F.filter(matches(text, IP), lambda m: m["found"].rlike(_VALID_IP))),
        "card": where(digit & text.rlike("[0-9](?:[ -]?[0-9]){12}"), numbers),
        "phone": where(text.contains("+") & digit, F.filter(matches(text, PHONE), called)),
    }


def loose_spans(text: Column) -> dict[str, Column]:
    digit = text.rlike("[0-9]")
    return {
        "local": where(digit & text.rlike("[0-9]{3}[ .-][0-9]{4}"), matches(text, LOCAL)),
        "ssn": where(digit & text.rlike("[0-9]-[0-9]{2}-[0-9]"), matches(text, SSN)),
        "person": where(text.rlike(PERSON), matches(text, PERSON)),
    }


def _votes(text: Column, kind: str, span: Column) -> Column:
    """The votes on a span and its length and shape, as one short string."""
    ahead = F.lower(F.substring(text, F.greatest(F.lit(1), span["start"] - AHEAD + 1).cast("int"), F.least(F.lit(AHEAD), span["start"]).cast("int")))
    around = F.concat(
        F.when(span["start"] > 0, F.substring(text, span["start"].cast("int"), F.lit(1))).otherwise(" "),
        F.substring(text, (span["end"] + 1).cast("int"), F.lit(1)),
    )
    found = span["found"]
    before = let(ahead, lambda a: F.when(a.rlike(AGAINST), "-").when(a.rlike(rf"\b({BEFORE[kind]})"), "+").otherwise("0"))
    return F.concat(
        F.when(found.rlike(FORM[kind]), "+").otherwise("-"),
        F.when(found.rlike(LISTED[kind]), "+").otherwise("-"),
        before,
        F.when(around.rlike(r"[\p{L}\p{N}/=_]"), "-").otherwise("0"),
        F.when(F.length(found) < 12, "s").when(F.length(found) < 20, "m").otherwise("l"),
        F.when(found.rlike("[ ().-]"), "p").otherwise("n"),
    )


def _candidates(text: Column) -> Column:
    """All candidates of a text: kind, place, whether it is a base span, and kind with votes."""
    base, loose = base_spans(text), loose_spans(text)

    def of(kind: str, spans: Column, strict: bool) -> Column:
        key = lambda s: F.concat(F.lit(f"{kind} "), _votes(text, kind, s))
        return F.transform(
            spans,
            lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(strict).alias("base"), key(s).alias("key")),
        )

    def joined(strict: Column) -> Column:
        free = lambda s: ~F.exists(strict, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.concat(strict, *[of(kind, F.filter(spans, free), False) for kind, spans in loose.items()])

    strict = F.concat(*[of(kind, spans, True) for kind, spans in base.items()])
    return let(strict, joined)


def _some(text: Column) -> Column:
    """Whether a text can hold candidates at all."""
    return text.rlike("[0-9@]") | text.rlike(PERSON)


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone, base, spans``; the last two are
    ``array<struct<kind, start, end>>`` in order of kind, then start."""
    source = F.coalesce(F.col(text), F.lit(""))
    found = F.when(_some(source), _candidates(source)).otherwise(F.array()).cast(_CANDIDATE)
    accepted = _accepted(docs.select(F.explode(found).alias("c")).groupBy("c.key", "c.base").count())
    kinds = F.array(*map(F.lit, (*BASE, *LOOSE)))
    ordered = lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda c: F.struct(F.array_position(kinds, c["kind"]).alias("at"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    keep = lambda c: c["base"] | c["key"].isin(accepted) if accepted else c["base"]
    both = let(found, lambda all_: F.struct(ordered(F.filter(all_, lambda c: c["base"])).alias("base"), ordered(F.filter(all_, keep)).alias("spans")))
    out = docs.withColumn("__found", both)
    count = lambda kind: F.size(F.filter("__found.base", lambda b: b["kind"] == kind)).cast("long")
    counts = {f"n_{kind}": count(kind) for kind in BASE}
    return out.withColumns({**counts, "base": F.col("__found.base"), "spans": F.col("__found.spans")}).drop("__found")


def _accepted(patterns: DataFrame) -> list[str]:
    """Kinds with votes whose candidates become spans.  ``patterns``: ``key, base, count``."""
    rows = [(row.key, row["count"]) for row in patterns.collect()]  # at most 3**4 * 6 for each kind
    loose = {key for key, _ in rows if key.split()[0] in LOOSE}
    if not loose:
        return []
    posterior = estimate(rows)
    scores = classify(rows, posterior)
    return sorted(key for key in loose if scores[key] >= ACCEPT)


def estimate(rows: list[tuple[str, int]]) -> dict[str, float]:
    """Posterior of each vote pattern, by expectation-maximisation over counts.

    Model: a span is personal data with a probability of its kind; each labeler, where it speaks,
    is right with a probability of its own for each kind.  Labelers start better than chance."""
    prior = {key.split()[0]: 0.5 for key, _ in rows}
    right = {(kind, labeler): 0.8 for kind in prior for labeler in LABELERS}
    posterior: dict[str, float] = {}
    for _ in range(ROUNDS):
        agreed, spoken = dict.fromkeys(right, 1.6), dict.fromkeys(right, 2.0)
        mass, total = dict.fromkeys(prior, 1.0), dict.fromkeys(prior, 2.0)
        for key, count in rows:
            kind, votes = key.split()
            spoke = [((kind, labeler), vote) for labeler, vote in zip(LABELERS, votes) if vote != "0"]
            yes, no = prior[kind], 1 - prior[kind]
            for of, vote in spoke:
                yes *= right[of] if vote == "+" else 1 - right[of]
                no *= right[of] if vote == "-" else 1 - right[of]
            posterior[key] = yes / (yes + no)
            mass[kind] += count * posterior[key]
            total[kind] += count
            for of, vote in spoke:
                spoken[of] += count
                agreed[of] += count * (posterior[key] if vote == "+" else 1 - posterior[key])
        right = {of: min(0.98, max(0.55, agreed[of] / spoken[of])) for of in right}
        prior = {kind: min(0.98, max(0.02, mass[kind] / total[kind])) for kind in prior}
    return posterior


def classify(rows: list[tuple[str, int]], posterior: dict[str, float]) -> dict[str, float]:
    """Probability of each pattern by naive Bayes over kind, votes, length and shape, with the posteriors as labels."""
    yes: dict[tuple, float] = {}
    no: dict[tuple, float] = {}
    for key, count in rows:
        kind, features = key.split()
        for feature in [("kind", kind), *enumerate(features)]:
            yes[feature] = yes.get(feature, 0.5) + count * posterior[key]
            no[feature] = no.get(feature, 0.5) + count * (1 - posterior[key])
    all_yes, all_no = (1 + sum(count * p for (_, count), p in zip(rows, values)) for values in ([posterior[k] for k, _ in rows], [1 - posterior[k] for k, _ in rows]))
    scores = {}
    for key, _ in rows:
        kind, features = key.split()
        odds = math.log(all_yes / all_no)
        for feature in [("kind", kind), *enumerate(features)]:
            odds += math.log(yes[feature] / all_yes) - math.log(no[feature] / all_no)
        scores[key] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return scores


def redact(annotated: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``text`` with ``<KIND>`` in place of each span; spans that overlap are replaced together."""
    source = F.col(text)
    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def one(done: Column, span: Column) -> Column:
        gap = F.substring(source, (done["at"] + 1).cast("int"), F.greatest(F.lit(0), span["start"] - done["at"]).cast("int"))
        mark = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
        piece = F.when(span["start"] >= done["at"], F.concat(gap, mark)).otherwise("")
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.array_append(done["out"], piece).alias("out"))

    by_start = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rest = lambda done: F.concat(F.array_join(done["out"], ""), F.substring(source, (done["at"] + 1).cast("int"), F.length(source)))
    return annotated.withColumn(text, F.when(F.size(spans) > 0, let(F.aggregate(by_start, nothing, one), rest)).otherwise(source))


def digests(annotated: DataFrame) -> dict[str, Column]:
    """The base spans as a hash, and all spans as a string."""
    return {"base_sha256": F.sha2(listed(F.col("base")), 256), "spans": listed(F.col("spans"))}
