"""Language identification by compression.

Every language has a zstandard raw-content dictionary: pieces of its learning texts.  A text is
encoded with each dictionary, and the language with the smallest output wins.  What is encoded
are the distinct lower-case words of the whole text, in order, in chunks of ``CHUNK`` bytes, so
that neither capitals, digits and punctuation nor repeated words speak for a language, and the
dictionary counts from beginning to end of a long text.

Learning uses a bounded sample, ``per_language`` documents of each of at most ``MOST_LANGUAGES``
languages, those with the smallest hash; counting and prediction cover all rows.  A share of the
sample is kept from the dictionaries to fit the scale that turns margins into scores.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0 and is rejected.
Equal sizes go to the language
with more learning rows, with a score that says so.  Rejected is what is
``und`` or wins by less than ``narrow`` of the winner's bytes.  Without learning rows every text
is ``und``.  Repeated rows each keep their row; other columns are kept; ``lang_pred, score,
rejected`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import pass_through, schema_with

#: Documents per language that are learned from, pieces of each and their bytes, bytes of a dictionary.
PER_LANGUAGE, PIECES, PIECE, DICTIONARY = 400, 4, 512, 131072
#: Bytes that are encoded at once, and the level of compression.
CHUNK, LEVEL = 1024, 3
#: Put before each chunk: without it, zstandard leaves very short texts as they are.
FILLER = bytes(64)
MOST_LANGUAGES = 200
UNKNOWN = "und"
_NO_WORD = re.compile(r"[\W\d_]+")


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE) -> dict:
    """Dictionaries by language and the scale of margins, from labelled rows."""
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {row[lang]: row["count"] for row in known.groupBy(lang).count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    drawn = Window.partitionBy(lang).orderBy("__draw", key)
    hashed = known.select(key, lang, F.xxhash64(F.col(key).cast("string")).alias("__draw"))
    chosen = hashed.withColumn("__rank", F.row_number().over(drawn)).where(F.col("__rank") <= per_language)
    # bounded: per_language keys of each of MOST_LANGUAGES languages
    picked = known.join(F.broadcast(chosen.select(key, lang).distinct()), [key, lang])
    cut = picked.select(lang, F.col(key).cast("string").alias(key), text).mapInArrow(_cut(text, [lang, key]), f"{lang} string, {key} string, pieces array<binary>")
    pieces: dict[str, list[list[bytes]]] = {}
    for language, _, found in sorted(cut.collect(), key=lambda row: (row[0], row[1], row[2])):
        pieces.setdefault(language, []).append([bytes(one) for one in found])
    model = {"dictionaries": {}, "scale": 1.0}
    for language, found in sorted(pieces.items(), key=lambda one: (-counts[one[0]], one[0])):
        model["dictionaries"][language] = _dictionary([one for at, one in enumerate(found) if at % 8] or found)
    model["scale"] = _scale(model, {language: found[::8] for language, found in pieces.items()})
    return model


def _cut(text: str, kept: list[str]):
    """Replaces the text by at most ``PIECES`` pieces, spread over the whole of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for one in batch[text]:
                data = encoded(one.as_py())
                step = max(PIECE, len(data) // PIECES)
                found.append([data[at : at + PIECE] for at in range(0, len(data), step)][:PIECES])
            yield pass_through(batch, kept, pieces=pa.array(found, pa.list_(pa.binary())))

    return run


def _dictionary(documents: list[list[bytes]]) -> bytes:
    """The first piece of every document, then the second, up to the size of a dictionary."""
    rounds = range(max(map(len, documents), default=0))
    pieces = [one[turn] for turn in rounds for one in documents if turn < len(one)]
    out, size = [], 0
    for piece in pieces:
        if size >= DICTIONARY:
            break
        out.append(piece)
        size += len(piece) + 1
    return b" ".join(reversed(out))[-DICTIONARY:]  # matches near the end cost least


def encoded(text: str) -> bytes:
    """The distinct lower-case words of a text, in order; a word has a letter (numerals like ² are none)."""
    words = dict.fromkeys(_NO_WORD.split(text.lower()))
    return " ".join(word for word in words if word.isalpha() or any(map(str.isalpha, word))).encode()


class Judge:
    """The compressors of a model; made once in each task."""

    def __init__(self, model: dict) -> None:
        self.scale, self.languages, self.compressors = model["scale"], list(model["dictionaries"]), []
        for content in model["dictionaries"].values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, data: bytes) -> list[int]:
        data = b" %b " % data if data else data
        chunks = [FILLER + data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
        return [sum(len(one.compress(chunk)) for chunk in chunks) for one in self.compressors] if chunks else []

    def __call__(self, text: str | None, narrow: float) -> tuple[str, float, bool]:
        sizes = self.sizes(encoded(text)) if text else []
        if not sizes:
            return UNKNOWN, 0.0, True
        best, others = min(sizes), sorted(sizes)[1:]
        score = 1 / (1 + sum(math.exp(-self.scale * (size - best)) for size in others))
        rejected = bool(others) and others[0] - best < narrow * best
        return self.languages[sizes.index(best)], score, rejected


def _scale(model: dict, tests: dict[str, list[list[bytes]]]) -> float:
    """The scale under which the languages of the tests are likeliest."""
    judge, seen = Judge(model), []
    for at, language in enumerate(judge.languages):
        seen += [(sizes, at) for sizes in (judge.sizes(b" ".join(one)) for one in tests[language]) if sizes]

    def loss(scale: float) -> float:
        return sum(math.log(sum(math.exp(min(60.0, scale * (sizes[at] - size))) for size in sizes)) for sizes, at in seen)

    return min((0.02 * 1.5**step for step in range(14)), key=loss)


def predict(docs: DataFrame, model: dict, text: str = "text", narrow: float = 0.002) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``; nothing but the text is looked at."""
    names = [name for name in docs.columns if name not in ("lang_pred", "score", "rejected")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_LANGUAGES dictionaries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            found = [judge(one.as_py(), narrow) for one in batch[text]]
            languages, scores, rejected = zip(*found) if found else ((), (), ())
            yield pass_through(
                batch, names, lang_pred=pa.array(languages, pa.string()), score=pa.array(scores, pa.float64()),
                rejected=pa.array(rejected, pa.bool_()),
            )

    schema = schema_with(docs.select(*names), "lang_pred string, score double, rejected boolean")
    return docs.select(*names).mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
