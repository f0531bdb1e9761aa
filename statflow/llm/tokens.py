"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

The vocabularies are byte-level BPE, which cuts a text into pieces (words with the space before
them, numbers, punctuation, white space) and merges inside each piece only.  Pieces repeat, so a
block of texts is cut by array operations, and the tokenizer's model encodes each distinct piece
once; a bounded hash table in the Python worker keeps pieces over blocks.  Texts that hold a special
token, or characters that the Unicode tables of Python don't know, are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import cache
from itertools import chain
from operator import attrgetter

import numpy as np
import xxhash
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from statflow.llm.common import blocks
from statflow.llm.words import mix

#: Characters encoded together, and pieces that a worker keeps before it starts anew; a block has fewer.
BLOCK, KEPT_PIECES = 1 << 19, 1 << 20
#: Slots of the table are 2 to this power: twice the pieces that are kept.
SLOT_BITS = 21
LETTER, NUMBER, SPACE, OTHER, EDGE, UNKNOWN = range(6)
#: A longer piece is not looked up.
LONGEST = 64
# What Unicode calls white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
_BASE = 0xD6E8FEB86659FD93


@cache
def _kinds() -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    kinds = np.fromiter(
        (UNKNOWN if (c := unicodedata.category(chr(n))) == "Cn" else first.get(c[0], OTHER) for n in range(sys.maxunicode + 1)),
        np.uint8,
    )
    kinds[[ord(c) for c in WHITE]] = SPACE
    return kinds


@cache
def encoder(path: str) -> Encoder:
    """One for each file and Python worker."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        if not isinstance(self.tokenizer.pre_tokenizer, ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError("a byte-level tokenizer without normalizer is needed")
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)) if added else None
        self._forget()
        size = 2 * BLOCK
        self.up, self.down = self._powers(size)

    def _forget(self) -> None:
        self.known = np.zeros(1 << SLOT_BITS, np.uint64)  # hashes by slot, 0 in a free one
        self.numbers = np.zeros(1 << SLOT_BITS, np.int32)  # their places
        self.kept, self.bounds, self.flat = 0, np.zeros(KEPT_PIECES + 1, np.int64), np.zeros(1 << 16, np.uint32)  # ids of each place

    @staticmethod
    def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = _BASE, pow(_BASE, -1, 1 << 64)
        return np.multiply.accumulate(up), np.multiply.accumulate(down)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens added."""
        out: list = [None] * len(texts)
        plain = []
        for at, text in enumerate(texts):
            if not text:
                out[at] = np.zeros(0, np.int64)
            elif self.special and self.special.search(text) or len(text) > BLOCK:
                out[at] = self._whole(text)
            else:
                plain.append(at)
        for first, after in blocks([len(texts[at]) for at in plain], BLOCK):
            mine = plain[first:after]
            for at, ids in zip(mine, self._block([texts[at] for at in mine])):
                out[at] = ids
        return out

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\n".join(["", *texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        edges = np.cumsum([0, *(len(text) + 1 for text in texts)])
        kinds = _kinds()[points]
        kinds[edges] = EDGE
        strange = np.add.reduceat(kinds == UNKNOWN, edges[:-1]) > 0
        starts = _piece_starts(points, kinds)
        ends = np.append(starts[1:], len(points))
        inside = kinds[starts] != EDGE
        starts, ends = starts[inside], ends[inside]
        numbers = self._numbers(self._hashes(joined, points, starts, ends), points, starts, ends)
        first = self.bounds[numbers]
        size = self.bounds[numbers + 1] - first
        after = np.cumsum(size)
        ids = self.flat[np.repeat(first - after + size, size) + np.arange(size.sum())].astype(np.int64)
        cuts = np.append(0, after)[np.searchsorted(starts, edges)]
        return [
            self._whole(text) if odd else ids[a:b] for text, odd, a, b in zip(texts, strange, cuts[:-1], cuts[1:])
        ]

    def _hashes(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(points) > len(self.up):
            self.up, self.down = self._powers(2 * len(points))
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(self.up[: len(points)] * (points.astype(np.uint64) + np.uint64(1)), out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.down[starts]) ^ (ends - starts).astype(np.uint64)
        for at in np.flatnonzero(ends - starts > LONGEST).tolist():  # sums of powers are weak for long ones
            hashes[at] = xxhash.xxh3_64_intdigest(joined[starts[at] : ends[at]])
        return np.maximum(hashes, np.uint64(1))

    def _numbers(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of pieces in the table, which takes up new ones."""
        numbers = self._found(hashes)
        fresh = np.flatnonzero(numbers < 0)
        if not len(fresh):
            return numbers
        new, at, codes = np.unique(hashes[fresh], return_index=True, return_inverse=True)
        if self.kept and self.kept + len(new) > KEPT_PIECES:
            self._forget()
            return self._numbers(hashes, points, starts, ends)
        numbers[fresh] = self._learn(new, points, starts[fresh[at]], ends[fresh[at]])[codes]
        return numbers

    @staticmethod
    def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First slots, and steps to the following ones."""
        low = hashes & np.uint64((1 << SLOT_BITS) - 1)
        return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64), low.astype(np.int64) | 1

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        """Places of pieces, -1 for unknown ones."""
        slot, step = self._slots(hashes)
        held = self.known[slot]
        numbers = np.where(held == hashes, self.numbers[slot], -1).astype(np.int64)
        waiting = np.flatnonzero((held != hashes) & (held != 0))
        while len(waiting):
            slot[waiting] = (slot[waiting] + step[waiting]) % (1 << SLOT_BITS)
            held = self.known[slot[waiting]]
            same = held == hashes[waiting]
            numbers[waiting[same]] = self.numbers[slot[waiting[same]]]
            waiting = waiting[~same & (held != 0)]
        return numbers

    def _learn(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of pieces that are not in the table yet, each given once."""
        size = ends - starts
        after = np.cumsum(size)
        inside = points[np.repeat(starts - after + size, size) + np.arange(after[-1])]
        letters = _LETTERS[np.frombuffer(inside.tobytes().decode("utf-32-le").encode(), np.uint8)].tobytes().decode("utf-16-le")
        cuts = np.append(0, np.cumsum(1 + (inside > 0x7F) + (inside > 0x7FF) + (inside > 0xFFFF)))[after].tolist()
        tokenize = self.tokenizer.model.tokenize
        found = [tokenize(letters[a:b]) for a, b in zip([0, *cuts], cuts)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), np.uint32, int(sizes.sum()))
        kept, used = self.kept, int(self.bounds[self.kept])
        if used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat[:used], np.zeros(used + len(ids), np.uint32))
        self.bounds[kept + 1 : kept + len(found) + 1] = used + np.cumsum(sizes)
        self.flat[used : used + len(ids)] = ids
        self.kept += len(found)
        numbers = np.arange(kept, self.kept)
        slot, step = self._slots(hashes)
        waiting = np.arange(len(hashes))
        while len(waiting):
            free = waiting[self.known[slot[waiting]] == 0]
            self.known[slot[free]] = hashes[free]  # of several for one slot the last one stays
            there = self.known[slot[waiting]] == hashes[waiting]
            self.numbers[slot[waiting[there]]] = numbers[waiting[there]]
            waiting = waiting[~there]
            slot[waiting] = (slot[waiting] + step[waiting]) % (1 << SLOT_BITS)
        return numbers


def _byte_letters() -> np.ndarray:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 characters stand for
    themselves, the others take the next characters beyond, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [n for n in range(256) if n not in visible]
    letters = np.arange(256, dtype="<u2")
    letters[hidden] = 256 + np.arange(len(hidden))
    return letters


_LETTERS = _byte_letters()


def _piece_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pieces start; an edge is a piece of its own.

    A piece is a run of one kind with one blank before it; of a run of white space before another
    kind the last character stands apart; an apostrophe after neither takes the ending ``s t re ve m
    ll d`` with it."""
    start = np.ones(len(points), bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == EDGE)
    after = np.flatnonzero(start[1:] & (kinds[:-1] == SPACE) & (kinds[1:] != EDGE)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    marks = np.flatnonzero(start[:-1] & (points[:-1] == 39))
    marks = marks[kinds[marks + 1] == LETTER]
    if len(marks):
        one, two = points[marks + 1], points[np.minimum(marks + 2, len(points) - 1)]
        size = np.isin(one, [ord(c) for c in "stmd"]).astype(int)
        for ending in ("re", "ve", "ll"):
            size[(one == ord(ending[0])) & (two == ord(ending[1]))] = 2
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        start[marks + 1 + size] = True
    return np.flatnonzero(start)
