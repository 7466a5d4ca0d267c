"""Token ids of whole texts, with the tokenizer library asked once per distinct pre-token.

A byte-level BPE encodes each pre-token on its own, so equal pre-tokens have equal ids. The borders of
pre-tokens are found for a whole chunk of code points at once; only pre-tokens that a worker has not
seen go to the library. Character classes are read off the tokenizer itself.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
from tokenizers import Tokenizer

from pagemill.llm.hashing import _BASE, mix

SPACE, LETTER, NUMBER, OTHER = range(4)
# Code points from here on are left to the library, with the whole text they are in.
CLASS_LIMIT = 0x3000
# Entries a worker remembers; beyond that it forgets the rare ones, which costs time only.
CACHE_ENTRIES = 200_000
# What may follow an apostrophe as one pre-token.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _character_classes(tokenizer: Tokenizer) -> np.ndarray:
    """Class of each code point: whether it joins a letter, a number or a sign before it."""
    table = np.full(CLASS_LIMIT + 1, SPACE, dtype=np.uint8)
    points = [c for c in range(CLASS_LIMIT) if not 0xD800 <= c < 0xE000]
    for kind, sample in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        probe = "".join(f"{sample}{chr(c)}\n" for c in points)
        joined = {start for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(probe) if end - start > 1}
        for n, c in enumerate(points):
            if 3 * n in joined:
                table[c] = kind
    table[CLASS_LIMIT] = OTHER
    return table


def _byte_spelling() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + n) for n, b in enumerate(others)}


class CachedEncoder:
    """``encode(texts)`` gives the ids the library gives, as one array with offsets."""

    def __init__(self, path: str, end_id: int = 0):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.classes = _character_classes(self.tokenizer)
        self.spelling = _byte_spelling()
        self.codes = mix(np.arange(1, CLASS_LIMIT + 2, dtype=np.uint64))
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)
        self.end_id = end_id
        self.known: dict[int, int] = {}
        # Entry 0 is the end of a document.
        self.flat = np.array([self.end_id], dtype=np.uint32)
        self.first, self.count = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)
        # Calls in which an entry was met.
        self.met = np.ones(1, dtype=np.int64)

    def _forget(self) -> None:
        """Drop entries that were met in one call only, or all if that leaves too many."""
        stays = self.met > 1
        if stays.sum() > CACHE_ENTRIES // 2:
            stays[:] = False
        stays[0] = True
        kept = np.flatnonzero(stays)
        number = np.cumsum(stays) - 1
        self.known = {h: int(number[e]) for h, e in self.known.items() if stays[e]}
        counts = self.count[kept]
        first = np.cumsum(counts) - counts
        self.flat = self.flat[np.repeat(self.first[kept] - first, counts) + np.arange(counts.sum())]
        self.first, self.count, self.met = first, counts, np.ones(len(kept), dtype=np.int64)

    def _borders(self, points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pre-tokens start."""
        kind = self.classes[points]
        blank = kind == SPACE
        same = np.ones(len(points), dtype=bool)  # has a predecessor in its text
        same[begins] = False
        change = ~same
        change[1:] |= kind[1:] != kind[:-1]
        after_space = same.copy()
        after_space[1:] &= points[:-1] == 32
        start = change & (blank | ~after_space)
        # The last blank before something else stands apart from a longer run.
        start[:-1] |= blank[:-1] & ~blank[1:] & same[1:]
        for i in np.flatnonzero(start & (points == 39)):
            end = ends[np.searchsorted(ends, i, side="right")]
            tail = "".join(map(chr, points[i + 1 : min(i + 3, end)]))
            part = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
            if part:
                start[i + 1] = False
                if i + 1 + len(part) < end:
                    start[i + 1 + len(part)] = True
        return np.flatnonzero(start)

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        # A pre-token goes to the model in its byte-level spelling, as the pre-tokenizer would give it.
        model, spelling = self.tokenizer.model, self.spelling
        coded = [
            [t.id for t in model.tokenize(w.encode("utf-8", "replace").decode("latin-1").translate(spelling))]
            for w in words
        ]
        counts = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        first = len(self.flat) + np.cumsum(counts) - counts
        self.known.update(zip(hashes, range(len(self.first), len(self.first) + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(coded), dtype=np.uint32)])
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, counts])
        self.met = np.concatenate([self.met, np.zeros(len(words), dtype=np.int64)])

    def _hashes(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(points) + 1
        if n > len(self.powers):
            pair = [np.full(n, f, dtype=np.uint64) for f in (_BASE, pow(_BASE, -1, 1 << 64))]
            for p in pair:
                p[0] = 1
            self.powers, self.inverse = (np.multiply.accumulate(p) for p in pair)
        prefix = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.codes[points] * self.powers[: n - 1], out=prefix[1:])
        return mix((prefix[end] - prefix[start]) * self.inverse[start])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the offsets of the texts."""
        if len(self.known) > CACHE_ENTRIES:
            self._forget()
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        offsets = np.cumsum([0, *map(len, texts)])
        foreign = np.zeros(len(texts), dtype=bool)
        if len(points) and points.max() >= CLASS_LIMIT:
            before = np.concatenate([[0], np.cumsum(points >= CLASS_LIMIT)])
            foreign = before[offsets[1:]] > before[offsets[:-1]]
            points = np.minimum(points, np.uint32(CLASS_LIMIT))
        begins = offsets[:-1][np.diff(offsets) > 0]
        starts = self._borders(points, begins, offsets[1:]) if len(points) else np.empty(0, dtype=np.int64)
        stops = np.append(starts[1:], len(points))
        before = np.searchsorted(starts, offsets)
        wanted = np.repeat(~foreign, np.diff(before))
        starts, stops = starts[wanted], stops[wanted]
        before = np.concatenate([[0], np.cumsum(np.where(foreign, 0, np.diff(before)))])
        distinct, place, back = np.unique(self._hashes(points, starts, stops), return_index=True, return_inverse=True)
        new = [(h, p) for h, p in zip(distinct.tolist(), place.tolist(), strict=True) if h not in self.known]
        if new:
            self._learn([h for h, _ in new], [joined[starts[p] : stops[p]] for _, p in new])
        entry = np.fromiter((self.known[h] for h in distinct.tolist()), dtype=np.int64, count=len(distinct))
        self.met[entry] += 1
        entry = entry[back]
        entry = np.insert(entry, before[1:], 0)
        counts = self.count[entry]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self.flat[np.repeat(self.first[entry] - total[:-1], counts) + np.arange(total[-1])]
        ends = total[before + np.arange(len(before))]
        if foreign.any():
            return self._with_foreign(texts, foreign, ids, ends)
        return ids, ends

    def _with_foreign(self, texts: list[str], foreign: np.ndarray, ids: np.ndarray, ends: np.ndarray):
        parts = []
        for n, text in enumerate(texts):
            part = ids[ends[n] : ends[n + 1]]
            if foreign[n]:
                coded = self.tokenizer.encode(text, add_special_tokens=False).ids
                part = np.array([*coded, self.end_id], dtype=np.uint32)
            parts.append(part)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> CachedEncoder:
    """One encoder per Python worker."""
    return CachedEncoder(path)
