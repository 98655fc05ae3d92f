"""Hashed features of texts: words, stems, n-grams and skip-grams, each counted once a text."""

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import xxhash

from sheafspark.llm.arrow_text import SLICE_BYTES, white_space_blocks

#: Hash buckets of all features together.
BUCKETS = 1 << 20
#: Distinct words whose hashes a task keeps; beyond that it starts over.
KEPT_WORDS = 80_000
#: Words that a task turns into features at a time.
CHUNK_WORDS = 1 << 17
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "¡¿«»“”„‘’…–—·"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_tokens(word: str) -> list[str]:
    """The word in lower case without punctuation at its ends, and its stems: the first 4 and the first 5 characters."""
    word = word.lower().strip(_EDGE)
    return [word, "4" + word[:4] if len(word) >= 4 else "", "5" + word[:5] if len(word) >= 5 else ""]


def shape_tokens(word: str) -> list[str]:
    """The kinds of characters in the word, runs of letters and digits as one, and the last three other ones."""
    kinds, last = [], ""
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        if kind != last or kind not in "aA0":
            kinds.append(kind)
        last = kind
    return ["s" + "".join(kinds), "e" + "".join(k for k in kinds if k not in "aA0")[-3:], ""]


def windows(words: list[bytes], longest: int) -> Iterator[bytes]:
    """The words; one of more than ``longest`` characters as windows of so many, each half over the one before."""
    for word in words:
        if len(word) <= longest or len(text := word.decode()) <= longest:
            yield word
        else:
            for start in range(0, len(text) - longest // 2, longest // 2):
                yield text[start : start + longest].encode()


class Hasher:
    """Turns texts into (text number, feature) pairs without repeats; words are memoised.

    With ``longest``, longer words are read as a sequence of :func:`windows`.
    """

    def __init__(self, tokens: Callable[[str], list[str]], buckets: int = BUCKETS, longest: int | None = None):
        self.tokens, self.buckets, self.longest = tokens, np.uint64(buckets), longest
        self.clear()

    def _words(self, text: bytes) -> list[bytes]:
        words = text.split()
        if self.longest and max(map(len, words), default=0) > self.longest:
            return list(windows(words, self.longest))
        return words

    def _chunks(self, text: bytes) -> Iterator[list[bytes]]:
        for block in white_space_blocks(text):
            words = windows(block.split(), self.longest) if self.longest else iter(block.split())
            while chunk := list(islice(words, CHUNK_WORDS)):
                yield chunk

    def clear(self) -> None:
        self.known, self.hashes = {}, np.empty((0, 3), np.uint64)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        try:
            return self.hashes[list(map(self.known.__getitem__, words))]
        except KeyError:
            if len(self.known) > KEPT_WORDS:
                self.clear()
            new = [w for w in dict.fromkeys(words) if w not in self.known]
            digest = xxhash.xxh64_intdigest
            rows = [[digest(t) if t else 0 for t in self.tokens(w.decode())] for w in new]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.hashes = np.concatenate([self.hashes, np.array(rows, np.uint64).reshape(-1, 3)])
            return self.hashes[list(map(self.known.__getitem__, words))]

    def _features(self, words: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self._rows(words) if words else np.empty((0, 3), np.uint64)
        first = rows[:, 0]
        found = [(owner, rows[:, k], rows[:, k] != 0) for k in range(3)]
        for step in (1, 2):  # pairs of neighbours, and pairs with one word between
            left, right = first[:-step], first[step:]
            pair = _mixed(left + np.uint64(step)) ^ (right * np.uint64(2 * step + 1))
            found.append((owner[:-step], pair, (owner[:-step] == owner[step:]) & (left != 0) & (right != 0)))
        at = np.concatenate([o[keep] for o, _, keep in found])
        features = np.concatenate([_mixed(x[keep] + np.uint64(k)) for k, (_, x, keep) in enumerate(found)]) % self.buckets
        return at, features.astype(np.int64)

    def pairs(self, texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Text numbers and features, each pair once, sorted. ``wanted`` marks the features to keep, if not all."""
        parts = []
        if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
            tail: list[bytes] = []
            for chunk in self._chunks(texts[0]):
                words = tail + chunk  # pairs reach over the cut
                tail = words[-2:]
                parts.append(self._kept(*self._features(words, np.zeros(len(words), np.int64)), wanted))
        else:
            split = [self._words(t) for t in texts]
            owner = np.repeat(np.arange(len(texts)), list(map(len, split)))
            parts.append(self._kept(*self._features([w for s in split for w in s], owner), wanted))
        whole = np.unique(np.concatenate(parts))
        return whole // int(self.buckets), whole % int(self.buckets)

    def _kept(self, at: np.ndarray, features: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
        if wanted is not None:
            keep = wanted[features]
            at, features = at[keep], features[keep]
        return np.unique(at * int(self.buckets) + features)
