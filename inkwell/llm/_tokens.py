"""Words and their hashes, vectorised over slices of an Arrow batch.

Words are maximal runs of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``), which is what ``bytes.split()`` yields.  A word
hashes to 64 bits; a run of n words hashes as a polynomial over the word
hashes modulo 2**64, taken for all positions at once from prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U64 = np.uint64
MASK = (1 << 64) - 1
# Odd multipliers of the polynomial hashes (any odd numbers will do).
M1 = 0x9E3779B97F4A7C15
M2 = 0xC2B2AE3D27D4EB4F
# Characters of text that are hashed in one go.
SLICE_CHARS = 1_500_000
# Distinct words kept between slices; a larger cache is dropped, not extended.
CACHE_WORDS = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class WordHashes(dict):
    """word -> 64-bit hash, remembered per Python worker."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """m**i and m**-i modulo 2**64 for i < n."""
    have = _powers.get(m)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for base in (m, pow(m, -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _powers[m] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class Rolling:
    """Hashes of word ranges ``[i, j)`` of one sequence of word hashes."""

    def __init__(self, hashes: np.ndarray, m: int = M1):
        self.inverse = powers(m, len(hashes) + 1)[1]
        self.sums = np.zeros(len(hashes) + 1, U64)
        np.cumsum(hashes * powers(m, len(hashes) + 1)[0][:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, n: int) -> np.ndarray:
        """Hash of words i .. i+n-1 for every i."""
        k = len(self.sums) - n
        if k <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[n:] - self.sums[:k]) * self.inverse[:k])


def encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def split_words(text: str | None) -> list[bytes]:
    return encode(text).split()


def slices(texts: list[str | None], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of texts of about ``chars`` characters (one text at least)."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text or "") > chars:
            yield start, i
            start, total = i, 0
        total += len(text or "") + 1
    if start < len(texts):
        yield start, len(texts)


def hash_slice(cache: WordHashes, texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, the hashes of all of them, and each text's offset."""
    words = [split_words(t) for t in texts]
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    flat: list[bytes] = []
    for w in words:
        flat += w
    return words, cache.of(flat), offsets
