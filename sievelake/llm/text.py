"""Words and helpers that several operators share."""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of code points that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other code point as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores as make it differ from all columns of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INK = np.ones(256, dtype=bool)
_INK[[9, 10, 11, 12, 13, 32]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Words:
    """The words of a few texts: a 64-bit hash of each word in ASCII lower case, and the text it belongs to.

    The hash of a word is a polynomial in its bytes modulo 2^64, taken from running sums, so that
    all words of all texts are hashed in a few passes over the bytes.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(self.raw)
        ink = np.zeros(n + 2, dtype=bool)
        ink[1:-1] = _INK[self.raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.bounds] = True
        self.starts = np.flatnonzero(ink[1:] & (~ink[:-1] | edge) & np.append(ink[1:-1], False))
        self.ends = np.flatnonzero(ink[:-1] & (~ink[1:] | edge) & np.append(False, ink[1:-1]))
        with np.errstate(over="ignore"):
            powers = np.full(n + 1, _BASE)
            powers[0] = 1
            np.cumprod(powers, out=powers)
            terms = (_LOWER[self.raw].astype(np.uint64) + np.uint64(1)) * powers[:n]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
            back = np.full(n + 1, _INVERSE)
            back[0] = 1
            np.cumprod(back, out=back)
            length = (self.ends - self.starts).astype(np.uint64)
            self.hashes = mix((sums[self.ends] - sums[self.starts]) * back[self.starts] + mix(length))
        self.first = np.searchsorted(self.starts, self.bounds)  # of each text; one more at the end
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def shingles(self, n: int) -> list[np.ndarray]:
        """For each text the sorted distinct hashes of its runs of `n` words; of fewer words, of all of them."""
        h, out = self.hashes, []
        with np.errstate(over="ignore"):
            run = np.full(max(0, len(h) - n + 1), np.uint64(n))
            for i in range(n):
                run = mix(run * _BASE + h[i : i + len(run)])
            for a, b in zip(self.first[:-1], self.first[1:]):
                if b - a >= n:
                    out.append(np.unique(run[a : b - n + 1]))
                elif b > a:
                    one = np.uint64(b - a)
                    for x in h[a:b]:
                        one = mix(np.array([one * _BASE + x]))[0]
                    out.append(np.array([one]))
                else:
                    out.append(np.array([], dtype=np.uint64))
        return out


def blocks(texts: list[str | None], most: int = 2_000_000):
    """Runs (first, end, bytes of each text) of at most `most` bytes, or of one text."""
    first, size, held = 0, 0, []
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if held and size + len(data) > most:
            yield first, i, held
            first, size, held = i, 0, []
        held.append(data)
        size += len(data)
    if held:
        yield first, len(texts), held
