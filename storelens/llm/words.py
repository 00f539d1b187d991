"""Words of a text and hashes over runs of them (numpy, inside tasks).

Words are cut at the ASCII white space 0x20 and 0x09-0x0D, which is exactly
what ``bytes.split()`` does, so every function takes the UTF-8 bytes of a text.
"""

from __future__ import annotations

import numpy as np
import xxhash

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)   # odd, so they can be inverted
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int, multiplier: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers.get(multiplier, (np.empty(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, 1 << 15)
        up = np.cumprod(np.full(size, multiplier, np.uint64))
        down = np.cumprod(np.full(size, pow(multiplier, -1, 1 << 64), np.uint64))
        _powers[multiplier] = up, down
    return up[:n], down[:n]


class Rolling:
    """Hashes of any run of words of one text, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        up, self.down = _power_tables(len(hashes) + 1, MULTIPLIERS[which])
        self.prefix = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=self.prefix[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.prefix) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.down[:n])


def shingle_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """One hash per window of ``length`` words; a shorter text is one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return Rolling(hashes).windows(min(length, len(hashes)))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, where the smallest stands (leftmost of equals).

    Values are compared by their high 40 bits; the low 24 hold the place, so the
    array is worked through in slices of 2**23 runs.
    """
    out, step = [], 1 << 23
    for at in range(0, max(0, len(values) - width + 1), step):
        part = values[at:at + step + width - 1]
        best = (part & ~np.uint64(0xFFFFFF)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            best, span = np.minimum(best[:-span], best[span:]), span * 2
        if span < width:
            best = np.minimum(best[:-(width - span)], best[width - span:])
        out.append((best & np.uint64(0xFFFFFF)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.empty(0, np.int64)


# Bytes: 0-9, a-z and everything from 0x80 stay, A-Z are lower-cased, the rest parts words.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def plain_words(text: str | bytes | None) -> list[bytes]:
    """Words without ASCII punctuation and white space, A-Z lower-cased."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()
