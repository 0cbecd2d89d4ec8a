"""Word-shingle sets and MinHash signatures of many texts at once, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 2 + 1
_MIX = [np.uint64(int(x) * 2 + 1) for x in _rng.integers(1 << 40, 1 << 62, 8)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _powers[name] = np.cumprod(
                    np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64
                )
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


#: Ranges are known by polynomials modulo this prime with a random base: two different ranges of n bytes are equal with a
#: chance of n / 2**61. (Modulo a power of two, structured texts would be equal whatever the base.)
PRIME = np.uint64((1 << 61) - 1)
_PRIME_BASE = int(_rng.integers(1 << 59, (1 << 61) - 1))
_LOW = [np.uint64((1 << k) - 1) for k in range(64)]


def _folded(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _shifted(x: np.ndarray, k: int) -> np.ndarray:
    """x * 2**k modulo the prime, for any x."""
    x = _folded(x)
    return _folded(((x & _LOW[61 - k]) << np.uint64(k)) | (x >> np.uint64(61 - k)))


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo the prime, for x and y below it."""
    x1, x0, y1, y0 = x >> np.uint64(31), x & _LOW[31], y >> np.uint64(31), y & _LOW[31]
    mid = x1 * y0 + x0 * y1
    return _folded(((x1 * y1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & _LOW[30]) << np.uint64(31)) + x0 * y0)


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo the prime for i < n."""
    if len(_powers.get("prime_up", ())) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        for name, base in (("prime_up", _PRIME_BASE), ("prime_down", pow(_PRIME_BASE, -1, int(PRIME)))):
            out = np.ones(size, np.uint64)
            k = 1
            while k < size:
                out[k : 2 * k] = times(out[:k], np.full(k, pow(base, k, int(PRIME)), np.uint64))
                k *= 2
            _powers[name] = out
    return _powers["prime_up"], _powers["prime_down"]


class Ranges:
    """Bytes, of which any range is hashed at once: equal hashes for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.down = prime_powers(n + 1)[1]
        up, value = prime_powers(n + 1)[0][:n], data.astype(np.uint64) + np.uint64(1)
        # Sums of three limbs of 21 bits don't overflow below 2**34 bytes, and are only reduced where they are looked up.
        self.sums = np.zeros((3, n + 1), np.uint64)
        for k in range(3):
            np.cumsum(((up >> np.uint64(21 * k)) & _LOW[21]) * value, out=self.sums[k, 1:], dtype=np.uint64)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        low, mid, high = (s[ends] - s[starts] for s in self.sums)
        total = _folded(_folded(low) + _shifted(mid, 21) + _shifted(high, 42))
        return mix(times(total, self.down[starts]) + (ends - starts).astype(np.uint64) * _MIX[2])


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] (uint8), equal for equal bytes wherever they stand."""
    return Ranges(data).hashes(starts, ends)


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, A-Z in lower case if asked; number of the text that it is in) of all texts in order."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    if lower:
        raw = [r.lower() for r in raw]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([len(r) + 1 for r in raw])
    return range_hashes(data, starts, ends), np.searchsorted(bounds, starts, side="right")


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within a text, and where each text's begin (n + 1 offsets).

    A text with fewer words than `size` is one shingle; one without words has none.
    """
    words, where = word_hashes(texts)
    n = len(words)
    counts = np.bincount(where, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total = mix(total + words[k : n - size + 1 + k] * _MIX[3])
        inside = where[: n - size + 1] == where[size - 1 :]
        value, owner = total[inside], where[: n - size + 1][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            here = counts[short] > k
            at = begin[short] + k
            extra[here] = mix(extra[here] + words[at[here]] * _MIX[4])
        extra = mix(extra + counts[short].astype(np.uint64) * _MIX[5])
        value, owner = np.concatenate([value, extra]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        value, owner = value[new], owner[new]
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    return value, offsets


def signatures(value: np.ndarray, offsets: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash signatures, one row of `hashes` 32-bit values per text; rows of empty sets are all ones."""
    n = len(offsets) - 1
    out = np.full((n, hashes), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if not len(full):
        return out
    starts = offsets[:-1][full]
    rng = np.random.Generator(np.random.PCG64(7))
    factors = rng.integers(1 << 40, 1 << 62, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k in range(hashes):
        # multiply, then the high half: a family of hash functions that are close to min-wise independent
        h = ((value ^ factors[-1 - k]) * factors[k]) >> np.uint64(32)
        out[full, k] = np.minimum.reduceat(h, starts).astype(np.uint32)
    return out


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
