"""Runs of words as hash buckets (crc32 of the words joined by one space), for many texts at once, in numpy.

crc32 is linear: the register after `a` and then `b` is that of `a` carried over the length of `b` in zero bytes,
xor that of `b` from a zero register. So each word's bytes are read once, and runs of words follow from the words.
"""

from __future__ import annotations

import zlib

import numpy as np

_ONES = np.uint32(0xFFFFFFFF)
#: Longer words leave the table of carries and the byte-by-byte pass.
SHORT = 128


def _tables() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    carry = np.zeros((SHORT, 4, 256), np.uint32)
    carry[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, SHORT):
        carry[n] = step[carry[n - 1] & 255] ^ (carry[n - 1] >> 8)
    far = [step[carry[SHORT - 1] & 255] ^ (carry[SHORT - 1] >> 8)]  # SHORT zero bytes, then twice as many each
    for _ in range(40):
        far.append(_carried(far[-1], far[-1]))
    return step, carry, far


def _carried(table: np.ndarray, r: np.ndarray) -> np.ndarray:
    return table[0][r & 255] ^ table[1][(r >> 8) & 255] ^ table[2][(r >> 16) & 255] ^ table[3][r >> 24]


STEP, CARRY, FAR = _tables()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Digits, a-z and every byte of a character beyond ASCII
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def carried(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers `r` after n zero bytes each."""
    low = n % SHORT
    out = CARRY[low, 0, r & 255] ^ CARRY[low, 1, (r >> 8) & 255] ^ CARRY[low, 2, (r >> 16) & 255] ^ CARRY[low, 3, r >> 24]
    high = n // SHORT
    for table in FAR if high.any() else ():
        odd = np.flatnonzero(high & 1)
        out[odd] = _carried(table, out[odd])
        high = high >> 1
    return out


class Words:
    """Words of several texts in order: where each begins and ends, and the text and line that it is in."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
        inside = np.concatenate([[False], _WORD[self.data]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edge[0::2], edge[1::2]
        bounds = np.cumsum([len(r) + 1 for r in raw])
        self.text = np.searchsorted(bounds, self.starts, side="right")
        self.line = np.cumsum(self.data == 10)[self.starts]

    def counts(self, n_texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n_texts).astype(np.int64)

    def _registers(self, which: np.ndarray) -> np.ndarray:
        """The register after each of these words from a zero register."""
        order = which[np.argsort(self.starts[which] - self.ends[which], kind="stable")]  # longest first
        length = self.ends[order] - self.starts[order]
        r = np.zeros(len(order), np.uint32)
        begin = int(np.searchsorted(-length, -SHORT, side="right"))
        for k in range(begin):
            word = self.data[self.starts[order[k]] : self.ends[order[k]]]
            r[k] = np.uint32(zlib.crc32(word.tobytes())) ^ _ONES
        r[:begin] ^= carried(np.full(begin, _ONES), length[:begin])
        for k in range(int(length[begin]) if begin < len(order) else 0):
            end = int(np.searchsorted(-length, -k, side="left"))
            now = r[begin:end]
            r[begin:end] = STEP[(now ^ self.data[self.starts[order[begin:end]] + k]) & 255] ^ (now >> 8)
        out = np.zeros(len(self.starts), np.uint32)
        out[order] = r
        return out

    def runs(self, buckets: int, crossing: bool, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of all runs of 1 to `longest` words, ordered by text; only those over a line's end if `crossing`."""
        n = len(self.starts)
        first = {}
        for size in range(2 if crossing else 1, min(longest, n) + 1):
            last = slice(size - 1, n)
            good = self.text[: n - size + 1] == self.text[last]
            if crossing:
                good &= self.line[: n - size + 1] != self.line[last]
            first[size] = np.flatnonzero(good)
        used = np.zeros(n, bool)
        for size, at in first.items():
            for k in range(size):
                used[at + k] = True
        own, length = self._registers(np.flatnonzero(used)), self.ends - self.starts
        texts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, at in first.items():
            r = carried(np.full(len(at), _ONES), length[at]) ^ own[at]
            for k in range(1, size):
                more = length[at + k]
                r = carried(r, more + 1) ^ carried(np.full(len(at), STEP[32]), more) ^ own[at + k]
            texts.append(self.text[at])
            found.append(((r ^ _ONES) % np.uint32(buckets)).astype(np.int64))
        text, bucket = np.concatenate(texts), np.concatenate(found)
        order = np.argsort(text, kind="stable")
        return text[order], bucket[order]
