"""Byte-level BPE encoding and decoding (operator 5).

Method: the bytes of a pre-token are mapped to Latin-1 characters so that a pyahocorasick automaton over the
vocabulary reports every vocabulary entry that starts at a position. Encoding walks left to right with the longest
entry, and backs off to shorter ones when two neighbouring tokens could not stand side by side in the output of the
merge procedure. Whether a pair may stand together depends on the two tokens only and is memoised, and positions that
were found to lead nowhere are never tried again, so the work is linear in the text and the result is exactly that of
applying merges by rank.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import map_rows, only

#: Pre-tokens whose ids a worker keeps in each of two generations; the older one is dropped when the newer is full.
CACHE_ENTRIES = 350_000


class ByteBPE:
    """One vocabulary of ranks, `token bytes -> id`, ids in merge order."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.trie = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (i, len(token)))
        self.trie.make_automaton()
        self.parts: dict[int, tuple[int, int]] = {}  # token -> the two tokens whose merge makes it
        self.merges: dict[tuple[int, int], int] = {}  # and back
        self.together: dict[tuple[int, int], bool] = {}
        for token, i in sorted(ranks.items(), key=lambda kv: kv[1]):
            self._learn(token, i)
        self.together.clear()  # answers given while merges were still missing
        self.decimal = {str(i): token for i, token in enumerate(self.tokens)}
        self.cache: dict[str, str] = {}  # pre-token -> its ids in decimal, joined by a space
        self.older: dict[str, str] = {}

    def _learn(self, token: bytes, i: int) -> None:
        """Find the last merge of a token: its halves have smaller ids and may stand side by side without it."""
        for at in range(len(token) - 1, 0, -1):
            a, b = self.ranks.get(token[:at]), self.ranks.get(token[at:])
            if a is not None and b is not None and a < i and b < i and self._pair_ok(a, b):
                self.parts[i] = (a, b)
                self.merges[a, b] = i
                return

    def _pair_ok(self, left: int, right: int) -> bool:
        """Would merging by rank leave `left`, `right` apart? No merge that crosses the border may come first.

        Undo the later of the two tokens' last merges again and again; every pair that meets at the border on the
        way must not merge earlier than the merge that was undone.
        """
        bound = len(self.tokens) + 1
        while True:
            if self.merges.get((left, right), bound) < bound:
                return False
            halves_l, halves_r = self.parts.get(left), self.parts.get(right)
            if halves_l is None and halves_r is None:
                return True
            if halves_r is None or (halves_l is not None and left > right):
                bound, left = left, halves_l[1]
            else:
                bound, right = right + 1, halves_r[0]

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.together.get(key)
        if known is None:
            if len(self.together) > 2_000_000:
                self.together.clear()
            known = self.together[key] = self._pair_ok(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # by position, shortest token first
        for end, (i, size) in self.trie.iter(piece.decode("latin-1")):
            starts[end - size + 1].append((size, i))
        dead = bytearray(n + 1)  # positions that are known to lead nowhere
        ids: list[int] = []
        ends = [0]
        choice = [len(starts[0]) - 1]  # for each open position, the next candidate to try
        while True:
            at, k = ends[-1], choice[-1]
            found = None
            while k >= 0:
                size, i = starts[at][k]
                k -= 1
                if not dead[at + size] and (not ids or self.fits(ids[-1], i)):
                    found = (at + size, i)
                    break
            choice[-1] = k
            if found is None:
                # Which tokens may follow depends on the last token too, but a valid encoding of a prefix is
                # unique, so a position is reached by one token only and can be closed for good.
                dead[at] = 1
                ends.pop()
                choice.pop()
                if not ids:
                    raise ValueError("a byte of the text is not in the vocabulary")
                ids.pop()
                continue
            ends.append(found[0])
            ids.append(found[1])
            if found[0] == n:
                return ids
            choice.append(len(starts[found[0]]) - 1)

    def _remember(self, piece: str) -> str:
        if len(self.cache) >= CACHE_ENTRIES:
            self.older, self.cache = self.cache, {}
        coded = self.cache.get(piece) or self.older.get(piece) or " ".join(map(str, self.encode_piece(piece.encode("utf-8"))))
        self.cache[piece] = coded
        return coded

    def encode_decimal(self, text: str) -> str:
        """The ids of a whole text in decimal, joined by a space."""
        cache, more = self.cache, self._remember
        return " ".join([cache.get(piece) or more(piece) for piece in self.find(text)])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_decimal(text).split()]

    def decode_decimal(self, coded: str) -> bytes:
        return b"".join(map(self.decimal.__getitem__, coded.split()))

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_loaded: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    """The vocabulary of this worker process; read once."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, ids array<int>` of whole texts.

    Null text is empty; an empty text has no ids; null, repeated and tied ids stay as rows of their own; other
    columns are ignored, whatever they are called.
    """

    def make():
        c = codec(path, pattern)
        return lambda ids, texts: [(i, c.encode(t or "")) for i, t in zip(ids, texts, strict=True)]

    return map_rows(only(docs, doc_id="long", text="string"), "doc_id long, ids array<int>", make)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, bytes binary` from `doc_id, ids`; null ids give empty bytes."""

    def make():
        c = codec(path, pattern)
        return lambda keys, ids: [(k, c.decode(x or ())) for k, x in zip(keys, ids, strict=True)]

    frame = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return map_rows(frame, "doc_id long, bytes binary", make)


def encode_decode_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: `n_tokens`, the digest of its ids in decimal, and the digest of the bytes decoded from them.

    Both directions run in one pass over the texts; the cases are those of `encode`.
    """

    def make():
        c = codec(path, pattern)

        def rows(ids, texts):
            out = []
            for i, t in zip(ids, texts, strict=True):
                coded = c.encode_decimal(t or "")
                plain = c.decode_decimal(coded)
                n = coded.count(" ") + 1 if coded else 0
                out.append((i, n, hashlib.sha256(coded.encode()).hexdigest(), hashlib.sha256(plain).hexdigest()))
            return out

        return rows

    return map_rows(
        only(docs, doc_id="long", text="string"),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        make,
    )
