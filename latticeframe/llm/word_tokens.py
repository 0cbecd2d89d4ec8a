"""Whole-text tokenising with a cache per word, for tokenizers that never join across white space."""

from __future__ import annotations

import os
import re
from array import array

#: Entries of each of two generations of the caches of words and of runs
WORDS, RUNS = 500_000, 250_000
#: White space for str.split, but not for the tokenizer
_odd = re.compile("[\x1c-\x1f]")
#: Letters whose lower-case form doesn't depend on what stands around them, then ASCII punctuation
_plain = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")


class _Generations(dict):
    """A dict that fills itself by `make`, and forgets the older half of its entries when it is full."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


class WordTokens:
    """`ids(text)`: little-endian unsigned 32-bit ids of a whole text, without special tokens.

    The tokenizer must lower-case, drop white space and set every run of punctuation apart from letters, as the word
    vocabulary here does; then a text's ids are those of its words in a row, and a word of letters with punctuation
    behind them has the ids of both runs. Runs go to the model itself, as nothing is left to normalise or to split;
    any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        # Spark already runs a task per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        tokenize, letters = self.tokenizer.model.tokenize, _byte_letters()

        def run(r: str) -> bytes:
            shown = r if r.isascii() else r.encode().decode("latin-1").translate(letters)
            return array("I", [t.id for t in tokenize(shown)]).tobytes()

        runs = _Generations(run, RUNS)

        def word(w: str) -> bytes:
            m = _plain.fullmatch(w)
            if m is None:
                return self._encode(w)
            stem, rest = m.groups()
            return (runs[stem.lower()] if stem else b"") + (runs[rest] if rest else b"")

        self.words = _Generations(word, WORDS)

    def _encode(self, w: str) -> bytes:
        return array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if _odd.search(text):
            return self._encode(text)
        return b"".join(map(self.words.__getitem__, text.split()))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this worker process; read once."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
