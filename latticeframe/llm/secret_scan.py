"""Secret scans with a trigram inverted index (operator 7).

Method: each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. Every
batch of documents is an index segment: postings (trigram -> documents of the batch) are built for the trigrams that
occur in a query, the query is evaluated by intersecting and uniting postings, and only the candidates are matched
with the expression itself. A rule without mandatory trigrams (such as a bare character class) scans every document.
Trigrams are taken from ASCII-lower-cased text, so one index serves exact and caseless rules.
"""

from __future__ import annotations

import hashlib
import re
import re._parser as sre  # the standard library's own parser of expressions
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from latticeframe.llm.common import map_rows, only

# --- rules ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """`group` of a match must have `least` characters at least; other matches are dropped after matching."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    caseless: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.caseless else 0))


#: The three base rules, in the order in which ties between their spans are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
        caseless=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # Runs of 16 and more: the same matches as all runs with the shorter ones dropped, found faster.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
#: Further rules of this scanner; they add spans.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# --- trigram queries -----------------------------------------------------------------------------------------------

#: A query is True (no restriction), a trigram, ("and", ...) or ("or", ...).
Query = object
MOST_STRINGS = 16


def _both(parts: list) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(parts: list) -> Query:
    if any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings: all trigrams of one of them; no restriction if one is shorter than a trigram."""
    if any(len(s) < 3 for s in strings):
        return True
    return _either([_both([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _one(op, arg) -> tuple[set[str] | None, Query]:
    """One node of a parsed expression: the strings it can match, if they are few; else a query that must hold."""
    name = str(op)
    if name == "LITERAL" and arg < 128:
        return {chr(arg).lower()}, True
    if name == "IN" and len(arg) <= 4 and all(str(o) == "LITERAL" and a < 128 for o, a in arg):
        return {chr(a).lower() for _, a in arg}, True
    if name == "AT":
        return {""}, True
    if name == "SUBPATTERN":
        return _several(arg[3])
    if name == "BRANCH":
        ways = [_several(b) for b in arg[1]]
        strings = set().union(*(s for s, _ in ways if s is not None))
        if all(s is not None for s, _ in ways) and len(strings) <= MOST_STRINGS:
            return strings, True
        return None, _either([q if s is None else _of_strings(s) for s, q in ways])
    if name.endswith("REPEAT"):
        low, high, body = arg
        strings, query = _several(body)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, True
        if strings is not None and len(strings) == 1 and low == high and low <= 8:
            return {s * low for s in strings}, True
        if low:
            return None, query if strings is None else _of_strings(strings)
    return None, True


def _several(nodes) -> tuple[set[str] | None, Query]:
    """The same for nodes in a row: strings are joined as long as they stay few."""
    run, found, whole = {""}, [], True
    for op, arg in nodes:
        strings, query = _one(op, arg)
        if strings is None or len(run) * len(strings) > MOST_STRINGS:
            found += [_of_strings(run), query]
            run, whole = strings or {""}, False
        else:
            run = {a + b for a in run for b in strings}
    return (run, True) if whole else (None, _both([*found, _of_strings(run)]))


def trigram_query(pattern: str) -> Query:
    """What every text with a match of `pattern` must contain, in lower case."""
    strings, query = _several(sre.parse(pattern, re.ASCII))
    return query if strings is None else _of_strings(strings)


def _trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(_trigrams(q) for q in query[1:]))


class Index:
    """The trigrams of all rules' queries; `postings` of one segment of texts."""

    def __init__(self, queries: list[Query]):
        self.names = sorted(set().union(*(_trigrams(q) for q in queries)))
        self.table = np.zeros(1 << 24, dtype=np.uint8 if len(self.names) < 255 else np.uint16)
        for i, t in enumerate(self.names):
            a, b, c = t.encode("ascii")
            self.table[a << 16 | b << 8 | c] = i + 1

    def postings(self, texts: list[str]) -> dict[str, frozenset[int]]:
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        data = np.frombuffer(b"\0\0".join(raw) + b"\0\0", dtype=np.uint8)
        starts = np.cumsum([0, *(len(r) + 2 for r in raw)])[:-1]
        wide = data.astype(np.uint32)
        hit = self.table[wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]]
        places = np.flatnonzero(hit)
        docs, kinds = np.searchsorted(starts, places, side="right") - 1, hit[places]
        found: dict[str, set[int]] = {t: set() for t in self.names}
        for pair in np.unique(kinds.astype(np.int64) << 40 | docs):
            found[self.names[int(pair >> 40) - 1]].add(int(pair & (1 << 40) - 1))
        return found


def candidates(query: Query, postings: dict, everything: frozenset[int]) -> frozenset[int]:
    if query is True:
        return everything
    if isinstance(query, str):
        return postings[query]
    parts = [candidates(q, postings, everything) for q in query[1:]]
    return frozenset.intersection(*map(frozenset, parts)) if query[0] == "and" else frozenset().union(*parts)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        self.index = Index([q for _, _, q in self.rules])

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
        """Per text, ordered: (start, number of the rule, end, start and end of the group that is the secret)."""
        postings, everything = self.index.postings(texts), frozenset(range(len(texts)))
        out: list[list] = [[] for _ in texts]
        for k, (rule, expression, query) in enumerate(self.rules):
            for i in candidates(query, postings, everything):
                for m in expression.finditer(texts[i]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        out[i].append((m.start(), k, m.end(), a, b))
        return [sorted(x) for x in out]


# --- DataFrame operators -------------------------------------------------------------------------------------------


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """`doc_id, kind, start, end` of every secret; offsets are code points of the whole text, ends exclusive.

    Null and empty texts have none; repeated rows are scanned each for itself; other columns are ignored.
    """

    def make():
        s = Scanner(rules)

        def rows(ids, texts):
            found = s.scan([t or "" for t in texts])
            return [(i, rules[k].kind, a, b) for i, x in zip(ids, found, strict=True) for a, k, b, _, _ in x]

        return rows

    return map_rows(
        only(docs, doc_id="long", text="string"), "doc_id long, kind string, start long, end long", make
    )


def report(docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """Per document: counts of the base rules, a digest of their spans, and all spans in text form.

    Null and empty texts have none; texts are scanned whole, however long; null and repeated ids and repeated rows keep
    rows of their own; ties are listed in the order of the rules; extra columns are ignored, whatever they are called;
    an empty table gives an empty one.
    """
    rules = BASE_RULES + more

    def make():
        s = Scanner(rules)

        def rows(ids, texts):
            out = []
            for i, found in zip(ids, s.scan([t or "" for t in texts]), strict=True):
                said = [f"{rules[k].kind}:{a}:{b}" for a, k, b, _, _ in found]
                base = ",".join(x for x, f in zip(said, found, strict=True) if f[1] < len(BASE_RULES))
                counts = [sum(f[1] == k for f in found) for k in range(len(BASE_RULES))]
                out.append((i, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(said)))
            return out

        return rows

    return map_rows(
        only(docs, doc_id="long", text="string"),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
        make,
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, mark: str = "[secret]") -> DataFrame:
    """The rows of `docs` with every secret in `text` replaced by `mark`; an `n_chars` column follows the new text.

    Overlapping secrets are replaced by one mark. A text without secrets, null included, stays as it is. Every row is
    worked on by itself, repeated ones alike; other columns are kept, whatever they are called; an empty table stays
    empty.
    """
    names = docs.columns
    at, n_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def make():
        s = Scanner(rules)

        def rows(*columns):
            texts = columns[at]
            out = []
            for row, found in zip(zip(*columns, strict=True), s.scan([t or "" for t in texts]), strict=True):
                if found:
                    text, parts, done = row[at], [], 0
                    for a, b in sorted((f[3], f[4]) for f in found):
                        if a >= done:
                            parts += [text[done:a], mark]
                        done = max(done, b)
                    new = "".join(parts) + text[done:]
                    row = list(row)
                    row[at] = new
                    if n_at is not None:
                        row[n_at] = len(new)
                out.append(tuple(row))
            return out

        return rows

    return map_rows(docs.toDF(*(f"c{k}" for k in range(len(names)))), docs.schema, make)
