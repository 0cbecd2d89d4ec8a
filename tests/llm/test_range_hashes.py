"""Hashes of byte ranges: structured texts that sums modulo a power of two can't tell apart."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from latticeframe.llm import line_dedup, near_dedup, suffix_dedup
from latticeframe.llm.shingle_sets import PRIME, Ranges, prime_powers, range_hashes, times, word_hashes


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(k).count("1") % 2] for k in range(n))


def test_products_modulo_the_prime():
    random.seed(1)
    p = int(PRIME)
    x = [random.choice([0, 1, p - 1, random.randrange(p)]) for _ in range(2000)]
    y = [random.choice([0, 1, p - 1, random.randrange(p)]) for _ in range(2000)]
    got = times(np.array(x, np.uint64), np.array(y, np.uint64)).tolist()
    assert got == [a * b % p for a, b in zip(x, y, strict=True)]
    up, down = prime_powers(100)
    assert times(up[:100], down[:100]).tolist() == [1] * 100


def test_equal_ranges_have_equal_hashes_and_others_do_not():
    random.seed(2)
    data = np.frombuffer(bytes(random.choice(b"ab") for _ in range(400)), np.uint8)
    starts, ends = map(np.array, zip(*itertools.combinations(range(0, 401, 3), 2), strict=True))
    by_hash, by_bytes = {}, {}
    for h, s, e in zip(Ranges(data).hashes(starts, ends).tolist(), starts, ends, strict=True):
        by_hash.setdefault(h, set()).add(data[s:e].tobytes())
        by_bytes.setdefault(data[s:e].tobytes(), set()).add(h)
    assert all(len(x) == 1 for x in [*by_hash.values(), *by_bytes.values()])


@pytest.mark.parametrize("n", [256, 512, 1024])
def test_structured_words_differ(n):
    texts = [thue_morse(n, x, y) for x, y in itertools.permutations("abcdefgh01XY", 2)]
    hashes, _ = word_hashes(texts, lower=False)
    assert len(set(hashes.tolist())) == len(texts)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.arange(0, len(data), n)
    assert len(set(range_hashes(data, at, at + n).tolist())) == len(texts)


def test_structured_texts_stay_apart_in_three_operators(spark):
    x, y = thue_morse(512), thue_morse(512, "b", "a")
    docs = spark.createDataFrame([(1, f"{x} b c"), (2, f"{y} b c")], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(docs, 3, 85).collect()} == {1, 2}
    lines = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{lines} {x}"), (2, f"{lines} {y}")], "doc_id long, text string")
    assert {r.n_deleted for r in line_dedup.report(docs).collect()} == {0}
    random.seed(3)
    filler = "".join(random.choice("klmnop") for _ in range(150))
    docs = spark.createDataFrame([(1, filler + x[:256] + "1"), (2, filler + y[:256] + "2")], "doc_id long, text string")
    assert {r.n_removed for r in suffix_dedup.kept_texts(docs).collect()} == {0}
