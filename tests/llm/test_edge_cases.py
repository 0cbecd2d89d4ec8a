"""Every operator and stage on odd tables: nulls, ties, repeats, wide ids, empty tables, columns with clashing names."""

from __future__ import annotations

import collections
import math
import random
import re

import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from latticeframe.llm import byte_bpe, fingerprints, html_extract, line_dedup, near_dedup, packing, quality_rules, secret_scan, suffix_dedup
from latticeframe.llm.repeat_windows import Corpus

BIG = (1 << 60) + 1
PROSE = " ".join(f"word{k * 7 % 90} and{k % 13}" for k in range(200))
ODD = ["a.b", "__runs", "__id", "__gone", "__mark", "__f_lang", "__q_words", "row", "runs", "mark", "of_id", "c0", "noise", "range", "place"]
TEXTS = [
    (1, PROSE), (1, PROSE), (1, "another text under the same id\nwith two lines of its own, long enough for the rules of words"), (None, PROSE + " more"),
    (None, None), (None, ""), (BIG, "password = 'abcdefghijklmnop' is what stands in here, " + PROSE[:300]), (-BIG, PROSE[:200]), (1 << 62, " \n\t\n"), (7, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 2 else None, f"s{k % 3}" if k % 4 else None, None if t is None else len(t), *([k] * len(ODD))) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in ODD)).cache()


PATHS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
PER_ROW = {
    "fingerprints": fingerprints.compare_with_edits,
    "near": lambda d: near_dedup.near_duplicates(d, 3, 85),
    "bpe": lambda d: byte_bpe.encode_decode_digest(d, PATHS[0], public_tokenizers.PATTERN),
    "secrets": secret_scan.report,
    "quality": quality_rules.report,
    "lines": line_dedup.report,
    "suffixes": suffix_dedup.kept_texts,
    "packing": lambda d: packing.pack_documents(d, PATHS[1], packing.all_capacities(2048)),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_for_each_row_and_none_for_none(odd, name):
    ids = collections.Counter(r.doc_id for r in PER_ROW[name](odd).collect())
    assert ids == collections.Counter(i for i, _ in TEXTS)
    assert PER_ROW[name](odd.limit(0)).count() == 0


def test_pages_on_odd_tables(spark):
    rows = [(1, None, None), (1, "http://a.b/c", "<p>x</p>"), (None, "nonsense", "<p>y"), (BIG, "http://a.b/c", "")]
    pages = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "page_id long, url string, html string, noise int, `a.b` int, __host int")
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in html_extract.extract(pages).collect())
    assert got == collections.Counter([(1, "", 0), (1, "x", 1), (None, "y", 1), (BIG, "", 0)])
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_pages_with_broken_markup_and_plain_names():
    assert html_extract.main_text('<p title="x>abc</p><p>def</p>') == "abc\ndef"
    assert html_extract.main_text('<div class="share-price"><p>Shares fell.</p></div><p>rest</p>') == "Shares fell.\nrest"
    assert html_extract.main_text('<div class="share-box"><p>Share it</p></div><p>rest</p>') == "rest"
    assert html_extract.main_text('<article><div class="related"><p>kept</p></div></article>') == "kept"
    # A name on a paragraph of an article is no verdict; on a box, outside of articles, or as a role it is one
    named = '<p class="promotion">He got his promotion</p><p id="search">The search went on</p><h2 class="comment">A comment</h2>'
    assert html_extract.main_text(f"<article>{named}</article>") == "He got his promotion\nThe search went on\nA comment"
    assert html_extract.main_text(f'<article><div class="promo">{named}</div><p>x</p></article>') == "x"
    assert html_extract.main_text(f'{named}<article><p role="alert">a</p><p hidden>b</p><p>x</p></article>') == "x"
    assert html_extract.main_text("<div>" * 60_000 + "deep" + "</div>" * 60_000) == "deep"


def test_slashes_in_classes_are_no_paths():
    nodes, _ = html_extract.parse('<div class="w-1/2"><p>a</p></div><div class="w-1"><b class="2">b</b></div>')
    assert len({x.key for x in nodes}) == len(nodes)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_tables(spark, odd, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd, "")
    assert stage(spark, odd.limit(0), "").count() == 0
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.schema.names == odd.schema.names
        given = {tuple(r)[5:]: r for r in odd.collect()}
        for r in out.collect():
            before = given[tuple(r)[5:]]
            assert (r.doc_id, r.lang, r.source) == (before.doc_id, before.lang, before.source)
            assert r.text == before.text or r.n_chars == len(r.text)


def test_a_group_keeps_one_row_and_other_texts_of_an_id_stay(spark):
    a, b = PROSE, " ".join(f"other{k}" for k in range(60))
    rows = [(5, a), (5, b), (3, b), (None, b), (None, None), (None, "only here and nowhere else at all")]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(5, a), (3, b), (None, None), (None, rows[5][1])], key=str)


def test_posterior_at_low_thresholds():
    looks = near_dedup.least_matches(5 * near_dedup.bands_for(0.5), 0.5, near_dedup.MISS)
    assert looks[-1][0] == 5 * near_dedup.bands_for(0.5) and all(0 <= m <= n for n, m in looks)
    exact = sum(math.comb(101, j) * 0.5**101 for j in range(41))
    assert abs(near_dedup.posterior_tail(40, 100, 0.5) - exact) < 1e-12


def test_maximal_runs_and_ranks(spark):
    random.seed(9)
    texts = ["\n".join(random.choice("abcd") for _ in range(random.randint(0, 14))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = {k: t.split("\n") if t else [] for k, t in enumerate(texts)}
    for depth in (1, 3, 6):
        ids = line_dedup.line_ids(docs.selectExpr("doc_id", "xxhash64(text) as mark", "text")).cache()
        name = {(r.doc_id, r.at): r.line for r in ids.collect()}
        got = {(r.doc_id, r.at): r.rank for r in line_dedup.suffix_array(ids, depth).collect()}
        prefix = {(k, s): tuple(name[k, s + j] for j in range(depth)) for k in lines for s in range(len(lines[k]) - depth + 1)}
        count = collections.Counter(prefix.values())
        repeated = {x: p for x, p in prefix.items() if count[p] > 1}
        assert set(got) == set(repeated)
        order = {p: i for i, p in enumerate(sorted(set(repeated.values())))}
        ranks = {v: i for i, v in enumerate(sorted(set(got.values())))}
        assert all(order[repeated[x]] == ranks[got[x]] for x in got)  # the suffix array's order, equal ranks for equal prefixes
        runs = {(r.doc_id, at) for r in line_dedup.repeated_lines(docs, depth, 10**6).collect() for at in range(r.first, r.last + 1)}
        seen, covered = set(), set()
        for x in sorted(prefix):
            if prefix[x] in seen:
                covered |= {(x[0], x[1] + j) for j in range(depth)}
            seen.add(prefix[x])
        assert runs == covered


def spark_hash(words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h >> 16


def plain_sketch(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {spark_hash(w[k : k + 5]) for k in range(len(w) - 4)}
    return sorted(h for h in found if h < fingerprints.FRACTION * (1 << 48) or h == min(found))


@pytest.mark.parametrize("ids", [range(300), [1 << 62, -(1 << 62), 0, *range(5, 300)], [7] * 200 + [None] * 60 + [9] * 40])
def test_fingerprints_hold_exactly_the_least_hashes(spark, monkeypatch, ids):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 1)
    random.seed(1)
    rows = [(i, " ".join(f"w{random.randint(0, 30)}" for _ in range(random.randint(5, 60)))) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {r.text: r.m for r in df.selectExpr("text", "xxhash64(text) as m").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), marks[r[1]]))
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        a, b = plain_sketch(t), plain_sketch(order[(k + 1) % len(order)][1])
        near = len({*a} & {*b}) / len({*a} | {*b})
        want[i, " ".join(f"{h:x}" for h in a), round(near, 12)] += 1
    got = collections.Counter((r.doc_id, r.fingerprint, round(r.near_next, 12)) for r in fingerprints.compare_with_edits(df).collect())
    assert got == want


def test_fences_against_plain_quartiles(spark):
    random.seed(5)
    rows = []
    for k in range(150):
        width = 4 if k % 3 else 9
        w = ["".join(random.choices("abcdefgh", k=max(1, width + random.randint(-2, 2)))) for _ in range(30)]
        if k % 17 == 0:
            w += ["#$%&"] * random.randint(1, 25)
        rows.append((k, " ".join(w) if k % 19 else "\n".join(["same line of words here"] * random.randint(1, 9) + w), "en", f"s{k % 3 and (k % 3 if k % 5 else 7)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.report(docs).collect()}
    told = {r.row.doc_id: r for r in quality_rules.judge(docs).collect()}
    quart = lambda v, p: sorted(v)[max(0, math.ceil(p * len(v)) - 1)]
    groups = collections.defaultdict(list)
    for i, _, _, s in rows:
        groups[s].append(i)
    for own in groups.values():
        for i in own:
            kept = not told[i]["__q_base_failed"]
            for ratio, least in quality_rules.RATIOS.items():
                v = lambda j: told[j][f"__q_{ratio}"]
                n, prior = len(own) ** 2, quality_rules.PRIOR**2
                lo, hi = ((quart([v(j) for j in own], p) * n + quart([v(j) for j in told], p) * prior) / (n + prior) for p in (0.25, 0.75))
                reach = max(hi - lo, least) * quality_rules.REACH
                kept = kept and lo - reach <= v(i) <= hi + reach
            assert got[i] == kept
    assert 0 < sum(got.values()) < len(got)


def test_pieces_hold_every_window_once():
    raw, length = [b"abc" * 50, b"", b"q" * 30, bytes(range(200)) * 3], 40
    old = suffix_dedup.PIECE_BYTES, suffix_dedup.CHUNK_BYTES
    suffix_dedup.PIECE_BYTES, suffix_dedup.CHUNK_BYTES = 70, 200
    try:
        found = collections.Counter()
        for owner, offset, parts in suffix_dedup._pieces(raw, length):
            for k, at, part in zip(owner, offset, parts, strict=True):
                assert raw[k][at : at + len(part)] == part
                found.update((k, at + p) for p in range(len(part) - length + 1))
        assert found == collections.Counter((k, p) for k, r in enumerate(raw) for p in range(len(r) - length + 1))
    finally:
        suffix_dedup.PIECE_BYTES, suffix_dedup.CHUNK_BYTES = old
    assert len(Corpus([b"", b"a"]).data) == 1
