"""Operators over whole collections against brute force: near copies, repeats, lines, pages, the pipeline."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from oracle import both
from pyspark.sql import functions as F

from latticeframe.llm.repeat_windows import equal_to_depth
from latticeframe.llm import components, html_extract, line_dedup, near_dedup, queries, suffix_dedup
from latticeframe.llm.shingle_sets import overlap, shingle_sets

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def component_ids(texts, size, percent):
    """Smallest id of each document's component, by comparing all pairs."""
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in sets}


def near_copies(n, seed):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(n // 12):
        base = random.choices(vocabulary, k=random.randint(20, 160))
        for _ in range(12):
            edited = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 14))):
                edited[random.randrange(len(edited))] = random.choice(vocabulary)
            out.append(" ".join(edited))
    out += [None, "", "  \n", "one", "ONE", "two words", "Two  Words", "É e", "é e"]
    random.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("size,percent,block", [(3, 85, 512), (5, 80, 7)])
def test_near_duplicates(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", (block, 1 << 20))
    texts = near_copies(180, size)
    sets, want = component_ids(texts, size, percent)
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, size, percent).collect()}
    assert len(set(want.values())) < len(texts) - 30
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i, _ in texts}
    kept = near_dedup.keep_one(docs, size, percent)
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} and kept.columns == docs.columns


def test_near_duplicates_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "x y z")], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(docs).collect()), key=str)
    assert len(got) == 5 and (1, 2, 1, True) in got and (None, 2, 1, False) in got and (None, 0, None, True) in got
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (1, b), (5, a + " x"), (6, b + " x"), (3, "c d e f g h"), (6, "only this one has it here"), (None, "no id but words of its own"), (None, ""), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in near_dedup.keep_one(docs).collect()}
    assert got == {rows[k] for k in (0, 1, 4, 5, 6, 7)}
    made = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect() if r.doc_id in (5, 6))
    assert made == [(5, 1, False), (6, 1, False), (6, 6, True)]


def test_null_and_repeated_ids_against_brute_force(spark):
    random.seed(31)
    texts = [t for _, t in near_copies(120, 6)]
    rows = [(random.choice([*[None] * 20, *range(40)]), t) for t in texts + random.choices(texts, k=20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = dict(docs.select("text", F.xxhash64("text")).distinct().collect())
    first_of, groups = {}, {}
    sets, root = component_ids(list(enumerate(t for _, t in rows)), 3, 85)
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, marks[rows[k][1]])):
        groups.setdefault(root[k], []).append(k)
    for r, own in groups.items():
        first_of[r] = rows[own[0]]
    want = collections.Counter()
    for k, (i, t) in enumerate(rows):
        first, words = first_of[root[k]], len(sets[k])
        if not words:
            want[i, 0, i, True] += 1
            continue
        same_set = sets[k] == sets[groups[root[k]][0]]
        want[i, words, first[0], same_set and i == first[0] and (i is not None or t == first[1])] += 1
    assert sum(f[0] is None for f in first_of.values()) > 3 and sum(k[0] is None and not k[3] for k in want) > 5
    out = near_dedup.near_duplicates(docs, 3, 85)
    assert collections.Counter(map(tuple, out.collect())) == want
    kept = collections.Counter(r.doc_id for r in near_dedup.keep_one(docs, 3, 85).collect())
    assert kept == collections.Counter(r.doc_id for r in out.filter("kept").collect())


def test_rows_without_id_are_linked(spark):
    t = " ".join(f"w{k}" for k in range(80))
    other = " ".join(f"v{k}" for k in range(80))
    rows = [(5, t), (None, t + " z"), (None, t + " z y"), (None, other), (None, other), (None, other + " x")]
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_shingles, r.component_id, r.kept) for r in out if r.component_id) == [(False, 76, 5, True), (True, 77, 5, False), (True, 78, 5, False)]
    alone = [(r.n_shingles, r.kept) for r in out if r.component_id is None]
    assert sorted(n for n, _ in alone) == [76, 76, 77] and len({n for n, kept in alone if kept}) == 1 and {n: k for n, k in alone}[76] != {n: k for n, k in alone}[77]


def test_posterior_and_bands():
    assert abs(near_dedup.posterior_tail(16, 16, 0.5) - (1 - 0.5**17)) < 1e-12
    assert all(m <= n for n, m in near_dedup.least_matches(96, 0.85, 1e-5))
    assert (1 - 0.85**5) ** near_dedup.bands_for(0.85) <= 1e-5


def test_shingle_sets_match_python():
    texts = [t or "" for _, t in near_copies(60, 9)]
    value, at = shingle_sets(texts, 3)
    for a, b in itertools.combinations(range(len(texts)), 2):
        wa, wb = words(texts[a]), words(texts[b])
        sa, sb = ({tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set()) for w in (wa, wb))
        assert overlap(value[at[a] : at[a + 1]], value[at[b] : at[b + 1]]) == len(sa & sb)


def test_components(spark):
    random.seed(1)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.root for r in got.collect()} == root


def brute_repeats(docs, length):
    seen = collections.Counter(b[p : p + length] for _, b in docs for p in range(len(b) - length + 1))
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,classes", [(48, 20_000), (64, 20_000), (101, 3)])
def test_repeated_bytes(spark, monkeypatch, length, classes):
    monkeypatch.setattr(suffix_dedup, "GROUP_CLASSES", classes)
    random.seed(length)
    passages = ["".join(random.choice("abcdé ") for _ in range(random.randint(30, 300))) for _ in range(12)]
    some = lambda: random.choice(passages) if random.random() < 0.6 else "".join(random.choices("xyz w", k=random.randint(1, 90)))
    rows = [(k, "".join(some() for _ in range(random.randint(0, 6)))) for k in range(100)]
    rows += [(500, None), (501, ""), (502, "a" * 500), (502, "ab" * 300), (None, "a" * 100), (503, rows[3][1]), (3, rows[3][1])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length)
    made = got.collect()
    assert sorted([tuple(r)[:5] for r in made], key=str) == brute_repeats([(i, (t or "").encode()) for i, t in rows], length)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in made)


def test_repeated_bytes_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80).cache()
    want = brute_repeats([(r.doc_id, (r.text or "").encode()) for r in docs.collect()], 400)
    made = suffix_dedup.kept_texts(docs).collect()
    assert sorted([tuple(r)[:5] for r in made], key=str) == want
    assert all(r.n_bytes - r.n_removed == len(r.text.encode()) for r in made if "\ufffd" not in r.text)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_windows(docs, 20)


@pytest.mark.parametrize("classes", [5, 40])
def test_large_groups_are_split(spark, monkeypatch, classes):
    largest, border = [], suffix_dedup._border_windows

    def spy(contexts, length):
        largest.append(max((r["count"] for r in contexts.groupBy("core").count().collect()), default=0))
        return border(contexts, length)

    monkeypatch.setattr(suffix_dedup, "_border_windows", spy)
    monkeypatch.setattr(suffix_dedup, "GROUP_CLASSES", classes)
    random.seed(classes)
    passage = "".join(random.choices("abcdefgh ", k=130))
    rows = [(k, "".join(random.choices("xyz w", k=30 + k % 50)) + passage + "".join(random.choices("xyz w", k=60))) for k in range(90)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 100).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_repeats([(i, t.encode()) for i, t in rows], 100)
    assert max(largest) <= classes


def test_radix_passes():
    random.seed(3)
    length, w = 60, 30
    raw, core, anchor, want = [], [], [], collections.Counter()
    for k in range(60):
        middle = bytes([65 + k % 3]) * (length - w + 1)
        before, after = random.choice([b"", b"p" * 9, b"q" * 29, b"pq" * 7]), random.choice([b"x" * 29, b"y" * 8 + b"x" * 21, b"xy" * 20])
        raw.append(before + middle + after)
        core.append(k % 3)
        anchor.append(len(before))
    keys = {}
    for k, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            keys[k, p] = (core[k], anchor[k] - p, r[p : p + length])
            want[keys[k, p]] += 1
    good = {x for x, key in keys.items() if want[key] > 1 and 0 <= key[1] < w}
    row, off = equal_to_depth(np.array(core), np.array(anchor), raw, length, w)
    assert {(k, p) for k, p in zip(row.tolist(), off.tolist()) if 0 <= anchor[k] - p < w} == good


def test_very_long_texts_are_worked_in_pieces(spark):
    random.seed(4)
    text = "".join(random.choices("abcdefghijklm", k=suffix_dedup.PIECE_BYTES + 5000))
    at = suffix_dedup.PIECE_BYTES - 250
    rows = [(1, text), ((1 << 60) + 1, "start " + text[at : at + 600] + " end"), (None, "short"), (4, text[:399])]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (600, 1) and bytes(got[1].kept) == (text[:at] + text[at + 600 :]).encode()
    assert bytes(got[(1 << 60) + 1].kept) == b"start  end" and got[4].n_removed == got[None].n_removed == 0


def brute_lines(docs, min_lines, min_words):
    flat = []
    for i, t in docs:
        full = [(k, tuple(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in enumerate((t or "").split("\n"))]
        full = [(k, w) for k, w in full if w]
        flat.append((i, full))
    gone, single, runs = collections.defaultdict(set), set(), set()
    for i, full in flat:
        for s in range(len(full)):
            if len(full[s][1]) >= min_words and full[s][1] in single:
                gone[i].add(full[s][0])
            single.add(full[s][1])
            run = tuple(w for _, w in full[s : s + min_lines])
            if len(run) == min_lines:
                if run in runs:
                    gone[i].update(k for k, _ in full[s : s + min_lines])
                runs.add(run)
    out = []
    for (i, t), (_, full) in zip(docs, flat, strict=True):
        kept = "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[i])
        out.append((i, len(full), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5, 6])
def test_line_runs(spark, min_lines):
    random.seed(min_lines)
    lines = ["a", "b b", " c\tc ", "c c", "", "  ", "d " * 14, "é"]
    docs = [(k, "\n".join(random.choices(lines, k=random.randint(0, 14)))) for k in range(60)] + [(99, None), (100, "")]
    got = line_dedup.report(spark.createDataFrame(docs, "doc_id long, text string"), min_lines, 12)
    assert sorted(map(tuple, got.collect())) == brute_lines(docs, min_lines, 12)


def test_line_deletion_keeps_columns(spark):
    text = "one line here\nsecond line here\nthird line here"
    docs = spark.createDataFrame([(2, text, 5, "x"), (1, text, 5, "y"), (3, text + "\nown", 5, "z"), (4, None, 0, "n"), (None, "", 0, "m")], "doc_id long, text string, n_chars long, mark string")
    got = {r.doc_id: r for r in line_dedup.delete_repeats(docs).collect()}
    assert set(got) == {1, 3, 4, None} and got[3].text == "own" and got[3].n_chars == 3 and got[1].text == text and got[4].text is None
    assert line_dedup.delete_repeats(docs.limit(0)).count() == 0


PAGES = {
    "plain": ("<p>a &amp; b<p>c", "a & b\nc"),
    "article only": ("<body><nav>menu</nav><article><header><h1>T</h1></header><p>x <b>y</b>\n z</p><aside>no</aside></article><footer>f</footer>", "T\nx y z"),
    "comments": ("<main><p>text</p><section class='user-comments'><p>bad</p></section><div id=share>s</div></main>", "text"),
    "raw": ("<script>var a='</p><p>x';</script><style>p{}</style><article><p>ok<form>f</form></article>", "ok"),
    "unclosed": ("<article><h1>t</h1><p><b>one<br><p>two", "t\none\ntwo"),
    "cut tag": ("<article><p>one</p><p class=", "one"),
    "comment article": ("<article><p>a</p><article class='comment'>b</article></article>", "a"),
    "lists": ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert html_extract.main_text(page) == want


def test_style_tree_finds_notices(spark):
    def page(i):
        own = "".join(f"<p>{' '.join(f'w{i}_{k}_{j}' for j in range(12))}</p>" for k in range(1 + i % 4))
        return f"<body><div class=top>Buy now at our shop <span>today</span></div><div class=content>{own}</div><div class=legal>All rights</div></body>"

    rows = [(i, f"http://shop.example/{i}", page(i)) for i in range(30)] + [(100, "http://other.example/", "<div class=top>Only here</div>"), (101, None, None), (None, "no url", "<p>x")]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        assert got[i].text == "\n".join(" ".join(f"w{i}_{k}_{j}" for j in range(12)) for k in range(1 + i % 4))
        assert got[i].n_chars == len(got[i].text)
    assert got[100].text == "Only here" and got[101].text == "" and got[None].text == "x"


def test_copies_of_an_article_stay(spark):
    rows = [(i, "http://h/", "<nav>n</nav><article><p>the same article</p></article>") for i in range(40)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in got.collect()} == {"the same article"}


def test_style_tree_decides_inside_articles(spark):
    words = lambda i, k: " ".join(f"w{i}_{k}_{j}" for j in range(12))
    same = "<p>first part of one article</p><p>second part of one article</p><p>third</p>"

    def page(i):
        own = [f"<p>{words(i, k)}</p>" for k in range(3)]
        own.insert(i % 4, "<p>Read our letter every day</p>")
        return f"<body><article>{''.join(own)}<div class=x>Buy <b>now</b></div></article></body>"

    # The same article at 20 addresses with a counter; a teaser as article beside the main text; fixed rows of children
    rows = [(i, "http://a/", page(i)) for i in range(30)]
    rows += [(100 + i, "http://a/", f"<body><article>{same}<p>seen {i}</p></article></body>") for i in range(20)]
    rows += [(200 + i, "http://b/", f"<article><p>tease {i}</p></article><div class=text>{''.join(f'<p>{words(i, k)}</p>' for k in range(20))}</div>") for i in range(20)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == "\n".join(words(i, k) for k in range(3))
    for i in range(20):
        assert got[100 + i] == f"first part of one article\nsecond part of one article\nthird\nseen {i}"
        assert got[200 + i] == "\n".join([f"tease {i}", *(words(i, k) for k in range(20))])


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    ours, theirs = both(spark, queries.queries()[name], queries.oracle_sql()[name])
    assert ours == theirs


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [tuple(r) for r in docs.collect()]
        made = stage(spark, docs, SF)
        assert made.columns == columns, name
        after = [tuple(r) for r in made.collect()]
        texts = [(r[0], r[1]) for r in rows]
        if name == "line dedup":
            want = {(i, h) for i, n, gone, h in brute_lines(sorted(texts), line_dedup.MIN_LINES, line_dedup.MIN_WORDS) if not (gone == n and n)}
            assert {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in after} == want
        elif name == "near dedup":
            _, want = component_ids(texts, 5, 80)
            assert {r[0] for r in after} == {i for i in want if want[i] == i}
        elif name == "secret scans":
            assert {r[0] for r in after} == {r[0] for r in rows}
        docs = spark.createDataFrame(after, docs.schema)
        before = {r[0] for r in after}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == before
    assert np.array([r.length for r in packed.collect()]).max() <= 2048
