"""Operators 11 to 13 against SQL and plain versions on odd small tables, and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from oracle import SF, normal
from pyspark.sql import functions as F

from latticeframe.llm import language_id, prefix_trie, queries, resampling
from latticeframe.llm.ngram_buckets import Words


# --- language identification


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    own = [r.lang == r.lang_pred for r in got if r.held_out and r.lang]
    assert sum(own) >= 0.98 * len(own)


def plain_model(labelled, texts, word_share, gram_share):
    """(language, score) of each text, by dictionaries."""

    def words(t):
        return "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()

    def grams(w, n):
        p = w if n == 1 else f" {w} "
        return [p[k : k + n] for k in range(len(p) - n + 1)]

    langs = sorted({x for _, x in labelled})
    counts = {n: {x: collections.Counter() for x in langs} for n in range(6)}
    for t, x in labelled:
        for w in words(t):
            counts[0][x][w] += 1
            for n in range(1, 6):
                counts[n][x].update(grams(w, n))
    known, score = {}, {}
    for n in range(6):
        total = sum(sum(c.values()) for c in counts[n].values())
        entries = {e for c in counts[n].values() for e in c}
        known[n] = {e for e in entries if sum(c[e] for c in counts[n].values()) >= (gram_share if n else word_share) * total}
        for x in langs:
            for e in known[n]:
                size = sum(counts[n][x].values())
                score[n, x, e] = math.log(counts[n][x][e] + 0.5) - math.log(size + 0.5 * (len(known[n]) + 1))
    out = []
    for t in texts:
        sums = {x: math.log(sum(y == x for _, y in labelled) / len(labelled)) for x in langs}
        for w in words(t):
            if w in known[0]:
                for x in langs:
                    sums[x] += score[0, x, w]
                continue
            for n in range(5, 0, -1):
                found = [g for g in grams(w, n) if g in known[n]]
                if found:
                    for x in langs:
                        sums[x] += sum(score[n, x, g] for g in found) / len(found)
                    break
        best = max(langs, key=lambda x: sums[x])
        if not words(t):
            out.append(("und", 0.0))
        else:
            out.append((best, 1 / sum(math.exp(s - sums[best]) for s in sums.values())))
    return out


def test_predictions_equal_a_plain_version(spark):
    random.seed(5)
    vocabulary = {"aa": ["the", "and", "their", "thing", "Éa"], "bb": ["der", "und", "ding", "dinge"], "cc": ["le", "la", "rien"]}
    labelled = [(" ".join(random.choices(vocabulary[x], k=random.randint(1, 9))), x) for x in vocabulary for _ in range(12)]
    texts = ["the dingen", "x", "123 _ ½", "", None, "THEIR unding", "qqq", "lala theirs und" * 3, "z" * 200 + "the", "éa"]
    df = spark.createDataFrame(labelled, "text string, lang string")
    for shares in ((1 / 1000, 1 / 1000), (1 / 10, 1 / 20)):
        model = language_id.learn(df, *shares)
        rows = spark.createDataFrame([(k, False, t) for k, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
        got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(rows, model).collect()}
        for k, (lang, score) in enumerate(plain_model(labelled, texts, *shares)):
            assert got[k][0] == lang and abs(got[k][1] - score) < 1e-9, (k, got[k], lang, score)


def test_very_long_words_are_scored_piece_by_piece(spark, monkeypatch):
    df = spark.createDataFrame([("the thing " * 5, "aa"), ("der ding " * 5, "bb")], "text string, lang string")
    model = language_id.learn(df)
    word = "theding" * 300
    whole = model.backoff([word, "the"])
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert abs(model.backoff([word, "the"]) - whole).max() < 1e-9


def test_language_of_odd_rows(spark):
    rows = [(None, "the end", "aa"), (3, "the end", "aa"), (3, "the end", "aa"), (1 << 62, None, "aa"), (5, "…12", None), (7, "das ende", "bb")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = [(r.doc_id, r.lang_pred) for r in language_id.identify(docs).collect()]
    assert collections.Counter(i for i, _ in got) == collections.Counter(r[0] for r in rows)
    assert {p for i, p in got if i in (1 << 62, 5)} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0
    nothing = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


# --- conversation trie


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_sql_whatever_is_peeled_where(spark, seed):
    random.seed(seed)
    rows = []
    for c in [*range(40), 100, 101, 207, 399, None]:
        for t in range(12 if c == 7 else random.choice([0, 1, 2, 3, 5, 9])):
            text = random.choice(["a", "b é", None, ""]) if t > 2 else random.choice(["a", "b"])
            rows.append((c, random.choice([t, t, t, None]), random.choice(["user", None]) if t > 3 else "user", text, 1))
    rows += [(c, t, "user", "same", 1) for c in (300, 305, 306, 310) for t in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path int")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    rel = con.sql(queries.OP12_SQL)
    expected = normal(rel.fetchall())
    convs = prefix_trie.rebuilt(df.select("conv_id", "turn", "role", "text"))
    for limit in (8192, 20, 0):
        assert normal([tuple(r) for r in prefix_trie.trie(convs, limit).select(*rel.columns).collect()]) == expected
    assert prefix_trie.rebuilt_trie(df.limit(0)).count() == 0


def test_deep_conversations_need_few_rounds(spark):
    rows = [(c, t, "user", f"t{t}" if t < 290 else f"{c} {t}") for c in (600, 603) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.rebuilt_trie(df).collect()
    assert len(got) == 1 + 290 + 2 * 10
    top = next(r for r in got if r.depth == 0)
    assert (top.n_convs, top.n_leaves, top.saved_tokens) == (2, 2, sum(len(f"t{t}") for t in range(290)))


# --- importance resampling


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_runs_of_words_inside_and_over_lines():
    random.seed(3)
    texts = ["".join(random.choice("ab Zé9\n. ") for _ in range(random.randint(0, 60))) for _ in range(100)]
    texts += ["x" * 127, "x" * 128 + " y", "q" * 129 + " r " + "z" * 100_001, "", " \n", None]
    words = Words(texts)
    got = collections.defaultdict(list)
    for text, bucket in zip(*(a.tolist() for a in words.runs(10000, crossing=True)), strict=True):
        got[text].append(bucket)
    for k, t in enumerate(texts):
        for line in (t or "").split("\n"):
            text, bucket = Words([line]).runs(10000, crossing=False)
            assert not text.any()
            got[k] += bucket.tolist()
        assert sorted(got[k]) == sorted(plain_features(t)[1])


def test_resampling_equals_a_plain_version(spark):
    random.seed(4)
    lines = ["common line of words here\n", "another one, Étude 12\n", "\n", "the end. "]
    docs = [(i, "".join(random.choice(lines) for _ in range(random.randint(0, 12)))) for i in range(80)]
    docs += [(3, docs[3][1]), (None, "words " * 30), (None, None), (1 << 62, "x" * 300), (5, "")]
    target = ["the end of words", None, "étude one"]
    seen, aim = collections.Counter(), collections.Counter()
    for _, t in docs:
        seen.update(plain_features(t)[1])
    for t in target:
        aim.update(plain_features(t)[1])
    s, t = sum(seen.values()), sum(aim.values())
    expected = []
    for i, text in docs:
        n, found = plain_features(text)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((seen[b] + 1) * (t + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        expected.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((e for e in expected if e[5] >= 20), key=lambda e: (-e[3], e[0] is None, e[0] or 0))
    for k, e in enumerate(order[: len(order) * 30 // 100]):
        e[4] = k + 1
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, row int")
    aims = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    got = [tuple(r) for r in resampling.resample(df, aims, percent=30).collect()]
    assert normal(got) == normal([e[:5] for e in expected])
    assert resampling.resample(df.limit(0), aims).count() == 0
    assert {r.rank for r in resampling.resample(df.limit(3), aims.limit(0)).collect()} == {None}
