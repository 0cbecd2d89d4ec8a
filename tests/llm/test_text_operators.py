"""Operators on single texts against plain Python: BPE, words, quality, secrets, fingerprints, chat."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from latticeframe.llm import byte_bpe, chat_format, fingerprints, packing, quality_rules, secret_scan, word_tokens

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [None, "", "   ", "a", "ab c", "a b c d e f g h i j k", "one two three four five " * 6, "é漢字😀 x\n\n\ty", "x" * 5000, "line\nline\n\nline"]


def table(spark, texts=TEXTS, first=0):
    rows = [(first + i, t, "en" if i % 2 else None, "s", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")


@pytest.fixture(scope="module")
def theirs():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_bpe_is_exact(theirs, text):
    c = byte_bpe.codec(RANKS, PATTERN)
    ids = c.encode(text)
    assert ids == theirs.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_bpe_long_runs_and_digest(spark, theirs):
    c = byte_bpe.codec(RANKS, PATTERN)
    for text in ("a" * 30000, "ab" * 9000, "=" * 4001, "thethe" * 2000):
        assert c.encode(text) == theirs.encode_ordinary(text)
    got = {r.doc_id: r for r in byte_bpe.encode_decode_digest(table(spark), RANKS, PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = theirs.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    round_trip = byte_bpe.decode(byte_bpe.encode(table(spark), RANKS, PATTERN), RANKS, PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in round_trip.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert byte_bpe.encode(table(spark).limit(0), RANKS, PATTERN).count() == 0


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_counts(spark):
    texts = [*TEXTS, "a b c d e " * 9, "q " * 40, "# % | a b c d e f g h i j k", " \n\t\x0b\x0c\r lead and trail \x0b"]
    got = {r.doc_id: r for r in quality_rules.report(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = words(t)
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        seen, again = set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                again += line in seen
                seen.add(line)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (again, len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.base_failed and r.kept)


def test_fences_follow_their_group(spark):
    """A group that uses symbols throughout keeps its documents; the same document elsewhere is rejected."""
    plain = " ".join(f"word{k}" for k in range(40))
    odd = " ".join(f"w{k} ###" for k in range(40))
    rows = [(i, f"{plain} {i}", "en", "news") for i in range(60)] + [(100 + i, f"{odd} {i}", "en", "code") for i in range(60)] + [(999, odd, "en", "news")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert kept == {i for i, *_ in rows} - {999}
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.report(docs.limit(0)).count() == 0


def plain_spans(text):
    rules = [
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I, 12, 2),
        (r"AKIA[A-Z0-9]+", re.A, 18, 0),
        (r"[0-9a-f]+", re.A, 16, 0),
    ]
    out = []
    for k, (pattern, flags, least, group) in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    return sorted(out)


SECRETS = [
    "token = 'abcdefghijkl' x", "TOKEN:short", "ſecret=abcdefghijklmn", "api_key=0123456789abcdef0123", "AKIA" + "A" * 13, "AKIA" + "A" * 14,
    "é password: passwordpassword password=abcdefabcdefabcdef", "0123456789abcdef" * 3 + "g", "secrettoken=AAAAAAAAAAAA", "apikey==abcdefghijklm",
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "=", ":", " ", "'", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "é", "x", "api_", "key"]), max_size=14))
def test_secrets_against_plain_regex(parts):
    text = "".join(parts)
    found = secret_scan.Scanner(secret_scan.BASE_RULES).scan([text])[0]
    assert [x[:3] for x in found] == plain_spans(text)


def test_secret_report_and_redaction(spark):
    texts = [None, "", *SECRETS, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36]
    got = {r.doc_id: r for r in secret_scan.report(table(spark, texts)).collect()}
    names = ["assign", "access", "hex"]
    for i, t in enumerate(texts):
        spans = plain_spans(t or "")
        said = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(x[1] == k for x in spans) for k in range(3)]
        assert set(filter(None, said.split(","))) <= set(got[i].spans.split(","))
    assert "pem:" in got[len(texts) - 1].spans and "github:" in got[len(texts) - 1].spans
    docs = spark.createDataFrame([(1, SECRETS[0], 3), (2, None, 0)], "doc_id long, text string, n_chars long")
    clean = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert clean[1].text == "token = '[secret]' x" and clean[1].n_chars == len(clean[1].text) and clean[2].text is None


def test_trigram_queries_only_skip_what_cannot_match():
    assert secret_scan.trigram_query("[0-9a-f]{16,}") is True
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == ("and", "aki", "kia")
    assert secret_scan.trigram_query("(ab|abcd)x?") is True


def shingle_set(t):
    w = words(t)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_fingerprints(spark):
    random.seed(2)
    base = [f"w{random.randint(0, 500)}" for _ in range(3000)]
    texts = [*TEXTS, " ".join(base), " ".join(base[:2500] + ["new"] * 5), " ".join(base)]
    docs = table(spark, texts).union(spark.createDataFrame([(None, "null id", None, None, 0), (40, "gap", "x", "x", 0)], "a long, b string, c string, d string, e long"))
    got = {r.doc_id: r for r in fingerprints.compare_with_edits(docs).collect()}
    assert len(got) == docs.count()
    order = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (x[0] is None, -(x[0] or 0)))
    for k, (i, t) in enumerate(order):
        n, following = len(t), order[(k + 1) % len(order)][1]
        edited = t[: n - n // 2] + following[: n // 2]
        assert got[i].n_chars == n and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((got[i].near_edited, edited), (got[i].near_next, following)):
            a, b = shingle_set(t), shingle_set(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert 0 <= value <= 1
            if len(a) > 1000 and len(b) > 1000 or a == b:
                assert abs(value - true) < 0.08
    same = [len(TEXTS), len(TEXTS) + 2]
    assert got[same[0]].fingerprint == got[same[1]].fingerprint


def test_sketches_merge(spark):
    from pyspark.sql import functions as F

    a, b = " ".join(f"a{k}" for k in range(400)), " ".join(f"b{k}" for k in range(40))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprints.sketch(F.col("a")).alias("x"), fingerprints.sketch(F.col("b")).alias("y"))
    r = df.select("x", "y", fingerprints.merged(F.col("x"), F.col("y")).alias("m"), fingerprints.containment(F.col("y"), F.array_union("x", "y")).alias("c")).first()
    limit = (1 << 48) * fingerprints.FRACTION
    assert [h for h in r.m if h < limit] == sorted({h for h in [*r.x, *r.y] if h < limit}) and r.c == 1.0


def test_chat_round_trip_and_events(spark):
    random.seed(0)
    bits = ["<", "|", "\\", "\n", "n", "a", "<|im_end|>", "<|im_start|>"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 12))) for _ in range(200)]
    turns = spark.createDataFrame([(i % 40, i // 40, t, texts[-1 - i]) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    made = chat_format.with_loss_mask(chat_format.render(chat_format.fold(chat_format.events_of_turns(turns)))).collect()
    for r in made:
        own = [(texts[i], texts[-1 - i]) for i in range(len(texts)) if i % 40 == r.conv_id]
        assert [(role, chat_format.unescape(r.formatted[a:b])) for role, a, b in chat_format.parse(r.formatted)] == own
    log = [
        (1, 1, "a", "start", "user", "hi"), (1, 2, "b", "start", "assistant", ""), (1, 3, "b", "delta", None, "bad"), (1, 4, "b", "regenerate", None, None),
        (1, 5, "b", "delta", None, "go"), (1, 6, "b", "delta", None, "od"), (1, 7, "a", "edit", None, "hello"), (1, 8, "c", "start", "user", "x"), (1, 9, "c", "delete", None, None),
        (None, 1, None, "delta", None, None), (None, 2, None, "odd kind", None, "zzz"),
    ]
    random.shuffle(log)
    got = {r.conv_id: r.formatted for r in chat_format.render(chat_format.fold(spark.createDataFrame(log, chat_format.EVENTS))).collect()}
    assert got[1] == "<|im_start|>user\nhello<|im_end|>\n<|im_start|>assistant\ngood<|im_end|>\n"
    assert got[None] == "<|im_start|>\n<|im_end|>\n"
    assert chat_format.fold(spark.createDataFrame([], chat_format.EVENTS)).count() == 0


def test_word_tokens_are_the_tokenizers(spark):
    w = word_tokens.word_tokens(public_tokenizers.path("word_bpe_49k.json"))
    random.seed(4)
    odd = ["Word,", "word.", "don't", "ÉCOLE", "İx", "ß,", "a.b", "...", "'s", "x's.", "é", "́", "漢字", "\x1c", " ", "12,", "ΑΣ", "a b"]
    for _ in range(400):
        text = random.choice(["", " ", "\n"]).join(random.choices([*odd, " ", "\t", "hello", "World"], k=12))
        ids = w.tokenizer.encode(text, add_special_tokens=False).ids
        assert w.ids(text) == b"".join(i.to_bytes(4, "little") for i in ids), text


def test_packing_keeps_every_capacity(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 800)
    for cap in (packing.Capacity(2048), packing.Capacity(2048, documents=4), packing.Capacity(2048, attention=900_000, rule="dot", weights=(1, 0, 1))):
        bins = packing.pack(lengths, cap)
        for b in np.unique(bins):
            own = lengths[bins == b]
            assert own.sum() <= cap.tokens and len(own) <= (cap.documents or 1 << 30) and (own.astype(float) ** 2).sum() <= (cap.attention or 1e18)
        if cap.documents is None and cap.attention is None:
            assert len(np.unique(bins)) <= -(-lengths.sum() // 2048) + 1


def test_packed_documents(spark):
    import zlib

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*TEXTS, "token stream " * 3000]
    rows = packing.pack_documents(table(spark, texts), path).collect()
    w = word_tokens.word_tokens(path)
    sequences, by = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for i, t in enumerate(texts):
        coded = w.ids(t or "") + bytes(4)
        parts = sorted(by[i], key=lambda r: r.piece)
        want = [(k, s // 4, len(coded[s : s + 8192]) // 4, zlib.crc32(coded[s : s + 8192])) for k, s in enumerate(range(0, len(coded), 8192))]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in parts] == want
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(table(spark).limit(0), path).count() == 0


def test_packing_keeps_odd_ids_apart(spark):
    """Null ids, ids beyond 2**53, repeated rows and columns with clashing names: every row is a document of its own."""
    big = (1 << 60) + 1
    rows = [(None, "one two"), (None, "one two"), (big, "three"), (big, "four five"), (-big, None)] * 40
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, length int, `a.b` string")
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack_documents(docs, path, packing.all_capacities(16)).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 16
    assert len(by) == -(-sum(r.length for r in got) // 16)
